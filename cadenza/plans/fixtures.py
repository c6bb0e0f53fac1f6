"""Deterministic artifact injection shared by the Spark queries and their DuckDB oracles.

The driver's ``documents`` hold none of the publication artifacts the line and text rules target, so the
queries for B1-B11 and C1-C9 first add them by a fixed rule on ``doc_id``.  The expression is plain SQL
valid in both Spark and DuckDB; every document is kept (this is a rewrite of the text, not a filter).
"""

from __future__ import annotations

# Fixed artifact texts, one per residue of doc_id % 10.
INJECT_SQL = """CASE doc_id % 10
 WHEN 0 THEN 'Header junk' || chr(10) || '*** START OF THE PROJECT GUTENBERG EBOOK X ***' || chr(10) || text
   || chr(10) || '*** END OF THE PROJECT GUTENBERG EBOOK X ***' || chr(10) || 'Footer text after the end.'
 WHEN 1 THEN '1:1 In the beginning there was light.' || chr(10) || 'BOOK IV.' || chr(10)
   || 'The Book of the Prophet Isaiah' || chr(10) || '12:3 ' || text
 WHEN 2 THEN text || ' See https://x.example/a now, my friend …see more' || chr(10)
   || 'Visit http://y.example/b?q=1 today please.'
 WHEN 3 THEN 'Note i.e.x and e.g.y but i.e. not, grace ^ 12 note ^ here.' || chr(10) || text
   || ' He said [aside] "hello" to me [unclosed'
 WHEN 4 THEN text || ' Wait Page 3 of 10 here is IBM. Chapter 7 begins now. Ok no.' || chr(10) || '7' || chr(10)
   || '00:00:01,500 --> 00:00:03,250' || chr(10) || 'Subtitle words go here.'
 WHEN 5 THEN '“Curly” quotes don’t ﬁnd the ﬂow, Ｆｕｌｌ ｗｉｄｔｈ, café &amp; co &lt;b&gt; Itâ€™s ﬁne.' || chr(10)
   || text || ' a' || chr(160) || 'b c d e.'
 WHEN 6 THEN '*** END OF THE PROJECT GUTENBERG EBOOK Y ***' || chr(10) || text || chr(10)
   || '*** START OF THE PROJECT GUTENBERG EBOOK Y ***' || chr(10) || 'After the start line.'
 WHEN 7 THEN '*** START OF THE PROJECT GUTENBERG EBOOK Z ***' || chr(10) || text
 WHEN 8 THEN 'CHAPTER ONE' || chr(10) || '42' || chr(10) || '(1)' || chr(10) || 'The Gospel of John' || chr(10)
   || text || chr(10) || 'ALL CAPS BUT A VERY LONG LINE THAT EXCEEDS FORTY CHARS'
 ELSE text || ' The <tag> stays &amp; here.' || chr(13) || chr(10) || 'Carriage return line.' || chr(13)
   || 'Old mac line ends here.'
END"""

# The same documents as a DuckDB relation.
DUCK_INJECTED = f"(SELECT doc_id, {INJECT_SQL} AS text FROM documents)"
