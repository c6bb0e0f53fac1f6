"""DuckDB (RE2) SQL fragments that mirror ``functions.text`` for the oracle queries.

RE2 differs from Java: no look-behind, ASCII ``\\s``/``\\d``/``\\b``, ``(?U)`` means ungreedy, and a
replace-all needs the ``'g'`` flag.  The whitespace class below is the same code-point set as
``functions.text.WS``; it is written out so both engines see identical classes.
"""

from __future__ import annotations

from ..functions import text as T
from ..options import GUTENBERG_END, GUTENBERG_START


def lit(s: str) -> str:
    """A DuckDB string literal; characters outside printable ASCII go through ``chr()``."""
    parts: list[str] = []
    buf = ""
    for ch in s:
        if 32 <= ord(ch) < 127:
            buf += "''" if ch == "'" else ch
        else:
            if buf:
                parts.append(f"'{buf}'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
    if buf or not parts:
        parts.append(f"'{buf}'")
    return "(" + " || ".join(parts) + ")"


WS = T.WS
SPACE = f"[{WS}]"
NON_SPACE = f"[^{WS}]"


def rx(pattern: str) -> str:
    """Regex literal (patterns hold no quote characters)."""
    assert "'" not in pattern
    return f"'{pattern}'"


def strip(x: str) -> str:
    return f"trim({x}, {lit(T.WS_CHARS)})"


VERSE = rf"^\p{{Nd}}{{1,3}}:\p{{Nd}}{{1,3}}{SPACE}*"
URL = rf"https?://{NON_SPACE}+"
TITLE = T.TITLE_PATTERN
BOOK = rf"(?i)^BOOK{SPACE}+[IVXLC]+{SPACE}*\.?\z"
SUBTITLE = T.SUBTITLE_CUE_PATTERN


def strip_verse_ref(x):
    return f"regexp_replace({x}, {rx(VERSE)}, '')"


def strip_urls(x):
    return f"regexp_replace({x}, {rx(URL)}, '', 'g')"


def strip_see_more(x):
    return f"replace({x}, {lit(T.SEE_MORE)}, '')"


def strip_subtitle_cues(x):
    return f"regexp_replace({x}, {rx(SUBTITLE)}, '', 'g')"


def is_title_line(x):
    return f"regexp_matches({x}, {rx(TITLE)})"


def is_book_heading(x):
    return f"regexp_matches({x}, {rx(BOOK)})"


def is_digit_line(x):
    return f"regexp_matches({x}, '^\\p{{Nd}}+\\z')"


def is_upper(x):
    return f"(regexp_matches({x}, '\\p{{Lu}}') AND NOT regexp_matches({x}, '[\\p{{Ll}}\\p{{Lt}}]'))"


def is_short_caps(x):
    return f"({is_upper(x)} AND length({x}) < 40)"


def has_min_letters(x, n=5):
    return f"(length(regexp_replace({x}, '[^a-zA-Z]', '', 'g')) >= {n})"


def clean_line(x):
    return strip_see_more(strip_urls(strip_verse_ref(strip(x))))


def keep_line(x):
    return (
        f"({x} <> '' AND NOT {is_title_line(x)} AND NOT {is_book_heading(x)} AND NOT {is_digit_line(x)}"
        f" AND NOT {is_short_caps(x)} AND {has_min_letters(x)})"
    )


def split_lines(x):
    return f"regexp_split_to_array({x}, '\\r\\n|\\r|\\n')"


def slice_between(lines):
    s = f"list_position(list_transform({lines}, lambda x: contains(x, {lit(GUTENBERG_START)})), true)"
    e = f"list_position(list_transform({lines}, lambda x: contains(x, {lit(GUTENBERG_END)})), true)"
    return f"(CASE WHEN {s} IS NOT NULL AND {e} IS NOT NULL THEN list_slice({lines}, {s} + 1, {e} - 1) ELSE {lines} END)"


def filter_lines(text):
    lines = slice_between(split_lines(text))
    return (
        f"array_to_string(list_filter(list_transform({lines}, lambda l: {clean_line('l')}), "
        f"lambda l: {keep_line('l')}), ' ')"
    )


def _replace_all(x, rules):
    for src, dst in rules:
        x = f"replace({x}, {lit(src)}, {lit(dst)})"
    return x


def repair_text(x):
    x = _replace_all(x, T.MOJIBAKE_RULES)
    x = f"(CASE WHEN contains({x}, '<') THEN {x} ELSE {_replace_all(x, T.ENTITY_RULES)} END)"
    x = _replace_all(x, T.LIGATURE_RULES)
    return f"translate({x}, {lit(T.WIDE_FROM)}, {lit(T.WIDE_TO)})"


def expand_abbrev(x):
    x = f"regexp_replace({x}, '(?i)\\bi\\.e\\.\\b', 'that is', 'g')"
    return f"regexp_replace({x}, '(?i)\\be\\.g\\.\\b', 'for example', 'g')"


def strip_footnotes(x):
    return f"regexp_replace({x}, {rx(rf'{SPACE}*\^({SPACE}*\p{{Nd}}+)?{SPACE}*')}, ' ', 'g')"


def strip_brackets(x):
    return f"regexp_replace({x}, '\\[.*?\\]', '', 'g')"


def strip_quotes(x):
    return f"replace({x}, '\"', '')"


def whitelist(x):
    return f"regexp_replace({x}, '[^a-zA-Z0-9{WS}.,?!''-]', '', 'g')"


def squeeze(x):
    return f"trim(regexp_replace({x}, {rx(SPACE + '+')}, ' ', 'g'))"


def sanitize(x):
    return squeeze(whitelist(strip_quotes(strip_brackets(strip_footnotes(expand_abbrev(x))))))


def strip_page_marks(x):
    return f"regexp_replace(regexp_replace({x}, 'Page [0-9]+ of [0-9]+', '', 'g'), 'Chapter [0-9]+', '', 'g')"


def normalise_text(x):
    return strip_page_marks(sanitize(repair_text(x)))


def split_sentences(x):
    return f"string_split(regexp_replace({x}, {rx('([.?!])' + SPACE + '+')}, '\\1' || chr(1), 'g'), chr(1))"


def word_count(x):
    return f"len(regexp_extract_all({x}, {rx(NON_SPACE + '+')}))"


def words(x):
    return f"regexp_extract_all({x}, {rx(NON_SPACE + '+')})"


def sentence_case(x):
    s = strip(x)
    return f"(upper(left({s}, 1)) || lower(substring({s}, 2)))"


def joined_text_sql(docs: str) -> str:
    """B1-B12 then C1, C8, C9 over ``docs(doc_id, text)``, one CTE per stage (no repeated sub-expressions)."""
    return f"""
SELECT doc_id, {strip_page_marks('text')} AS text FROM (
 SELECT doc_id, {sanitize('text')} AS text FROM (
  SELECT doc_id, {repair_text('text')} AS text FROM (
   SELECT doc_id, array_to_string(list_filter(list_transform(lines, lambda l: {clean_line('l')}),
          lambda l: {keep_line('l')}), ' ') AS text FROM (
    SELECT doc_id, {slice_between('lines')} AS lines FROM (
     SELECT doc_id, {split_lines('text')} AS lines FROM {docs})))))"""


def sentences_sql(joined: str) -> str:
    """C10 over ``joined(doc_id, text)`` -> ``(doc_id, sent_no, sentence)`` (0-based positions)."""
    return f"""
SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS sent_no, unnest(parts) AS sentence
FROM (SELECT doc_id, {split_sentences('text')} AS parts FROM ({joined}))"""


def clean_corpus_sql(docs: str, min_words: int = 3, max_words: int = 150) -> str:
    """C15 over a relation ``docs(doc_id, text)``."""
    return f"""
SELECT doc_id, sent_no, {sentence_case('sentence')} AS sentence FROM ({sentences_sql(joined_text_sql(docs))})
WHERE {word_count('sentence')} BETWEEN {min_words} AND {max_words}"""


def format_lines(x, n):
    w = f"regexp_extract_all(replace({x}, chr(10), ' '), {rx(NON_SPACE + '+')})"
    step = f"greatest({n}, 1)"
    return (
        f"(SELECT CASE WHEN len(w) = 0 THEN '' ELSE array_to_string(list_transform(range(0, len(w), {step}),"
        f" lambda i: array_to_string(w[i + 1:i + {step}], ' ')), chr(10)) END FROM (SELECT {w} AS w))"
    )


def md5_int(key_sql: str) -> str:
    return f"CAST(('0x' || substr(md5({key_sql}), 1, 8)) AS BIGINT)"
