"""Column expressions for line filters (B), text repair (C1), sanitising (C2-C9) and sentence rules.

Everything here returns a ``Column`` built from JVM-side functions, so a whole cleaning chain is one projection without
Python (rules on the array of lines are lambdas, which Spark interprets; the text rules behind them are compiled).  Python ``str`` semantics are kept where they differ from Java:
Unicode whitespace (``str.isspace``), Unicode digits, ``.`` that stops only at ``\\n``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..options import GUTENBERG_END, GUTENBERG_START

# ---- Fixed values --------------------------------------------------------------------------------
# Code points for which Python's str.isspace() is true (Unicode White_Space plus U+001C..U+001F).
WS_CODEPOINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
WS_CHARS = "".join(chr(c) for c in WS_CODEPOINTS)
# The same set as a regex character-class body (valid in Java and RE2).
WS = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _one_of(codes) -> str:
    """Class body that names each code point by itself: Java keeps those below 256 in one table."""
    return "".join(f"\\x{c:02X}" for c in codes)


# The classes as the expressions below use them.  Java tests the parts of a class one after the other, so the table of
# the first 256 code points stands first and all others are tested only by characters beyond it.
_WIDE = r"[^\x00-\xFF]"
_WIDE_WS = r"\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_LOW_WS = [c for c in WS_CODEPOINTS if c < 256]
SPACE = f"[[{_one_of(_LOW_WS)}][{_WIDE}&&[{_WIDE_WS}]]]"
NON_SPACE = f"[[{_one_of(c for c in range(256) if c not in _LOW_WS)}][{_WIDE}&&[^{_WIDE_WS}]]]"

# Title lines (B7), other line and text patterns, and the characters kept by the whitelist.
TITLE_PATTERN = r"^The (First|Second|Third|Fourth|Fifth|Book|Gospel|Lamentations|Song) of"
BOOK_PATTERN = rf"(?iu)^BOOK{SPACE}+[IVXLC]+{SPACE}*\.?\z"
VERSE_REF_PATTERN = rf"^\p{{Nd}}{{1,3}}:\p{{Nd}}{{1,3}}{SPACE}*"
SUBTITLE_CUE_PATTERN = r"\p{Nd}\n\p{Nd}+:\p{Nd}+:\p{Nd}+,\p{Nd}+ --> \p{Nd}+:\p{Nd}+:\p{Nd}+,\p{Nd}+"
URL_PATTERN = rf"https?://{NON_SPACE}+"
SEE_MORE = "…see more"
IE_PATTERN = r"(?iu)\bi\.e\.\b"
EG_PATTERN = r"(?iu)\be\.g\.\b"
FOOTNOTE_PATTERN = rf"{SPACE}*\^({SPACE}*\p{{Nd}}+)?{SPACE}*"
BRACKET_PATTERN = r"(?d)\[.*?\]"
_LISTED = {ord(c) for c in string.ascii_letters + string.digits + ".,?!'-"}
WHITELIST_PATTERN = f"[[{_one_of(c for c in range(256) if c not in _LISTED and c not in _LOW_WS)}][{_WIDE}&&[^{_WIDE_WS}]]]+"
PAGE_PATTERN = r"Page \d+ of \d+"
CHAPTER_PATTERN = r"Chapter \d+"
LINE_BREAK = r"\r\n|\r|\n"
SENTENCE_BREAK = rf"{SPACE}(?<=[.?!]{SPACE}){SPACE}*"  # the blank first: most places fail at once

# C1 repair rules, applied in this order (stand-in for a per-row Unicode repair library).
MOJIBAKE_RULES = (
    ("â€™", "'"),
    ("â€˜", "'"),
    ("â€œ", '"'),
    ("â€\u009d", '"'),
    ("â€“", "-"),
    ("â€”", "-"),
    ("Â ", " "),
)
# HTML entities, only when the text holds no '<'; '&amp;' last so that one pass is made.
ENTITY_RULES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
)
LIGATURE_RULES = (
    ("ﬁ", "fi"),
    ("ﬂ", "fl"),
    ("ﬀ", "ff"),
    ("ﬃ", "ffi"),
    ("ﬄ", "ffl"),
)
# Full-width forms U+FF01..U+FF5E map to ASCII U+0021..U+007E; curly quotes to straight ones.
WIDE_FROM = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "‘’“”"
WIDE_TO = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + "''\"\""
WIDE_PATTERN = r"[\x{FF01}-\x{FF5E}‘’“”]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(c: Column, f) -> Column:
    """``f`` of ``c``, which is computed once however often ``f`` refers to it."""
    return F.element_at(F.transform(F.array(c), f), 1)


# ---- B: line rules --------------------------------------------------------------------------------
def py_strip(c: Column | str) -> Column:
    """``str.strip()``: trims the Unicode whitespace set, not just spaces."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def strip_verse_ref(c) -> Column:  # B3
    return F.regexp_replace(_c(c), VERSE_REF_PATTERN, "")


def strip_subtitle_cues(c) -> Column:  # B4 (document grain; the reference's line-grain rule never fires)
    return F.regexp_replace(_c(c), SUBTITLE_CUE_PATTERN, "")


def strip_urls(c) -> Column:  # B5
    return F.regexp_replace(_c(c), URL_PATTERN, "")


def strip_see_more(c) -> Column:  # B6
    return F.replace(_c(c), F.lit(SEE_MORE), F.lit(""))


def is_title_line(c) -> Column:  # B7
    return _c(c).rlike(TITLE_PATTERN)


def is_book_heading(c) -> Column:  # B8
    return _c(c).rlike(BOOK_PATTERN)


def is_digit_line(c) -> Column:  # B9
    return _c(c).rlike(r"^\p{Nd}+\z")


def is_upper(c) -> Column:
    """``str.isupper()``: some Uppercase character and no Lowercase or titlecase one."""
    c = _c(c)
    return c.rlike(r"\p{IsUppercase}") & ~c.rlike(r"[\p{IsLowercase}\p{Lt}]")


def is_short_caps(c, max_len: int = 40) -> Column:  # B10
    return (F.length(_c(c)) < max_len) & is_upper(c)


def has_min_letters(c, n: int = 5) -> Column:  # B11: ASCII letters, counted from the start until there are enough
    return _c(c).rlike(rf"\A(?:[^a-zA-Z]*+[a-zA-Z]){{{n}}}")


def clean_line(c) -> Column:
    """B2-B6 on one raw line: strip once, then the substitutions (no re-strip)."""
    return strip_see_more(strip_urls(strip_verse_ref(py_strip(c))))


def keep_line(c) -> Column:
    """B2, B7-B11 on a cleaned line.  A blank line has no letters, so B11 also covers B2."""
    c = _c(c)
    return (
        (c != "")
        & ~is_title_line(c)
        & ~is_book_heading(c)
        & ~is_digit_line(c)
        & ~is_short_caps(c)
        & has_min_letters(c)
    )


def split_lines(text) -> Column:
    """Document text to its lines; ``\\r\\n``, ``\\r`` and ``\\n`` each end a line."""
    return F.split(_c(text), LINE_BREAK, -1)


def slice_between(lines, start: str = GUTENBERG_START, end: str = GUTENBERG_END) -> Column:
    """B1 at document grain: lines strictly between the first START line and the first END line.

    Both markers must be present or nothing is cut; END before START leaves nothing.
    """
    def cut(lines):
        s = F.array_position(F.transform(lines, lambda x: x.contains(start)), True)
        e = F.array_position(F.transform(lines, lambda x: x.contains(end)), True)
        return bound(F.struct(s.alias("s"), e.alias("e")), lambda m: F.when((m["s"] > 0) & (m["e"] > 0), F.slice(
            lines, m["s"] + 1, F.greatest(m["e"] - m["s"] - 1, F.lit(0)))).otherwise(lines))

    return bound(_c(lines), cut)


def filter_lines(text, subtitle_cues: bool = False) -> Column:
    """B1-B12 at document grain: one projection, no shuffle.  Returns the surviving lines joined by a space."""
    t = _c(text)
    if subtitle_cues:
        t = strip_subtitle_cues(t)
    lines = slice_between(split_lines(t))
    kept = F.filter(F.transform(lines, clean_line), keep_line)
    return F.array_join(kept, " ")


# ---- C1: repair --------------------------------------------------------------------------------
def _replace_all(c: Column, rules) -> Column:
    for src, dst in rules:
        c = F.replace(c, F.lit(src), F.lit(dst))
    return c


def repair_text(c, has_less: Column | None = None) -> Column:
    """``has_less`` tells whether the whole text holds ``<`` where ``c`` is only a part of it."""
    def entities(t):
        less = t.contains("<") if has_less is None else has_less
        return F.when(less | ~t.contains("&"), t).otherwise(_replace_all(t, ENTITY_RULES))

    def letters(t):
        return F.when(t.rlike(WIDE_PATTERN), F.translate(t, WIDE_FROM, WIDE_TO)).otherwise(t)

    def repaired(t):  # all rules but the entities are about characters beyond ASCII
        ascii_only = F.octet_length(t) == F.length(t)
        return F.when(ascii_only, entities(t)).otherwise(
            bound(_replace_all(bound(_replace_all(t, MOJIBAKE_RULES), entities), LIGATURE_RULES), letters))

    return bound(_c(c), repaired)


# ---- C2-C9: sanitiser ----------------------------------------------------------------------------
def expand_abbrev(c) -> Column:  # C2, C3
    def expanded(t):  # few texts hold the letters between dots at all
        maybe = t.contains(".e.") | t.contains(".E.") | t.contains(".g.") | t.contains(".G.")
        return F.when(maybe, F.regexp_replace(F.regexp_replace(t, IE_PATTERN, "that is"), EG_PATTERN, "for example")).otherwise(t)

    return bound(_c(c), expanded)


def strip_footnotes(c) -> Column:  # C4
    return bound(_c(c), lambda t: F.when(t.contains("^"), F.regexp_replace(t, FOOTNOTE_PATTERN, " ")).otherwise(t))


def strip_brackets(c) -> Column:  # C5 (spans)
    return F.regexp_replace(_c(c), BRACKET_PATTERN, "")


def strip_quotes(c) -> Column:  # C5 (double quotes)
    return F.replace(_c(c), F.lit('"'), F.lit(""))


def whitelist(c) -> Column:  # C6
    return F.regexp_replace(_c(c), WHITELIST_PATTERN, "")


def squeeze(c) -> Column:  # C7: every whitespace run to one space, then strip (only spaces remain)
    return F.trim(F.regexp_replace(_c(c), f"{SPACE}+", " "))


def sanitize(c) -> Column:  # C8 = C2..C7 in order
    return squeeze(whitelist(strip_quotes(strip_brackets(strip_footnotes(expand_abbrev(c))))))


def strip_page_marks(c) -> Column:  # C9 (no second squeeze, as in the reference)
    return F.regexp_replace(F.regexp_replace(_c(c), PAGE_PATTERN, ""), CHAPTER_PATTERN, "")


def normalise_text(c) -> Column:
    """C1 -> C8 -> C9 on a joined document text."""
    return strip_page_marks(sanitize(repair_text(c)))


# ---- C10-C13: sentences ---------------------------------------------------------------------------
def split_sentences(c) -> Column:  # C10 (the reference's own fallback rule)
    return F.split(_c(c), SENTENCE_BREAK, -1)


def word_count(c) -> Column:
    """``len(s.split())`` without building the word array."""
    return F.regexp_count(_c(c), F.lit(f"{NON_SPACE}+"))


def has_words(c, lo: int, hi: int) -> Column:
    """``lo`` to ``hi`` words, counted once."""
    return bound(word_count(c), lambda n: n.between(lo, hi))


def words(c) -> Column:
    """``s.split()`` as an array (empty for an empty or blank string)."""
    return F.regexp_extract_all(_c(c), F.lit(f"{NON_SPACE}+"), 0)


def sentence_case(c) -> Column:  # C13: strip, first letter upper, rest lower
    s = py_strip(c)
    return F.concat(F.upper(F.left(s, F.lit(1))), F.lower(F.substring(s, 2, 2147483647)))
