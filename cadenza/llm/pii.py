"""Personal data: identifiers found in the text as it is, and in its deobfuscated form mapped back to the source.

Four transducers rewrite a text and keep, for every character of the result, the source characters it came from:
look-alike characters become ASCII, invisible ones go, spelled digits become digits, and at/dot disguises become @ and
a full stop.  Identifiers are then found again; what touches no identifier of the same kind already found is added
with its source offsets.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches_of, pick

KINDS = ("email", "ip", "card", "phone")

# The identifiers' patterns.  Digits before a match are excluded and runs are possessive only to keep
# long runs linear; the matches are those of the plain patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int]


def _emails(text: str) -> list[Span]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        end = _DOMAIN.match(text, at + 1) if start < at else None
        if end:
            found.append((start, end.end()))
            done = end.end()
        at = text.find("@", max(at + 1, done))
    return found


def _ips(text: str) -> list[Span]:
    def fits(part):
        return len(part := part.lstrip("0")) < 4 and int(part or "0") <= 255

    return [m.span() for m in _IP.finditer(text) if all(map(fits, m.group().split(".")))]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def _phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


def identifiers(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed; ends exclusive, in code points."""
    found = [(s, k, e) for k, kind in enumerate(KINDS) for s, e in _FINDERS[kind](text)]
    return [(s, e, KINDS[k]) for s, k, e in sorted(found)]


# Letters that look like ASCII ones, invisible characters, digits in words, and disguises.
_CYRILLIC = dict(zip("аеорсухіјѕԁһԛԝАВЕКМНОРСТХІЈЅ", "aeopcyxijsdhqwABEKMHOPCTXIJS"))
_GREEK = dict(zip("οαινρτυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "oaivptukABEZHIKMNOPTYX"))
_SIGNS = {
    "﹫": "@", "。": ".", "․": ".", "﹒": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-",
    "—": "-", "−": "-", " ": " ", " ": " ", " ": " ", " ": " ", " ": " ", "　": " ",
}
_INVISIBLE = "­​‌‍⁠﻿"
_DIGIT_WORDS = (
    ("zero", "oh", "null", "zéro", "cero"), ("one", "eins", "un", "uno"), ("two", "zwei", "zwo", "deux", "dos"),
    ("three", "drei", "trois", "tres"), ("four", "vier", "quatre", "cuatro"), ("five", "fünf", "cinq", "cinco"),
    ("six", "sechs", "seis"), ("seven", "sieben", "sept", "siete"), ("eight", "acht", "huit", "ocho"),
    ("nine", "neun", "neuf", "nueve"),
)
_AT = r"at|arroba|ät|chez"
_DOT = r"dot|punkt|point|punto"
_TOP_LEVEL = "com|org|net|edu|gov|mil|int|info|biz|io|co|ai|app|dev|eu|de|fr|es|it|uk|at|ch|nl|be|pt|pl|us|ca|au|in|jp|cn|br|mx|ru"

_DIGIT_OF = {w: str(d) for d, words in enumerate(_DIGIT_WORDS) for w in words}
_DIGIT_WORD = "|".join(sorted(_DIGIT_OF, key=len, reverse=True))
_SPELLED = re.compile(rf"(?<!\w)(?:{_DIGIT_WORD})(?:[\x20,.-]{{1,2}}(?:{_DIGIT_WORD}))+(?!\w)", re.I)
_ONE_SPELLED = re.compile(rf"(?:{_DIGIT_WORD})", re.I)
_PLUS = re.compile(r"(?<!\w)plus\x20(?=[0-9])", re.I)
_BRACKET_AT = re.compile(rf"\x20?[\[({{<]\x20?(?:{_AT}|@)\x20?[\])}}>]\x20?", re.I)
_BRACKET_DOT = re.compile(rf"\x20?[\[({{<]\x20?(?:{_DOT}|\.)\x20?[\])}}>]\x20?", re.I)
# A spoken address without brackets must end in a spoken dot and a usual top-level domain: "at" and "dot" are words too.
_SPOKEN = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20(?:{_DOT})\x20[A-Za-z0-9._%+-]++)*(?:\x20(?:{_AT})\x20|@)"
    rf"[A-Za-z0-9-]++(?:(?:\x20(?:{_DOT})\x20|\.)[A-Za-z0-9-]++)*?\x20(?:{_DOT})\x20(?:{_TOP_LEVEL})(?![A-Za-z0-9-])", re.I)
_SAID_AT, _SAID_DOT = re.compile(rf"\x20(?:{_AT})\x20", re.I), re.compile(rf"\x20(?:{_DOT})\x20", re.I)
_DIGIT_DOT = re.compile(rf"(?<=[0-9])\x20(?:{_DOT})\x20(?=[0-9])", re.I)
_SPACED_AT = re.compile(r"(?<=[A-Za-z0-9])\x20?@\x20?(?=[A-Za-z0-9])")
_HINT = re.compile(rf"[^\x00-\x7f]|[\[({{<]\x20?(?:{_AT}|{_DOT}|@|\.)|\x20(?:{_DOT})\x20|\x20@|@\x20|(?<!\w)(?:{_DIGIT_WORD})[\x20,.-]{{1,2}}(?:{_DIGIT_WORD})(?!\w)|{_PLUS.pattern}", re.I)


class _LookAlikes(dict):
    """Character to ASCII look-alike, worked out when first met."""

    def __missing__(self, code: int):
        char = chr(code)
        to = _CYRILLIC.get(char) or _GREEK.get(char) or _SIGNS.get(char)
        if to is None and code > 127:
            if (digit := unicodedata.decimal(char, None)) is not None:
                to = str(digit)
            elif 0xFF01 <= code <= 0xFF5E:
                to = chr(code - 0xFEE0)
            elif 0x1D400 <= code <= 0x1D7FF and len(plain := unicodedata.normalize("NFKC", char)) == 1 and plain.isascii():
                to = plain
        self[code] = ord(to) if to else code
        return self[code]


_LOOKS = _LookAlikes()


class Traced:
    """A rewritten text with the source span of each of its characters."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, range(len(text)), range(1, len(text) + 1)

    def rewrite(self, pattern: re.Pattern, to) -> bool:
        """Replaces each match by ``to(match)``; a replacement's characters all stand for the whole match."""
        pieces, starts, ends, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            put = to(m)
            if put is None:
                continue
            pieces += [self.text[at : m.start()], put]
            starts += [*self.starts[at : m.start()], *[self.starts[m.start()]] * len(put)]
            ends += [*self.ends[at : m.start()], *[self.ends[m.end() - 1]] * len(put)]
            at = m.end()
        if not pieces:
            return False
        self.text = "".join([*pieces, self.text[at:]])
        self.starts, self.ends = [*starts, *self.starts[at:]], [*ends, *self.ends[at:]]
        return True


def _digits(m: re.Match) -> str | None:
    found = [_DIGIT_OF[w.lower()] for w in _ONE_SPELLED.findall(m.group())]
    return "".join(found) if len(found) >= 3 else None


_PASSES = (
    (re.compile(f"[{_INVISIBLE}]"), lambda m: ""),
    (_SPELLED, _digits),
    (_PLUS, lambda m: "+"),
    (_BRACKET_AT, lambda m: "@"),
    (_BRACKET_DOT, lambda m: "."),
    (_SPOKEN, lambda m: _SAID_DOT.sub(".", _SAID_AT.sub("@", m.group()))),
    (_DIGIT_DOT, lambda m: "."),
    (_SPACED_AT, lambda m: "@" if len(m.group()) > 1 else None),
)


def disguised(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Identifiers that show only after deobfuscation, with source offsets; none that touches one of ``base``."""
    if not _HINT.search(text):
        return []
    plain = text.translate(_LOOKS) if not text.isascii() else text
    traced = Traced(plain)
    changed = plain != text
    for pattern, to in _PASSES:
        changed |= traced.rewrite(pattern, to)
    if not changed:
        return []
    # Spans of one kind don't overlap, so of those that begin before another's end only the last can touch it.
    taken = {kind: sorted((s, e) for s, e, k in base if k == kind) for kind in KINDS}
    added = []
    for s, e, kind in identifiers(traced.text):
        if kind in ("card", "phone") and len(set(_NOT_DIGIT.sub("", traced.text[s:e]))) == 1:
            continue  # a word repeated over and over is no number
        start, end, spans = traced.starts[s], traced.ends[e - 1], taken[kind]
        at = bisect.bisect_left(spans, (end,))
        if at and spans[at - 1][1] > start:
            continue
        added.append((start, end, kind))
        spans.insert(at, (start, end))
    return added


def _joined(spans: list[tuple[int, int, str]]) -> str:
    order = sorted(spans, key=lambda x: (x[0], KINDS.index(x[2])))
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in order)


_OUT = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
                  ("spans", pa.string()), ("n_disguised", pa.int64())])


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_disguised.

    ``base_sha256`` covers the identifiers found in the text as it is and the counts count them; ``spans`` also has
    the ``n_disguised`` found by deobfuscation, as kind:start:end by start, then kind, in code points, ends exclusive.
    A null text counts as empty and has no spans; repeated rows come back once each; an empty table gives no rows;
    other columns are not read.
    """
    def run(batches):
        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    text = text.as_py() or ""
                    base = identifiers(text)
                    more = disguised(text, base)
                    counts = [sum(k == kind for _, _, k in base) for kind in KINDS]
                    digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                    yield doc_id, *counts, digest, _joined(base + more), len(more)

        return batches_of(rows(), _OUT)

    ddl = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_disguised bigint"
    return pick(df, doc_id=id_col, text=text_col).mapInArrow(run, ddl)
