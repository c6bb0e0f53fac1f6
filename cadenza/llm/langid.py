"""Language ID of mixed-language text: scripts narrow the candidates, Viterbi labels the words.

A word's score for a language is the summed log probability of its letter trigrams, word ends included.  Languages
whose training text hardly uses the word's script are ruled out for it.  The best path over a document's words pays
``SWITCH`` for each change of language; runs of one language are the document's spans.  All steps run over many
documents at once in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import first_by_hash, pick

MAX_TRAIN_DOCS = 4000  # bound of the labelled sample that is fitted on the driver
BUCKETS = 1 << 17
SWITCH = 9.0
RARE_SCRIPT = 0.01  # a language is no candidate for scripts below this share of its letters
RULED_OUT = -50.0
PIECE_CHARS = 1 << 20
UNKNOWN = "und"

# Scripts by ranges of code points (first, last).
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F),)),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF),)),
    ("kana", ((0x3040, 0x30FF),)),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF))),
    ("hangul", ((0xAC00, 0xD7AF),)),
)
_TOP = 0x30000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-case letter (0: no letter), and the script (0: none of the list)."""
    fold, script = np.zeros(_TOP, np.int64), np.zeros(_TOP, np.int8)
    for code in range(_TOP):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            fold[code] = ord(low) if len(low) == 1 else code
    for number, (_, ranges) in enumerate(SCRIPTS, 1):
        for a, b in ranges:
            script[a : b + 1] = number
    return fold, script


_TABLES: list = []


def tables():
    if not _TABLES:
        _TABLES.extend(_tables())
    return _TABLES


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < _TOP, codes, 0)


@dataclass
class Words:
    """Words of some texts one after the other: trigram buckets by letter, and by word its place and script."""

    grams: np.ndarray
    first: np.ndarray  # index of each word's first letter in grams
    starts: np.ndarray  # offsets in the joined text
    ends: np.ndarray
    scripts: np.ndarray


def words_of(codes: np.ndarray) -> Words:
    """Runs of letters; ``codes`` must start and end without one."""
    fold, script = tables()
    low = fold[codes]
    letter = low > 0
    edge = np.diff(letter.astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    at = np.flatnonzero(letter)
    mixed = low[at - 1] * 0x9E3779B1 + low[at] * 0x85EBCA77 + low[at + 1] * 0xC2B2AE3D
    grams = (mixed ^ (mixed >> 17)) & (BUCKETS - 1)
    return Words(grams, np.concatenate(([0], np.cumsum(ends - starts)))[:-1], starts, ends, script[codes[starts]])


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # (BUCKETS, languages) log probabilities
    allowed: np.ndarray  # (scripts, languages) candidates

    def word_scores(self, words: Words) -> np.ndarray:
        """(words, languages); each word relative to its best language."""
        if not len(words.first):
            return np.empty((0, len(self.languages)), np.float32)
        sums = np.add.reduceat(self.scores[words.grams], words.first, axis=0)
        sums -= sums.max(axis=1, keepdims=True)
        return np.where(self.allowed[words.scripts], sums, sums + RULED_OUT).astype(np.float32)


def fit(rows: list[tuple[str, str]]) -> Model:
    """Model from (text, language) rows; add-one smoothed trigram shares for each language."""
    languages = sorted({lang for _, lang in rows}) or [UNKNOWN]
    counts = np.full((BUCKETS, len(languages)), 0.2)
    letters = np.zeros((len(SCRIPTS) + 1, len(languages)))
    for text, lang in rows:
        codes = np.concatenate(([0], _codes(text), [0]))
        words, k = words_of(codes), languages.index(lang)
        counts[:, k] += np.bincount(words.grams, minlength=BUCKETS)
        letters[:, k] += np.bincount(words.scripts, weights=words.ends - words.starts, minlength=len(SCRIPTS) + 1)
    share = letters / np.maximum(letters.sum(axis=0), 1)
    allowed = share >= RARE_SCRIPT
    allowed[~allowed.any(axis=1)] = True  # a script that nobody uses tells nothing
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32), allowed)


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Language number of each word on the best path; documents' words stand one after the other.

    All documents advance together, the longest first, so a step handles those that still have words.
    """
    n, k = len(lengths), scores.shape[1]
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = starts[order], lengths[order]
    longest = int(sizes[0]) if n else 0
    live = np.searchsorted(-sizes, -np.arange(longest), side="left")  # documents with over t words
    best = np.zeros((n, k), np.float32)
    stay = np.ones((len(scores), k), bool)
    came = np.zeros(len(scores), np.int16)
    for t in range(longest):
        m = live[t]
        at = starts[:m] + t
        if t:
            now = best[:m]
            top = now.argmax(axis=1)
            jump = now[np.arange(m), top][:, None] - switch
            keep = now >= jump
            stay[at], came[at] = keep, top
            best[:m] = np.where(keep, now, jump)
            # Only differences count: keeps long documents exact.
            best[:m] -= best[:m].max(axis=1, keepdims=True)
        best[:m] += scores[at]
    labels = np.zeros(len(scores), np.int16)
    state = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        m = live[t]
        at = starts[:m] + t
        labels[at] = state[:m]
        if t:
            state[:m] = np.where(stay[at, state[:m]], state[:m], came[at])
    return labels


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
_OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))])
_OUT_DDL = "doc_id bigint, lang_pred string, score double, spans array<struct<start: bigint, end: bigint, lang: string>>"


def _label(ids: list, texts: list[str], model: Model) -> pa.RecordBatch:
    """Spans and main language of some documents."""
    parts, owners, scores = [], [], []
    held, size = [], 0

    def flush():
        nonlocal held, size
        joined = np.concatenate([x for k in held for x in ([0], _codes(texts[k]))] + [[0]]).astype(np.int64)
        begins = np.cumsum([0] + [len(texts[k]) + 1 for k in held]) + 1
        words = words_of(joined)
        owner = np.searchsorted(begins, words.starts, side="right") - 1
        scores.append(model.word_scores(words))
        owners.append(owner + held[0])
        parts.append(np.stack([words.starts - begins[owner], words.ends - begins[owner]], axis=1))
        held, size = [], 0

    for k, text in enumerate(texts):
        held.append(k)
        size += len(text)
        if size >= PIECE_CHARS:
            flush()
    if held:
        flush()
    place, owner = np.concatenate(parts), np.concatenate(owners)
    lengths = np.bincount(owner, minlength=len(texts))
    labels = viterbi(np.concatenate(scores), lengths)
    letters = np.zeros((len(texts), len(model.languages)))
    np.add.at(letters, (owner, labels), place[:, 1] - place[:, 0])
    total = letters.sum(axis=1)
    top = letters.argmax(axis=1)
    names = np.array(model.languages, dtype=object)
    pred = np.where(total > 0, names[top], UNKNOWN)
    share = letters[np.arange(len(texts)), top] / np.maximum(total, 1)
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (labels[1:] != labels[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(owner)])) - 1 if len(first) else first
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owner[first], minlength=len(texts))))).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(place[first, 0]), pa.array(place[last, 1]), pa.array(names[labels[first]].tolist(), pa.string())], fields=list(_SPAN))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(pred.tolist(), pa.string()), pa.array(share), pa.ListArray.from_arrays(pa.array(offsets), spans)], schema=_OUT)


def detect(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, spans (start, end, lang; code points, ends exclusive).

    ``lang_pred`` is the language with most letters in the spans and ``score`` its share of the letters; ``und`` and
    0 where a text is null or has no letters.  Repeated rows come back once each; an empty table gives no rows; other
    columns are not read.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids.append(doc_id)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= 8 * PIECE_CHARS:
                    yield _label(ids, texts, sent.value)
                    ids, texts, size = [], [], 0
            if ids:
                yield _label(ids, texts, sent.value)

    return pick(df, doc_id=id_col, text=text_col).mapInArrow(run, _OUT_DDL)


def held_out(doc_id) -> F.Column:
    """Rows that never teach: crc32 of the id as text leaves 2 when divided by 4 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_rows(df: DataFrame, max_docs: int = MAX_TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> list[tuple[str, str]]:
    """At most ``max_docs`` rows that may teach and have a language, a hash of the id deciding which.

    This is the bound of the sample that is read by the driver; where fewer rows qualify, all are taken.
    """
    rows = pick(df, doc_id=id_col, text=text_col, lang=lang_col)
    rows = rows.where("lang is not null and text is not null").where(~held_out(F.col("doc_id")))
    rows = first_by_hash(rows, max_docs, "doc_id", "text")
    return [(r["text"], r["lang"]) for r in rows.select("text", "lang").collect()]
