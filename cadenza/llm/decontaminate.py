"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document, as large text indexes are: each task stores, for its own documents, the sorted
positions of every benchmark term.  Every benchmark window is looked up in every shard: its terms are taken from the
rarest list in the shard to the commonest, each list is shifted by the term's offset in the window, and the shifted
lists are intersected until none is left or the whole phrase is proved.  With ``slop`` the shifted lists meet within
that many words, which gives proximity matches.  No posting crosses the network and a passage that many documents
share costs each shard only its own part.

The benchmark is the query set.  It is measured first and sent to the tasks in blocks of at most ``block_words``
words; a larger benchmark takes several passes.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, batches_of, pick, written

WINDOW_WORDS = 13
BLOCK_WORDS = 1_000_000
SEGMENT_WORDS = 8192  # an item is looked up in overlapping pieces of this many words
SHARD_TOKENS = 2_000_000
# What separates words, for bytes and as a pattern; a hit is contamination from one word in 20.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAMINATED_SHARE = 20

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_PIECE = 1 << 20


def _term_ids(text: bytes, vocabulary: dict[bytes, int]) -> np.ndarray:
    """Term numbers of a text's words, -1 where the benchmark lacks the word; long texts are read in pieces."""
    folded, get, parts, at = text.translate(_FOLD), vocabulary.get, [], 0
    while at < len(folded):
        end = len(folded) if len(folded) - at <= _PIECE else folded.rfind(b" ", at, at + _PIECE)
        if end <= at:
            end = folded.find(b" ", at + _PIECE)
            end = len(folded) if end < 0 else end
        found = [get(w, -1) for w in folded[at:end].split()]
        parts.append(np.array(found, dtype=np.int32))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


@dataclass
class Windows:
    """Distinct windows of a block of the benchmark: term numbers (-1 beyond a short window's end) and their items."""

    vocabulary: dict[bytes, int]
    terms: np.ndarray
    lengths: np.ndarray
    items: list[list[int]]


def windows_of(items: list[tuple[int, list[str]]], width: int) -> Windows:
    vocabulary: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[int]] = {}
    for item, words in items:
        ids = [vocabulary.setdefault(w.encode(), len(vocabulary)) for w in words]
        for at in range(max(1, len(ids) - width + 1)):
            found.setdefault(tuple(ids[at : at + width]), set()).add(item)
    terms = np.full((len(found), width), -1, np.int32)
    for row, key in enumerate(found):
        terms[row, : len(key)] = key
    return Windows(vocabulary, terms, (terms >= 0).sum(axis=1), [sorted(x) for x in found.values()])


class Shard:
    """Positional inverted index of some documents: for each benchmark term its sorted positions.

    Documents stand one after the other with a gap of a window, so that no match spans two of them.
    """

    def __init__(self, documents: list[np.ndarray], n_terms: int, gap: int):
        lengths = np.array([len(d) for d in documents], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(lengths + gap)))[:-1]
        self.end = int((lengths + gap).sum())
        known = [np.flatnonzero(d >= 0) for d in documents]
        where = np.concatenate([k + s for k, s in zip(known, self.starts)] or [np.empty(0, np.int64)])
        terms = np.concatenate([d[k] for d, k in zip(documents, known)] or [np.empty(0, np.int32)])
        order = np.argsort(terms, kind="stable")
        self.positions = where[order]
        self.bounds = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.counts = np.diff(self.bounds)

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.bounds[term] : self.bounds[term + 1]]

    def search(self, windows: Windows, slop: int = 0):
        """(window, its start positions, documents) of each window found; with ``slop``, within that many words."""
        if not len(windows.terms) or not len(self.positions):
            return
        sizes = np.where(windows.terms >= 0, self.counts[windows.terms], np.iinfo(np.int64).max)
        order = np.argsort(sizes, axis=1, kind="stable")
        for row in np.flatnonzero(sizes.min(axis=1) > 0).tolist():
            rarest = order[row, : windows.lengths[row]].tolist()
            terms = windows.terms[row]
            at = self.postings(terms[rarest[0]]) - rarest[0]
            if slop:
                at = np.unique(at[:, None] + np.arange(-slop, slop + 1))
            for offset in rarest[1:]:
                list_ = self.postings(terms[offset])
                aim = at + offset - slop
                seen = np.searchsorted(list_, aim)
                there = list_[np.minimum(seen, len(list_) - 1)] if len(list_) else np.full(len(aim), -1 << 40)
                at = at[(there >= aim) & (there <= aim + 2 * slop)]
                if not len(at):
                    break
            if len(at):
                # The rarest term stands within slop of its place, and the gaps are wider than that.
                yield row, at, np.searchsorted(self.starts, at + rarest[0] + slop, side="right") - 1


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int64())),
                  ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.int64())), ("near_items", pa.list_(pa.int64()))])
_OUT_DDL = "doc_id bigint, n_words bigint, starts array<bigint>, ends array<bigint>, items array<bigint>, near_items array<bigint>"


def _merged(starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """Union of intervals, ends exclusive."""
    out_s, out_e = [], []
    for s, e in sorted(zip(starts, ends)):
        if out_e and s <= out_e[-1]:
            out_e[-1] = max(out_e[-1], e)
        else:
            out_s.append(s)
            out_e.append(e)
    return out_s, out_e


def _search(sent, width: int, slop: int, shard_tokens: int):
    """Tasks: build a shard, look every window up, and give each document its word intervals and items."""
    def run(batches):
        windows: Windows = sent.value
        gap = width + 2 * slop + 1

        def shards():
            rows, held = [], 0
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                texts = batch.column("text").cast(pa.binary())
                before = batch.column("found").to_pylist() if "found" in batch.schema.names else [None] * len(ids)
                for doc_id, text, found in zip(ids, texts, before):
                    terms = _term_ids(text.as_py() or b"", windows.vocabulary)
                    rows.append((doc_id, terms, found))
                    held += len(terms)
                    if held >= shard_tokens:
                        yield rows
                        rows, held = [], 0
            if rows:
                yield rows

        def rows():
            for docs in shards():
                shard = Shard([t for _, t, _ in docs], len(windows.vocabulary), gap)
                starts: dict[int, list[int]] = {}
                ends: dict[int, list[int]] = {}
                items: dict[int, set[int]] = {}
                near: dict[int, set[int]] = {}
                for row, at, of in shard.search(windows):
                    length = int(windows.lengths[row])
                    for doc, start in zip(of.tolist(), (at - shard.starts[of]).tolist()):
                        starts.setdefault(doc, []).append(start)
                        ends.setdefault(doc, []).append(start + length)
                        items.setdefault(doc, set()).update(windows.items[row])
                if slop:
                    for row, _, of in shard.search(windows, slop):
                        for doc in np.unique(of).tolist():
                            near.setdefault(doc, set()).update(windows.items[row])
                for k, (doc_id, terms, found) in enumerate(docs):
                    old = found or {"starts": [], "ends": [], "items": [], "near_items": []}
                    s, e = _merged(old["starts"] + starts.get(k, []), old["ends"] + ends.get(k, []))
                    got = items.get(k, set()).union(old["items"])
                    yield doc_id, len(terms), s, e, sorted(got), sorted(near.get(k, set()).union(old["near_items"], got))

        return batches_of(rows(), _OUT)

    return run


def benchmark_blocks(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """(item, words) pieces of the benchmark, in as many blocks as its measured size asks for."""
    text = F.translate(F.coalesce("text", F.lit("")), ASCII_UPPER, ASCII_LOWER)
    words = F.filter(F.split(text, SEPARATORS), lambda w: w != "")
    items = benchmark.where("item is not null").select("item", words.alias("words")).where("size(words) > 0")
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    step = SEGMENT_WORDS
    pieces = items.select("item", F.posexplode(F.expr(
        f"transform(sequence(1, greatest(1, size(words) - {WINDOW_WORDS} + 1), {step}), s -> slice(words, s, {step} + {WINDOW_WORDS} - 1))"
    )).alias("piece", "words"))
    n = max(1, math.ceil(total / block_words))
    if n == 1:
        return [pieces.select("item", "words")]
    block = F.pmod(F.xxhash64("item", "piece"), F.lit(n))
    return [pieces.where(block == k).select("item", "words") for k in range(n)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", slop: int = 0,
                  block_words: int = BLOCK_WORDS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per document: doc_id, n_words, starts, ends, items, near_items.

    ``starts`` and ``ends`` are the document's words (end exclusive, merged) inside any exact occurrence of a window
    of ``WINDOW_WORDS`` consecutive words of an item; an item of fewer words, but not none, is one window.  ``items``
    are the ids with an occurring window, ``near_items`` with ``slop`` above zero also those with a window whose words
    all stand within ``slop`` words of their place.  Null texts have no words; benchmark rows without id are left out;
    repeated document rows come back once each; other columns are not read; an empty benchmark finds nothing.
    """
    spark = docs.sparkSession
    out = pick(docs, doc_id=id_col, text=text_col)
    blocks = benchmark_blocks(pick(benchmark, item=item_col, text=item_text_col), block_words)
    for k, block in enumerate(blocks):
        # At most block_words words and their overlaps: the size that benchmark_blocks has measured.
        items = [(row["item"], row["words"]) for row in block.toLocalIterator()]
        sent = spark.sparkContext.broadcast(windows_of(items, WINDOW_WORDS))
        found = _search(sent, WINDOW_WORDS, slop, shard_tokens)
        if k + 1 == len(blocks):
            return out.mapInArrow(found, _OUT_DDL)
        out = written(_keeping_text(out, found), "decontaminate")


def _keeping_text(docs: DataFrame, found) -> DataFrame:
    """One block's result beside the text, for the next block."""
    ddl = ("doc_id bigint, text string, found struct<n_words: bigint, starts: array<bigint>, ends: array<bigint>, "
           "items: array<bigint>, near_items: array<bigint>>")

    def run(batches):
        for batch in batches:
            done = pa.Table.from_batches(list(found(iter([batch]))), schema=_OUT).combine_chunks()
            inner = [done.column(c).combine_chunks() for c in _OUT.names[1:]]
            struct = pa.StructArray.from_arrays(inner, names=_OUT.names[1:])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), struct],
                                             names=["doc_id", "text", "found"])

    return docs.mapInArrow(run, ddl)


def report(found: DataFrame) -> DataFrame:
    """Counts and verdict per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * CONTAMINATED_SHARE >= F.col("n_words")))
