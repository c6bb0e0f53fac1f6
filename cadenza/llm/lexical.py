"""Ranked lexical search over inverted lists that are cut into geometric blocks.

The documents are read once into a forward index, checkpointed in the shared folder: each document's length and its counts of the query terms.
Corpus statistics come from that table.  Tasks then take the documents in shards.  In a shard every term's posting list
is clustered by document similarity (a short random projection of each document's weighted terms; each posting goes to
the nearest of evenly chosen pivots of its list), and each cluster, a block, stores for every term the largest impact
that one of its documents has: the coordinatewise maximum.

An item's lists are visited from the largest possible contribution on.  A block is skipped only if its exact bound, the
sum of its maxima over the item's terms not yet visited, is below the item's current threshold, and the visit ends when
the bounds of all lists that are left sum to less than that.  Documents of other blocks are scored in full from the
forward index.  The best documents go from shard to shard with their threshold; a task hands on at most ``k`` rows for
each item, and those are ranked by a window whose input Spark limits before the shuffle.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import batches_of, bytes_column, pick

TOP = 50
BLOCK_TERMS = 1_000_000  # distinct terms of items that one pass sends to the tasks
SHARD_POSTINGS = 2_000_000
BLOCK_DOCS = 64
DIMENSIONS = 16
_LAST = (1 << 63) - 1  # stands for a null id, which ranks last

# What separates terms, as a byte table (letters A-Z are folded, bytes from 0x80 belong to terms).
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PIECE = 1 << 22


def term_counts(text: bytes) -> Counter:
    """Terms of a text with their counts; long texts are cut at separators and read piece by piece."""
    folded, at, counts = text.translate(_FOLD), 0, Counter()
    while at < len(folded):
        end = len(folded) if len(folded) - at <= _PIECE else folded.rfind(b" ", at, at + _PIECE)
        if end <= at:
            end = folded.find(b" ", at + _PIECE)
            end = len(folded) if end < 0 else end
        counts.update(folded[at:end].split())
        at = end
    return counts


class Items:
    """A bounded set of items: the vocabulary and each item's distinct term numbers."""

    def __init__(self, rows: list[tuple[int, list[bytes]]]):
        self.vocabulary: dict[bytes, int] = {}
        self.ids = [item for item, _ in rows]
        self.terms = [np.array([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms], np.int64) for _, terms in rows]


_ITEM_TERMS = pa.schema([("item", pa.int64()), ("terms", pa.list_(pa.binary()))])


def item_blocks(items: DataFrame, block_terms: int) -> list[DataFrame]:
    """(item, terms): distinct terms of each item, in as many blocks as their measured number asks for."""
    def terms(batches):
        def rows():
            for batch in batches:
                for item, text in zip(batch.column("item").to_pylist(), bytes_column(batch, "text")):
                    yield item, sorted(term_counts(text))

        return batches_of(rows(), _ITEM_TERMS, weight=lambda r: 32 * len(r[1]))

    found = items.where("item is not null").mapInArrow(terms, "item bigint, terms array<binary>")
    # Rows that share an id are one item.
    found = found.groupBy("item").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms"))
    found = found.where("size(terms) > 0")
    total = found.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = max(1, math.ceil(total / block_terms))
    return [found] if n == 1 else [found.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k) for k in range(n)]


_FORWARD = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])


def forward(docs: DataFrame, sent) -> DataFrame:
    """(doc_id, n, terms, tfs): every document with a term, its length and its counts of the items' terms."""
    def run(batches):
        vocabulary = sent.value.vocabulary

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), bytes_column(batch, "text")):
                    counts = term_counts(text)
                    if counts:
                        known = [(t, counts[w]) for w in counts.keys() & vocabulary.keys() if (t := vocabulary[w]) >= 0]
                        known.sort()
                        yield doc_id, counts.total(), [t for t, _ in known], [c for _, c in known]

        return batches_of(rows(), _FORWARD, weight=lambda r: 16 * len(r[2]))

    return docs.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after the other."""
    sizes = ends - starts
    total = int(sizes.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Shard:
    """Some documents: forward index, posting lists, and for a list, on its first visit, its blocks and their maxima."""

    def __init__(self, ids: list[int], lengths: list[int], terms: list[np.ndarray], tfs: list[np.ndarray], weights: np.ndarray,
                 n_docs: int, n_terms: int, block_docs: int = BLOCK_DOCS):
        self.ids, self.weights, self.block_docs = np.array(ids, np.int64), weights, block_docs
        sizes = np.array([len(t) for t in terms], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.terms = np.concatenate(terms).astype(np.int64)
        tf = np.concatenate(tfs).astype(np.int64)
        m = 100 - 50 + (50 * np.array(lengths, np.int64) * n_docs) // n_terms
        # A posting's impact is its term's weight times this.
        self.parts = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, sizes))
        order = np.argsort(self.terms, kind="stable")
        self.postings = np.repeat(np.arange(len(ids)), sizes)[order]
        self.bounds = np.searchsorted(self.terms[order], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)  # each list's largest impact
        filled = np.flatnonzero(np.diff(self.bounds))
        if len(filled):
            self.most[filled] = np.maximum.reduceat(self.parts[order], self.bounds[filled]) * weights[filled]
        self.places, self.blocks = None, {}

    def _placed(self) -> np.ndarray:
        """Each document's place: a fixed random projection of its weighted terms, scaled to length one."""
        if self.places is None:
            signs = np.random.default_rng(7).choice(np.array([-1.0, 1.0], np.float32), (len(self.weights), DIMENSIONS))
            strength = (self.parts * self.weights[self.terms]).astype(np.float32)
            filled = np.flatnonzero(self.ends > self.starts)
            places = np.zeros((len(self.ids), DIMENSIONS), np.float32)
            for d in range(DIMENSIONS):
                places[filled, d] = np.add.reduceat(strength * signs[self.terms, d], self.starts[filled])
            self.places = places / np.maximum(np.linalg.norm(places, axis=1, keepdims=True), 1e-9)
        return self.places

    def blocks_of(self, term: int):
        """(documents by block, block starts, summary starts, summary terms, summary maxima) of a posting list."""
        if term not in self.blocks:
            docs = self.postings[self.bounds[term] : self.bounds[term + 1]]
            n = -(-len(docs) // self.block_docs)
            nearest = np.zeros(len(docs), np.int64)
            if n > 1:
                places = self._placed()
                pivots = places[docs[:: self.block_docs]]
                for at in range(0, len(docs), 4096):
                    nearest[at : at + 4096] = (places[docs[at : at + 4096]] @ pivots.T).argmax(axis=1)
            order = np.argsort(nearest, kind="stable")
            docs = docs[order]
            starts = np.flatnonzero(np.diff(nearest[order], prepend=-1))
            self.blocks[term] = (docs, starts, *self._summaries(docs, starts))
        return self.blocks[term]

    def _summaries(self, docs: np.ndarray, starts: np.ndarray):
        """Coordinatewise maxima of each block, as sparse rows."""
        width = len(self.weights)
        ends = np.append(starts[1:], len(docs))
        step = max(1, 4_000_000 // width)
        heads, terms, most, n = [], [], [], 0
        for first in range(0, len(starts), step):
            s, e = starts[first : first + step], ends[first : first + step]
            inside = docs[s[0] : e[-1]]
            sizes = self.ends[inside] - self.starts[inside]
            places = _ranges(self.starts[inside], self.ends[inside])
            row = np.repeat(np.repeat(np.arange(len(s)), e - s), sizes)
            dense = np.zeros(len(s) * width, np.int64)
            np.maximum.at(dense, row * width + self.terms[places], self.parts[places])
            at = np.flatnonzero(dense)
            heads.append(np.searchsorted(at, np.arange(len(s)) * width) + n)
            terms.append((at % width).astype(np.int32))
            most.append(dense[at].astype(np.int32))
            n += len(at)
        return np.concatenate(heads), np.concatenate(terms), np.concatenate(most)

    def search(self, terms: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best (scores, ids) of ``best`` and this shard; scores of 0 and less are left out."""
        terms = terms[np.argsort(-self.most[terms], kind="stable")]
        terms = terms[self.most[terms] > 0]
        left = np.cumsum(self.most[terms][::-1])[::-1]
        full, rest = np.zeros(len(self.weights), np.int64), np.zeros(len(self.weights), np.int64)
        full[terms] = rest[terms] = self.weights[terms]
        seen = np.zeros(len(self.ids), bool)

        def threshold():
            return best[0][k - 1] if len(best[0]) >= k else 1

        for term, bound in zip(terms.tolist(), left.tolist()):
            if bound < threshold():
                break
            docs, starts, heads, s_terms, s_most = self.blocks_of(term)
            bounds = np.add.reduceat(rest[s_terms] * s_most, heads)
            rest[term] = 0
            ends = np.append(starts[1:], len(docs))
            order, at, step = np.argsort(-bounds, kind="stable"), 0, 4
            while at < len(order):
                some = order[at : at + step]
                some = some[bounds[some] >= threshold()]
                if not len(some):
                    break
                new = docs[_ranges(starts[some], ends[some])]
                new = new[~seen[new]]
                seen[new] = True
                best = self._better(best, new, full, k)
                at, step = at + step, step * 2
        return best

    def _better(self, best, docs: np.ndarray, weights: np.ndarray, k: int):
        if not len(docs):
            return best
        sizes = self.ends[docs] - self.starts[docs]
        places = _ranges(self.starts[docs], self.ends[docs])
        scores = np.add.reduceat(weights[self.terms[places]] * self.parts[places], np.cumsum(sizes) - sizes)
        floor = best[0][k - 1] if len(best[0]) >= k else 1
        good = scores >= floor
        scores, ids = np.concatenate((best[0], scores[good])), np.concatenate((best[1], self.ids[docs[good]]))
        order = np.lexsort((ids, -scores))[:k]
        return scores[order], ids[order]


_FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _search(sent, weights_sent, n_docs: int, n_terms: int, k: int, shard_postings: int, block_docs: int):
    def run(batches):
        items, weights = sent.value, weights_sent.value
        none = np.empty(0, np.int64)
        best = [(none, none)] * len(items.ids)

        def shards():
            held, size = ([], [], [], []), 0
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for row in zip(ids, batch.column("n").to_pylist(), batch.column("terms"), batch.column("tfs")):
                    terms = row[2].values.to_numpy()
                    if not len(terms):
                        continue
                    for column, value in zip(held, (_LAST if row[0] is None else row[0], row[1], terms, row[3].values.to_numpy())):
                        column.append(value)
                    size += len(terms)
                    if size >= shard_postings:
                        yield held
                        held, size = ([], [], [], []), 0
            if size:
                yield held

        for held in shards():
            shard = Shard(*held, weights, n_docs, n_terms, block_docs)
            best = [shard.search(terms, b, k) for terms, b in zip(items.terms, best)]

        def rows():
            for item, (scores, ids) in zip(items.ids, best):
                for score, id_ in zip(scores.tolist(), ids.tolist()):
                    yield item, None if id_ == _LAST else id_, score

        return batches_of(rows(), _FOUND)

    return run


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS,
           shard_postings: int = SHARD_POSTINGS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0, best first.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased.  Equal scores rank
    by id, null ids last; rows that repeat an id are documents of their own.  Item rows that share an id are one item
    with the terms of all; items without id, and null or empty texts, have none.  Empty tables give no rows; other
    columns are not read.
    """
    spark = docs.sparkSession
    docs = pick(docs, doc_id=id_col, text=text_col)
    out = None
    for block in item_blocks(pick(items, item=item_col, text=item_text_col), block_terms):
        # At most block_terms terms and one item more: the size that item_blocks has measured.
        rows = sorted((r["item"], [bytes(t) for t in r["terms"]]) for r in block.toLocalIterator())
        known = Items(rows)
        sent = spark.sparkContext.broadcast(known)
        index = cut_lineage(forward(docs, sent))  # in as many partitions as the documents
        n_docs, n_terms = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(known.vocabulary), np.int64)
        for r in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toLocalIterator():
            df[r["t"]] = r["df"]  # a row for each term of the block
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        task = _search(sent, spark.sparkContext.broadcast(weights), n_docs, n_terms, k, shard_postings, block_docs)
        found = index.mapInArrow(task, "item_id bigint, doc_id bigint, score bigint")
        out = found if out is None else out.union(found)
    first = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
