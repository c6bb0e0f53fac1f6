"""Learn sub-word merges (byte-pair encoding, Sennrich et al. 2016).

Spark counts the distinct words of every group.  A group of at most ``TASK_WORDS`` of them, whatever the corpus behind
it, is merged by one task with an inverted index: pair -> words that hold it, and a heap of pair counts of which each
merge touches only the words of its pair.  Larger groups are merged by a loop of aggregations, a merge a round: adjacent
pairs are counted with partial aggregation, the best pair of every group is one ``min_by`` (count desc, left asc, right
asc), and the words are rewritten with a left-to-right fold.  Both ways end once the best pair occurs fewer than twice.
"""

from __future__ import annotations

import array
import heapq
import itertools
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_if_few, cut_lineage, stored
from .training import tokens

TASK_WORDS = 4_000_000  # distinct words that one task merges, at some 250 bytes each
END = "</w>"


def word_symbols(word) -> F.Column:
    """Characters of a word, the end mark attached to the last one."""
    chars = F.regexp_extract_all(F.col(word) if isinstance(word, str) else word, F.lit("."), 0)
    return F.concat(F.slice(chars, 1, F.size(chars) - 1), F.array(F.concat(F.element_at(chars, -1), F.lit(END))))


def word_table(sentences: DataFrame, col: str = "sentence", group_cols=("model",)) -> DataFrame:
    """``(group, word, freq, symbols)`` of the distinct words.  They are cut off before their symbols are made: conditions
    on the symbols would be moved below the count otherwise, and every occurrence of a word be taken apart."""
    g = list(group_cols)
    words = sentences.select(*g, F.explode(tokens(col)).alias("word")).groupBy(*g, "word").agg(F.count(F.lit(1)).alias("freq"))
    return stored(words, "words").withColumn("symbols", word_symbols("word"))


def pair_counts(words: DataFrame, group_cols=("model",)) -> DataFrame:
    g = list(group_cols)
    n = F.size("symbols") - 1
    pairs = F.arrays_zip(F.slice("symbols", 1, n).alias("left"), F.slice("symbols", 2, n).alias("right"))
    ex = words.filter(F.size("symbols") > 1).select(*g, "freq", F.inline(pairs))
    return ex.groupBy(*g, "left", "right").agg(F.sum("freq").alias("n"))


def _merge(symbols, left, right) -> F.Column:
    def step(acc, x):
        hit = (F.size(acc) > 0) & (F.element_at(acc, -1) == left) & (x == right)
        return F.when(hit, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat(left, right)))).otherwise(
            F.concat(acc, F.array(x))
        )

    return F.aggregate(symbols, F.array().cast("array<string>"), step)


def merges_of(names: list[str], symbols: np.ndarray, lengths: np.ndarray, freqs: np.ndarray, k: int | None = None):
    """(left, right, n) of each merge of some words, best pair first.  ``symbols`` are the words' symbols behind each
    other, as places in ``names``; ``lengths`` and ``freqs`` are the words'.

    A symbol takes four numbers (itself, its neighbours, its word) and one for each pair it began; no object.
    """
    total, ends = len(symbols), np.cumsum(lengths)
    word = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    after, before = np.arange(1, total + 1, dtype=np.int32), np.arange(-1, total - 1, dtype=np.int32)
    after[ends[lengths > 0] - 1] = -1
    before[(ends - lengths)[lengths > 0]] = -1
    at = np.flatnonzero(after >= 0).astype(np.int32)
    pairs = symbols[at].astype(np.int64) << 32 | symbols[at + 1]
    order = np.argsort(pairs, kind="stable")
    at, pairs = at[order], pairs[order]
    del order
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, np.int64)
    sums = np.add.reduceat(freqs[word[at]], first) if len(first) else first
    keys = pairs[first].tolist()
    del pairs
    counts: dict[int, int] = dict(zip(keys, sums.tolist()))
    # Where each pair stood when the words were whole, and where it has come up since.
    place = dict(zip(keys, zip(first.tolist(), [*first[1:].tolist(), len(at)])))
    since: dict[int, array.array] = {}
    at, sym, nxt, prv, of = (array.array("i", x.astype(np.int32).tobytes()) for x in (at, symbols, after, before, word))
    names = list(names)
    number = {x: j for j, x in enumerate(names)}
    del after, before, word, symbols, keys, first, sums
    low = (1 << 32) - 1
    # Counts in the heap may be out of date: an entry counts only if it is its pair's present one.
    heap = [(-n, names[pair >> 32], names[pair & low], pair) for pair, n in counts.items() if n >= 2]
    heapq.heapify(heap)
    for _ in itertools.count() if k is None else range(k):
        while heap and counts.get(heap[0][3], 0) != -heap[0][0]:
            heapq.heappop(heap)
        if not heap:
            return
        n, left, right, pair = heapq.heappop(heap)
        yield left, right, -n
        merged = left + right
        if merged not in number:
            number[merged] = len(names)
            names.append(merged)
        m, a, b = number[merged], pair >> 32, pair & low
        changed: dict[int, int] = {}
        found = since.pop(pair, ())
        if pair in place:
            begin, end = place.pop(pair)
            found = itertools.chain(at[begin:end], found)
        for p in sorted(set(found)):  # from left to right within a word
            q = nxt[p]
            if sym[p] != a or q < 0 or sym[q] != b:  # an earlier merge took it
                continue
            f, o, r = int(freqs[of[p]]), prv[p], nxt[q]
            changed[pair] = changed.get(pair, 0) - f
            if o >= 0:
                x, y = sym[o] << 32 | a, sym[o] << 32 | m
                changed[x] = changed.get(x, 0) - f
                changed[y] = changed.get(y, 0) + f
                since.setdefault(y, array.array("i")).append(o)
            if r >= 0:
                x, y = b << 32 | sym[r], m << 32 | sym[r]
                changed[x] = changed.get(x, 0) - f
                changed[y] = changed.get(y, 0) + f
                since.setdefault(y, array.array("i")).append(p)
                prv[r] = p
            sym[p], sym[q], nxt[p] = m, -1, r
        for x, by in changed.items():
            now = counts[x] = counts.get(x, 0) + by
            if now >= 2 and by:
                heapq.heappush(heap, (-now, names[x >> 32], names[x & low], x))
            elif not now:
                del counts[x]
                since.pop(x, None)
                place.pop(x, None)


def _in_task(words: DataFrame, k: int | None, g: list[str]) -> DataFrame:
    new = (("rank", T.IntegerType()), ("left", T.StringType()), ("right", T.StringType()), ("n", T.LongType()))
    schema = T.StructType([*words.select(*g).schema.fields, *(T.StructField(c, t) for c, t in new)])
    return words.groupBy(*g).applyInArrow(partial(_merged, k, g), schema)


def _merged(k: int | None, g: list[str], group):
    import pyarrow as pa
    import pyarrow.compute as pc

    symbols = group["symbols"].combine_chunks()
    flat = symbols.flatten().dictionary_encode()
    lengths = pc.list_value_length(symbols).to_numpy(zero_copy_only=False).astype(np.int64)
    found = list(merges_of(flat.dictionary.to_pylist(), flat.indices.to_numpy(zero_copy_only=False), lengths, group["freq"].to_numpy(), k))
    columns = {c: pa.array([group[c][0].as_py()] * len(found), group.schema.field(c).type) for c in g}
    columns["rank"] = pa.array(range(1, len(found) + 1), pa.int32())
    columns |= {c: pa.array([m[j] for m in found], t) for j, (c, t) in enumerate((("left", pa.string()), ("right", pa.string()), ("n", pa.int64())))}
    return pa.table(columns)


def learn_bpe(words: DataFrame, k: int | None = None, group_cols=("model",), task_words: int = TASK_WORDS) -> DataFrame:
    """``(group, rank, left, right, n)``: merges until a group's best pair occurs fewer than twice, or the first
    ``k`` (the vocabulary size wanted) where ``k`` is given.  Groups of more than ``task_words`` distinct words are
    merged by rounds over all tasks."""
    g = list(group_cols)
    words = stored(words.select(*g, "symbols", "freq"), "symbols")
    sizes = words.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
    sizes = cut_lineage(sizes.select(*g, (F.col("_n") > task_words).alias("_large")))
    words = words.join(broadcast_if_few(sizes), g)
    out = _in_task(words.where("not _large").drop("_large"), k, g)
    if sizes.where("_large").isEmpty():
        return out
    return out.unionByName(_by_rounds(words.where("_large").drop("_large"), k, g))


def _by_rounds(words: DataFrame, k: int | None, g: list[str]) -> DataFrame:
    words, merges = cut_lineage(words), []
    both = F.array_contains("symbols", F.col("_l")) & F.array_contains("symbols", F.col("_r"))  # few words are rewritten
    for rank in itertools.count(1) if k is None else range(1, k + 1):
        best = pair_counts(words, g).groupBy(*g).agg(
            F.min_by(F.struct("left", "right", "n"), F.struct(-F.col("n"), F.col("left"), F.col("right"))).alias("b")
        ).select(*g, F.lit(rank).alias("rank"), "b.left", "b.right", "b.n").filter(F.col("n") >= 2)
        # A row per group.  The driver keeps these and no plans: those of all rounds together would fill its memory.
        schema, found = best.schema, best.collect()
        merges += found
        if not found:
            break
        chosen = F.broadcast(words.sparkSession.createDataFrame(found, schema).select(*g, F.col("left").alias("_l"), F.col("right").alias("_r")))
        words = cut_lineage(words.join(chosen, g, "left").select(
            *g, F.when(both, _merge(F.col("symbols"), F.col("_l"), F.col("_r"))).otherwise(F.col("symbols")).alias("symbols"), "freq"
        ))
    return words.sparkSession.createDataFrame(merges, schema)
