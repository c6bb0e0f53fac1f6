"""Substring dedup by hashing units: the lines of a text, long lines cut further at sentence ends.

Units are normalised (lower case, one blank between words) and hashed: each with its right neighbour, and a unit of
``min_words`` or more also by itself.  Digests are grouped over the whole corpus and the earliest occurrence, by document
id and place, is the one that stays.  Any other occurrence is a repeat.  Repeats are removed as runs: consecutive units
that are consecutive, in the same order, in the one earlier document too, with ``min_words`` or more between them.  A
unit that merely occurs somewhere never goes, and neither does a chain of units gathered from several documents.  Removed
runs are returned with their offsets in the original text.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import batches_of, pick

MIN_WORDS = 20

# Where units end: at line feeds and behind sentence marks; scripts written without blanks.
_CUT = re.compile(r"\n+|(?<=[.!?…])[\x20\t]+|(?<=[。！？])")
_UNSPACED = re.compile(r"([ก-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U000323af])")

_KEY = pa.schema([("key", pa.int64()), ("version", pa.int64()), ("unit", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
                  ("words", pa.int32()), ("after", pa.int32()), ("hi", pa.int64()), ("lo", pa.int32()), ("own", pa.int32())])
_KEY_DDL = "key bigint, version bigint, unit int, start int, end int, words int, after int, hi bigint, lo int, own int"
_OUT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_removed_units", pa.int64()), ("n_removed_words", pa.int64()),
                  ("removed", pa.string()), ("first_ids", pa.list_(pa.int64()))])
_OUT_DDL = "doc_id bigint, text string, n_removed_units bigint, n_removed_words bigint, removed string, first_ids array<bigint>"
_LAST = (1 << 63) - 1  # stands for a null id, which ranks last


def words_of(unit: str) -> list[str]:
    """Normalised words; in scripts without blanks each character is one."""
    low = unit.lower()
    return (low if low.isascii() else _UNSPACED.sub(r" \1 ", low)).split()


def units_of(text: str):
    """(start, end, normalised words) of each unit with words; offsets in code points, end exclusive."""
    at = 0
    for m in _CUT.finditer(text):
        if words := words_of(text[at : m.end()]):
            yield at, m.end(), words
        at = m.end()
    if words := words_of(text[at:]):
        yield at, len(text), words


def _keys(min_words: int):
    """Rows of a text's digests.  ``after`` is the words of the neighbour hashed with a unit, 0 for a unit by itself;
    ``own`` the unit that holds the digest first in the same text, without overlap, else -1."""
    def of(text: str):
        units = [(start, end, len(words), " ".join(words)) for start, end, words in units_of(text)]
        seen: dict[bytes, int] = {}
        for k, (start, end, n, joined) in enumerate(units):
            alone = [(end, 0, joined)] if n >= min_words else []
            pair = [(units[k + 1][1], units[k + 1][2], f"{joined}\n{units[k + 1][3]}")] if k + 1 < len(units) else []
            for stop, after, content in alone + pair:
                digest = xxhash.xxh3_128_digest(content.encode("utf-8", "surrogatepass"))[:12]
                first = seen.setdefault(digest, k)
                own = first if k >= first + (2 if after else 1) else -1
                yield k, start, stop, n, after, int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True), own

    def run(batches):
        def rows():
            for batch in batches:
                for key, version, text in zip(*(batch.column(c) for c in ("key", "version", "text"))):
                    key, version = key.as_py(), version.as_py()
                    yield from ((key, version, *row) for row in of(text.as_py()))

        return batches_of(rows(), _KEY, max_rows=16384)

    return run


def runs_of(found: list[tuple], min_words: int) -> list[tuple[int, int, dict[int, int], set[int]]]:
    """(start, end, words by unit, first documents) of the runs of ``found``: (unit, after, start, end, words, first
    document, its unit) of each repeat."""
    runs, held = [], {}
    for unit, after, start, end, words, first, place in sorted(found, key=lambda r: r[:2]):
        here = {unit: words, unit + 1: after} if after else {unit: words}
        # Pairs whose first occurrences follow each other, in one document, make one run; a unit by itself is one.
        way = (first, place - unit)
        last = held.get(way)
        if after and last and unit in last[2]:
            last[1] = end
            last[2].update(here)
            continue
        run = [start, end, here, {first}]
        if after:
            held[way] = run
        runs.append(run)
    return [tuple(r) for r in runs if sum(r[2].values()) >= min_words]


def cut(text: str, found: list[tuple], min_words: int) -> tuple[str, int, int, list[tuple[int, int]], set[int]]:
    """What stays without the runs; removed units and words; the runs, merged where they overlap; first documents."""
    spans, gone, firsts = [], {}, set()
    for start, end, units, first in sorted(runs_of(found, min_words), key=lambda r: r[:2]):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
        gone.update(units)
        firsts |= first
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return "".join([*kept, text[at:]]), len(gone), sum(gone.values()), spans, firsts


def _cut_rows(min_words: int):
    names = ("unit", "after", "start", "end", "words", "first", "place")

    def run(batches):
        def rows():
            for batch in batches:
                for doc_id, text, found in zip(*(batch.column(c) for c in ("doc_id", "text", "found"))):
                    found = [tuple(r[n] for n in names) for r in found.as_py() or ()]
                    text, units, words, spans, firsts = cut(text.as_py(), found, min_words)
                    yield doc_id.as_py(), text, units, words, ",".join(f"{s}:{e}" for s, e in spans), sorted(firsts - {_LAST})

        return batches_of(rows(), _OUT, weight=lambda r: len(r[1]))

    return run


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, version, found): the repeats of each row of ``docs`` (key, version, text) that has any."""
    keys = docs.mapInArrow(_keys(min_words), _KEY_DDL)
    # The earliest occurrence as one number, so that it combines before the shuffle in a hash table.
    rank = F.col("key").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("unit")
    first = keys.where("own < 0").groupBy("hi", "lo").agg(F.min(rank).alias("rank"), F.count(F.lit(1)).alias("n")).where("n > 1")
    low = F.expr("cast(pmod(rank, cast(4294967296 as decimal(10,0))) as int)").alias("place")
    high = F.expr("cast(floor(rank / cast(4294967296 as decimal(10,0))) as bigint)").alias("first")
    # Checkpointed, so that the join is one of two shuffles and Spark may split a digest that very many rows share.
    first = cut_lineage(first.select("hi", "lo", high, low))
    known = keys.join(first, ["hi", "lo"], "left").where("key > first or own >= 0")
    across = F.col("key") > F.coalesce("first", F.lit(_LAST))
    entry = F.struct("unit", "after", "start", "end", "words", F.when(across, F.col("first")).otherwise(F.col("key")).alias("first"),
                     F.when(across, F.col("place")).otherwise(F.col("own")).alias("place"))
    return known.groupBy("key", "version").agg(F.collect_set(entry).alias("found"))


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per input row: doc_id, text, n_removed_units, n_removed_words, removed, first_ids.

    ``text`` is what stays (null counts as empty), ``removed`` the runs taken out as start:end in code points of the
    original, comma-joined, ``first_ids`` the documents that hold them first.  Rows that share an id count as one
    document: what only they share stays, and rows equal in id and text get the same result.  Ids are 0 or more; a null
    id ranks last (its first occurrences have no id to name).  An empty table gives no rows; other columns are not read.
    """
    docs = pick(df, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("key"), F.xxhash64("text").alias("version"), "text")
    found = repeats(docs.select("key", "version", "text"), min_words)
    rows = docs.join(found, ["key", "version"], "left").select("doc_id", "text", "found")
    return rows.mapInArrow(_cut_rows(min_words), _OUT_DDL)
