"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Each source's target fixes how often its words are taken: target / size copies of each document, the whole part for
certain and the fraction as a probability.  Documents with a fraction are rounded against each other: two of one
source move words from one to the other, in a direction drawn so that each keeps its expected copies, until one of
them is all in or all out.  A group of at most about ``group_rows`` documents is folded this way into decided
documents and one undecided; the undecided of all groups are the next level's documents, until one for each source is
left.  So a source's taken words miss its target by less than that last document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import pick, small

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
GROUP_ROWS = 256
COPY_STEP = 4096  # equal rows are numbered in steps, so that no list of numbers is long
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"

_IDX_BITS = 33  # monotonically_increasing_id: partition << 33 | row


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, column: str, name: str = "rank") -> DataFrame:
    """Adds ``name``: 0-based position by ``column``, null last; ties stand in any order, fixed by a checkpoint.

    Rows are dealt by range; only one count for each partition is read by the driver.
    """
    order = [F.col(f"`{column}`").isNull(), F.col(f"`{column}`")]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    part, row = f"{name}_part", f"{name}_row"
    rows = cut_lineage(rows.select("*", F.shiftright(at, _IDX_BITS).alias(part), at.bitwiseAND((1 << _IDX_BITS) - 1).alias(row)))
    before, starts = 0, []
    for p, count in sorted(tuple(x) for x in rows.groupBy(part).count().collect()):
        starts += [F.lit(p), F.lit(before)]
        before += count
    if not starts:
        return rows.drop(part, row).withColumn(name, F.lit(0).cast("long"))
    return rows.withColumn(name, F.create_map(*starts)[F.col(part)] + F.col(row)).drop(part, row)


def targets_of(sources: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Adds weight and target to (source, source_size, n): shares by weight of the sum of all sizes.

    A target stops at ``max_copies`` times its source; what is over is shared again by weight among the others,
    until none is above.  Each round of that is one aggregation.
    """
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = cut_lineage(ranked(sources, "source").withColumn("weight", weight).drop("rank")
                       .withColumn("cap", (F.col("source_size") * max_copies).cast("double")))
    total = float(rows.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        free, held, n = rows.agg(F.sum(F.when(~over, F.col("weight"))), F.sum(F.when(over, F.col("cap"))), F.count(F.when(over, 1))).first()
        if n == capped or not free:
            break
        level, capped = (total - (held or 0.0)) / free, n
    return rows.withColumn("target", F.least("cap", F.col("weight") * F.lit(level))).drop("cap")


def _draw(seed: int, level: int, *columns: str) -> F.Column:
    """A uniform number in [0, 1) that depends on the row alone, so reruns and retried tasks agree."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(level), *columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


# One step of the fold.  The undecided document (id, a, m) has m of its a words in; e comes with e.m of its e.a.
# Either in = least(a - m, e.m) words move to the undecided one, or out = least(m, e.a - e.m) words away from it; the
# first with probability out / (in + out), which keeps the expected words of both.
_ROUND = """
aggregate(
  docs,
  named_struct('has', false, 'id', cast(null as bigint), 'a', 0L, 'm', 0D, 'done', cast(array() as array<struct<id: bigint, size: bigint, up: boolean>>)),
  (s, e) -> CASE
    WHEN NOT s.has THEN named_struct('has', true, 'id', e.id, 'a', e.size, 'm', e.m, 'done', s.done)
    WHEN e.u * (least(s.a - s.m, e.m) + least(s.m, e.size - e.m)) < least(s.m, e.size - e.m) THEN CASE
      WHEN s.a - s.m < e.m THEN named_struct('has', true, 'id', e.id, 'a', e.size, 'm', e.m - (s.a - s.m), 'done', concat(s.done, array(named_struct('id', s.id, 'size', s.a, 'up', true))))
      WHEN s.a - s.m > e.m THEN named_struct('has', true, 'id', s.id, 'a', s.a, 'm', s.m + e.m, 'done', concat(s.done, array(named_struct('id', e.id, 'size', e.size, 'up', false))))
      ELSE named_struct('has', false, 'id', cast(null as bigint), 'a', 0L, 'm', 0D, 'done', concat(s.done, array(named_struct('id', s.id, 'size', s.a, 'up', true), named_struct('id', e.id, 'size', e.size, 'up', false))))
    END
    ELSE CASE
      WHEN s.m < e.size - e.m THEN named_struct('has', true, 'id', e.id, 'a', e.size, 'm', e.m + s.m, 'done', concat(s.done, array(named_struct('id', s.id, 'size', s.a, 'up', false))))
      WHEN s.m > e.size - e.m THEN named_struct('has', true, 'id', s.id, 'a', s.a, 'm', s.m - (e.size - e.m), 'done', concat(s.done, array(named_struct('id', e.id, 'size', e.size, 'up', true))))
      ELSE named_struct('has', false, 'id', cast(null as bigint), 'a', 0L, 'm', 0D, 'done', concat(s.done, array(named_struct('id', s.id, 'size', s.a, 'up', false), named_struct('id', e.id, 'size', e.size, 'up', true))))
    END
  END
)
"""


def pivotal(rows: DataFrame, group_rows: int = GROUP_ROWS, seed: int = SEED) -> DataFrame:
    """(key, id, size, up) from (key, id, size, m): rounds each m, between 0 and size, to 0 or size.

    The sum of the rounded words of a key differs from the sum of its m by less than one document.
    """
    decided, level = [], 0
    # Rows equal in everything get numbers, so that they too are dealt into many groups.
    same = rows.groupBy("key", "id", "size", "m").agg(F.count(F.lit(1)).alias("n"))
    part = same.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPY_STEP}"))).alias("part"))
    last = F.least(F.col("n") - 1, (F.col("part") + 1) * COPY_STEP - 1)
    rows = cut_lineage(part.select("key", "id", "size", "m", F.explode(F.sequence(F.col("part") * COPY_STEP, last)).alias("copy")))
    while True:
        # What each key still has decides how many groups it is dealt into, so no group is large.
        counts = small(cut_lineage(rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(group_rows)).alias("groups"))))
        most = counts.agg(F.max("groups")).first()[0]
        if most is None:
            break
        same = rows["key"].eqNullSafe(counts["key"])
        dealt = rows.join(counts, same).drop(counts["key"])
        own = ("key", "id", "size", "m", "copy")
        dealt = dealt.withColumn("u", _draw(seed, level, *own))
        dealt = dealt.withColumn("grp", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), *own), F.col("groups")))
        docs = F.array_sort(F.collect_list(F.struct("u", "id", "size", "m"))).alias("docs")
        folded = cut_lineage(dealt.groupBy("key", "grp").agg(docs).select("key", "grp", F.expr(_ROUND).alias("s")))
        decided.append(folded.select("key", F.inline("s.done")))
        rows = folded.where("s.has").select("key", F.col("s.id").alias("id"), F.col("s.a").alias("size"), F.col("s.m").alias("m"), F.col("grp").alias("copy"))
        level += 1
        if most <= 1:
            up = _draw(seed, level, "key", "id", "size", "m") * F.col("size") < F.col("m")
            decided.append(rows.select("key", "id", "size", up.alias("up")))
            break
    if not decided:
        return rows.select("key", "id", "size", F.lit(False).alias("up"))
    out = decided[0]
    for more in decided[1:]:
        out = out.union(more)
    return out


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        max_copies: int = MAX_COPIES, group_rows: int = GROUP_ROWS, seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken.

    ``size`` counts the words of the text (null: 0).  Sources are taken by code point, null last, and weigh
    ``weights``, repeating.  A document is taken a whole number of times, at most ``max_copies``, and every source's
    taken words miss its target by less than one of its documents.  Documents without words are taken 0 times.
    Repeated rows and null ids are documents like any other; an empty table gives no rows; other columns are not read.
    """
    docs = pick(df, doc_id=id_col, text=text_col, source=source_col)
    docs = cut_lineage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    sources = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = cut_lineage(targets_of(sources, weights, max_copies))
    # Copies for each word of the source; a target within rounding of a whole number is that number.
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rate = F.when(F.abs(rate - F.round(rate)) < 1e-9, F.round(rate)).otherwise(rate)
    sources = sources.withColumn("whole", F.floor(rate)).withColumn("part", rate - F.floor(rate))
    keyed = small(sources.select(F.struct("source").alias("key"), "source_size", "target", "whole", "part"))
    docs = docs.withColumn("key", F.struct("source"))
    rated = docs.join(keyed.select("key", "part"), "key")
    loose = (F.col("part") > 0) & (F.col("size") > 0)
    open_rows = rated.where(loose).select("key", F.col("doc_id").alias("id"), "size", (F.col("size") * F.col("part")).alias("m"))
    rounded = pivotal(open_rows, group_rows, seed)
    settled = rated.where(~loose).select("key", F.col("doc_id").alias("id"), "size", F.lit(False).alias("up"))
    every = settled.union(rounded).join(keyed.drop("part"), "key")
    copies = F.col("whole") + F.col("up").cast("long")
    return every.select(
        F.col("id").alias("doc_id"), F.col("key.source").alias("source"), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"))
