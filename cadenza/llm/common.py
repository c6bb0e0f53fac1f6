"""Helpers shared by the operators: reading columns, Arrow batches, scratch tables and graph components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under the operator's own names, so that other columns can't clash."""
    return df.select(*(F.col(f"`{src}`").alias(name) for name, src in columns.items()))


def batches_of(rows: Iterator[tuple], schema: pa.Schema, max_rows: int = 4096, max_bytes: int = 16 << 20,
               weight=None) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded size from row tuples; ``weight(row)`` gives a row's bytes where rows can be large."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row) if weight else 0
        if len(held) >= max_rows or size >= max_bytes:
            yield to_batch(held, schema)
            held, size = [], 0
    if held:
        yield to_batch(held, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def as_rows(df: DataFrame) -> DataFrame:
    """All columns as one struct ``row``, for tasks that hand rows on and add a column beside them."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def with_row(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """Schema of ``as_rows(df)`` with one more column."""
    return T.StructType([T.StructField("row", df.schema), T.StructField(name, kind)])


def row_strings(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """UTF-8 bytes of a string field of ``row``, null as empty."""
    return [b or b"" for b in batch.column("row").field(name).cast(pa.binary()).to_pylist()]


def bytes_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b or b"" for b in batch.column(name).cast(pa.binary()).to_pylist()]


def written(df: DataFrame, name: str) -> DataFrame:
    """A Parquet copy of ``df`` in the shared scratch folder: cuts lineage for tables with whole texts."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def small(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Broadcast a table after counting it; beyond ``max_rows`` rows it is joined with a shuffle."""
    return F.broadcast(df) if df.count() <= max_rows else df


def first_by_hash(rows: DataFrame, n: int, *columns: str) -> DataFrame:
    """The ``n`` rows with the smallest hash of ``columns``, or all where there are fewer.

    The rows are counted first, and only about ``2 * n`` of them, whatever the input, take part in the choice.
    """
    draw = F.pmod(F.xxhash64(*columns), F.lit(1 << 52))
    share = (2 * n + 50) / max(1, rows.count())
    some = rows.where(draw < int(share * (1 << 52))) if share < 1 else rows
    return some.orderBy(draw, *columns).limit(n)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u, v): one row (node, root) per node, root the smallest node reachable.

    Alternates large-star and small-star steps until nothing changes.  A step is an aggregation with map-side
    combine and a join back on the node, which Spark may split where one node has very many neighbours.  Every
    step's edges are checkpointed in the shared folder.
    """
    def directed(e):
        return e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def mark(e):
        return e.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()

    edges = cut_lineage(directed(edges))
    seen = mark(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = directed(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rows = large.join(least, "u")
        edges = cut_lineage(directed(rows.select("u", F.col("m").alias("v")).union(rows.select(F.col("v").alias("u"), F.col("m").alias("v")))))
        now = mark(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return nodes.union(nodes.select(F.col("root").alias("node"), "root").distinct())
