"""Int8 quantisation of vector columns (I1-I3), the table form of dynamic weight quantisation.

``scale = max|x| / 127.5`` (per vector or per table), codes ``clamp(round_half_even(x / scale), -128, 127)``,
zero point 0, computed in DOUBLE.  An all-zero vector gets scale 1 and zero codes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QMAX = 127.5


def _as_double(col: str):
    return F.transform(F.col(col), lambda x: x.cast("double"))


def quantise(df: DataFrame, col: str = "embedding", scope: str = "vector") -> DataFrame:
    """Adds ``scale DOUBLE`` and ``q ARRAY<TINYINT>``.  ``scope='table'`` uses one scale for all rows
    (one global max: a single-row aggregate joined back as a broadcast of one row)."""
    xs = _as_double(col)
    if scope == "table":
        mx = df.select(F.max(F.array_max(F.transform(xs, lambda x: F.abs(x)))).alias("_mx"))
        out = df.crossJoin(F.broadcast(mx))
    else:
        out = df.withColumn("_mx", F.array_max(F.transform(xs, lambda x: F.abs(x))))
    out = out.withColumn("scale", F.when(F.coalesce(F.col("_mx"), F.lit(0.0)) > 0, F.col("_mx") / QMAX).otherwise(F.lit(1.0)))
    q = F.transform(_as_double(col), lambda x: F.least(F.greatest(F.bround(x / F.col("scale"), 0), F.lit(-128.0)), F.lit(127.0)).cast("tinyint"))
    return out.withColumn("q", q).drop("_mx")


def dequantise(df: DataFrame, q: str = "q", scale: str = "scale", out: str = "deq") -> DataFrame:
    return df.withColumn(out, F.transform(F.col(q), lambda c: c.cast("double") * F.col(scale)))


def quant_error(df: DataFrame, col: str = "embedding") -> DataFrame:
    """Per-vector max and mean absolute reconstruction error."""
    d = dequantise(df)
    diffs = F.zip_with(_as_double(col), F.col("deq"), lambda a, b: F.abs(a - b))
    d = d.withColumn("_d", diffs)
    return d.withColumn("max_err", F.array_max("_d")).withColumn(
        "mean_err", F.aggregate("_d", F.lit(0.0), lambda a, x: a + x) / F.size("_d")
    ).drop("_d", "deq")


def size_report(df: DataFrame, col: str = "embedding", q: str = "q") -> DataFrame:
    """Bytes before (4 per float) and after (1 per code + 8 per scale) in MB (1e6), reduction %."""
    agg = df.agg(
        (F.sum(F.size(col)) * 4 / 1e6).alias("before_mb"),
        ((F.sum(F.size(q)) + 8 * F.count(F.lit(1))) / 1e6).alias("after_mb"),
    )
    return agg.withColumn("reduction_pct", 100 * (1 - F.col("after_mb") / F.col("before_mb")))
