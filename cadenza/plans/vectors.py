"""Registered queries for int8 quantisation of the `embeddings` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quantise as Q
from ..session import table
from .registry import query

DUCK_Q = """(SELECT vec_id, embedding, scale,
  list_transform(embedding, lambda x: CAST(least(greatest(round_even(CAST(x AS DOUBLE) / scale, 0), -128), 127) AS TINYINT)) AS q
 FROM (SELECT vec_id, embedding, CASE WHEN mx > 0 THEN mx / 127.5 ELSE 1.0 END AS scale FROM (
  SELECT vec_id, embedding, list_max(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE)))) AS mx FROM embeddings)))"""
DUCK_QT = """(SELECT vec_id, embedding, scale,
  list_transform(embedding, lambda x: CAST(least(greatest(round_even(CAST(x AS DOUBLE) / scale, 0), -128), 127) AS TINYINT)) AS q
 FROM (SELECT vec_id, embedding, CASE WHEN mx > 0 THEN mx / 127.5 ELSE 1.0 END AS scale FROM embeddings,
  (SELECT max(list_max(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE))))) AS mx FROM embeddings)))"""


def _codes():
    return F.array_join(F.transform("q", lambda c: c.cast("string")), " ")


@query("i1_quantise", f"SELECT vec_id, round(scale, 9) AS scale, array_to_string(q, ' ') AS q FROM {DUCK_Q}")
def i1_quantise(spark, sf_dir):
    q = Q.quantise(table(spark, sf_dir, "embeddings"))
    return q.select("vec_id", F.round("scale", 9).alias("scale"), _codes().alias("q"))


@query("i1_quantise_table_scope", f"SELECT vec_id, round(scale, 9) AS scale, array_to_string(q, ' ') AS q FROM {DUCK_QT}")
def i1_quantise_table_scope(spark, sf_dir):
    q = Q.quantise(table(spark, sf_dir, "embeddings"), scope="table")
    return q.select("vec_id", F.round("scale", 9).alias("scale"), _codes().alias("q"))


@query(
    "i2_quant_error",
    f"""SELECT vec_id, round(list_max(d), 6) AS max_err, round(list_sum(d) / len(d), 6) AS mean_err FROM (
  SELECT vec_id, list_transform(list_zip(embedding, q), lambda p: abs(CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE) * scale)) AS d
  FROM {DUCK_Q})""",
)
def i2_quant_error(spark, sf_dir):
    e = Q.quant_error(Q.quantise(table(spark, sf_dir, "embeddings")))
    return e.select("vec_id", F.round("max_err", 6).alias("max_err"), F.round("mean_err", 6).alias("mean_err"))


@query(
    "i3_size_report",
    f"""SELECT round(before_mb, 6) AS before_mb, round(after_mb, 6) AS after_mb, round(100 * (1 - after_mb / before_mb), 6) AS reduction_pct
 FROM (SELECT sum(len(embedding)) * 4 / 1e6 AS before_mb, (sum(len(q)) + 8 * count(*)) / 1e6 AS after_mb FROM {DUCK_Q})""",
)
def i3_size_report(spark, sf_dir):
    r = Q.size_report(Q.quantise(table(spark, sf_dir, "embeddings")))
    return r.select(*[F.round(c, 6).alias(c) for c in ("before_mb", "after_mb", "reduction_pct")])
