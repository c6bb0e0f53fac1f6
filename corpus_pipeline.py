"""Corpus preparation as five stages, each written as Parquet and read again as the next one's documents.

Every stage but the last returns the columns of its input; the last adds ``copies`` and ``taken`` and leaves out what
the mix does not take.  A stage works on all its predecessor kept.  Null texts count as empty; where ids are null or
repeated, rows are numbered first (by id, null last), so that each row has a decision of its own; other columns are
carried along, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import decontaminate as contamination
from cadenza.llm import exact_dedup as exact
from cadenza.llm import mixing, quality, simhash
from cadenza.session import prepare, scratch_path, table

_ID, _KEY = "_pipeline_id", "_pipeline_key"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a distinct row id in document order: the doc_id itself wherever that is distinct and not null."""
    ids = docs.select(F.col("doc_id").alias("id")).groupBy("id").count()
    if ids.where("id is null or `count` > 1").isEmpty():
        return docs.withColumn(_ID, F.col("doc_id"))
    return mixing.ranked(docs, "doc_id", _ID)


def _without(docs: DataFrame, rejected) -> DataFrame:
    """The rows of ``docs`` but those whose id is in ``rejected(numbered documents)``."""
    numbered = _numbered(docs)
    gone = rejected(numbered).select(F.col("doc_id").alias(_KEY))
    rows = numbered.join(gone, F.col(_ID) == F.col(_KEY), "left_anti")
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the classifier rejects go."""
    return quality.accepted(docs, quality.fit(quality.training_rows(docs, table(spark, sf_dir, "labels"))))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of equal texts the row with the smallest id stays."""
    return _without(docs, lambda d: exact.exact_dedup(d, _ID).where("not kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of near copies the row with the smallest id stays."""
    return _without(docs, lambda d: simhash.simhash_dedup(d, _ID).where("doc_id <> component_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents of which a twentieth or more is in benchmark windows go."""
    benchmark = table(spark, sf_dir, "benchmark")
    return _without(docs, lambda d: contamination.report(contamination.decontaminate(d, benchmark, _ID)).where("contaminated"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: the documents that the mix takes, with ``copies`` and ``taken`` words (copies times size)."""
    numbered = _numbered(docs)
    taken = mixing.mix(numbered, _ID).where("copies > 0")
    taken = taken.select(F.col("doc_id").alias(_KEY), F.col("copies").alias("_copies"), F.col("taken").alias("_taken"))
    rows = numbered.join(taken, F.col(_ID) == F.col(_KEY))
    old = [F.col(f"`{c}`") for c in docs.columns if c not in ("copies", "taken")]
    return rows.select(*old, F.col("_copies").alias("copies"), F.col("_taken").alias("taken"))


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
]

# The classifier is trained on the data and the mix draws at random: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared scratch folder."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
