"""Session helpers: a local session for tests, the shared scratch folder, counted broadcast."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "cadenza") -> SparkSession:
    """Session for tests and the bench: UTC, AQE on, UI off, scratch folder set only if unset."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every job relies on: UTC days and a checkpoint folder."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    scratch_root(spark)
    return spark


SCRATCH_KEY = "cadenza.scratch.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where it is unset, an error, but for a session on one
    machine (``local[n]``), which gets a temp folder.

    ``spark.checkpoint.dir`` cannot be changed on a running session, so a fallback folder is recorded
    under a package key and registered with ``setCheckpointDir``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="cadenza-scratch-")
    if spark.conf.get(SCRATCH_KEY, None) != root:
        spark.conf.set(SCRATCH_KEY, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch root (never reused between runs)."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint to the shared folder: survives executor loss, unlike a local checkpoint."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_few(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast a small derived table after counting it (the count is the size check).

    The table is checkpointed first, so the count and the join read it once and no cache is left behind.
    """
    df = cut_lineage(df)
    if df.count() <= max_rows:
        return F.broadcast(df)
    return df


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Writes inside remove their shuffle files when they end; else those stay until the driver collects its garbage.
    (Checkpoints do not heed the setting.)"""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder as Parquet and read back: for large tables that are read again.  A
    checkpoint holds plain rows, which take some ten times the disk."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: list[str], name: str, dealt: bool = False) -> DataFrame:
    """``df`` written once to the shared folder in buckets by ``keys``: later joins on them do not move it.  ``dealt``:
    its rows are dealt by ``keys`` already, over as many tasks as there are shuffle partitions."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unique = f"{name}_{uuid.uuid4().hex[:12]}"
    writer = df.write.bucketBy(n, *keys) if dealt else df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys)
    with shuffles_removed(spark):
        writer.option("path", scratch_path(spark, name)).option("compression", "zstd").saveAsTable(unique)
    return spark.table(unique)


def remove(spark: SparkSession, path: str) -> None:
    """Scratch data that nothing will read again goes at once."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread CPU-heavy per-row work when the scan yields fewer tasks than there are cores.

    Large inputs already have many splits, so on a real cluster this adds no shuffle; a one-row-group
    file would otherwise run every regex in a single task.  What a micro-batch of a stream will hold is not
    known here, and it is often one file: its rows are always spread.
    """
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.isStreaming:
        return df.repartition(want)
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df
