"""File sources and sinks (A1-A6, A9): text lines, a CSV column, chat exports, concatenation,
a text sink, a content-keyed materialise cache, and directory sizes."""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.training import global_cumsum
from ..session import broadcast_if_few, cut_lineage, scratch_root


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path (or, for a glob, at least one match) exists."""
    fs, p = _hadoop_fs(spark, path)
    if any(ch in path for ch in "*?[{"):
        found = fs.globStatus(p)
        return found is not None and len(found) > 0
    return bool(fs.exists(p))


def _is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def _numbered(df: DataFrame, pos_col: str) -> DataFrame:
    """Number the rows of each file in file order without moving them.

    A split of a file (``file_block_start``) is read by one task from front to back, so a row's place is its place in the
    split plus the rows of the file's earlier splits, and those come from a table with one row per split.  Should the
    file be split in another way when it is read again, the job fails instead of numbering wrongly.
    """
    at = F.monotonically_increasing_id()
    d = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_blk"), at.alias("_mid"))
    splits = d.groupBy("_file", "_blk").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy("_file").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col("_file").alias("_f"), F.col("_blk").alias("_b"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = d.join(broadcast_if_few(splits), (F.col("_file") == F.col("_f")) & (F.col("_blk") == F.col("_b")), "left")
    place = F.col("_off") + F.col("_mid") - F.col("_first")
    sure = F.when(place >= 0, place).otherwise(F.raise_error(F.lit("the input was split differently when read again")).cast("bigint"))
    return out.withColumn(pos_col, sure).drop("_f", "_b", "_first", "_off", "_mid", "_blk")


def read_lines(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """A1: one text file, or every ``*.txt`` directly in a folder (not recursive, case-sensitive glob).

    Returns ``doc_id`` (file path), ``line_no`` (0-based, file order) and ``line``; no line leaves its task.  Missing
    path or no matching file raises; with ``strict`` an invalid UTF-8 line fails the job, as a strict decoder would.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Input path not found at '{path}'")
    reader = spark.read.option("recursiveFileLookup", "false")
    if _is_dir(spark, path):
        reader = reader.option("pathGlobFilter", "*.txt")
    out = _numbered(reader.text(path).select("value", "_metadata"), "line_no")
    if strict:
        out = out.withColumn(
            "value", F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(F.raise_error(F.lit("invalid UTF-8 in input")))
        )
    return out.select(F.col("_file").alias("doc_id"), "line_no", F.col("value").alias("line"))


def read_csv_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A2: one column of a CSV file (header row, quoted newlines, doubled quotes) -> ``row_no, text``.

    The header test is exact (case-sensitive); empty or missing cells are skipped; kept cells are
    stripped (a blank cell is kept as an empty string, since the emptiness test comes first).
    """
    df = spark.read.options(header=True, multiLine=True, escape='"', inferSchema=False).csv(path)
    if column not in df.columns:
        raise ValueError(f"Column header '{column}' not found in '{path}'. Available headers are: {', '.join(df.columns)}")
    numbered = _numbered(df.select(F.col(f"`{column}`").alias("_c"), "_metadata"), "_r")
    # Row numbers run across files in path order (a folder of part files reads as one file).
    files = df.select(F.col("_metadata.file_path").alias("_f")).groupBy("_f").agg(F.count(F.lit(1)).alias("_n"))
    offs = global_cumsum(files.withColumn("_g", F.lit(0)), "_n", ["_f"], ["_g"], "_before").select("_f", "_before")
    out = numbered.join(broadcast_if_few(offs), F.col("_file") == F.col("_f"))
    out = out.filter(F.col("_c").isNotNull() & (F.col("_c") != ""))
    return out.select((F.col("_before") + F.col("_r")).alias("row_no"), T.py_strip("_c").alias("text"))


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """A3: the string ``text`` of each entry of ``messages`` in file order -> ``doc_id, msg_no, text``.

    Each file is one JSON document (read whole).  Files that are not JSON, lack ``messages`` or whose
    ``messages`` is not a list give no rows, like the reference's early return.  Non-string texts
    (numbers, null) and entries without ``text`` are skipped; an empty string is kept.
    """
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("doc_id"), "value")
    v = F.try_parse_json("value")
    msgs = F.try_variant_get(v, "$.messages", "array<variant>")
    ex = raw.select("doc_id", F.posexplode(msgs).alias("msg_no", "m"))
    t = F.try_variant_get("m", "$.text", "variant")
    ex = ex.filter(F.schema_of_variant(t) == "STRING")
    return ex.select("doc_id", F.col("msg_no").cast("bigint").alias("msg_no"), F.try_variant_get(t, "$", "string").alias("text"))


def concat_text(df: DataFrame, key: str, order: str, col: str, sep: str = "\n") -> DataFrame:
    """A4: ordered strings of each key joined by ``sep`` (one group per document)."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(col).alias("v"))))
    return df.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x["v"]), sep).alias(col))


def write_text(df: DataFrame, path: str, col: str, order: list[str], mode: str = "overwrite") -> None:
    """A5: one line per row, range-partitioned and sorted so part files read back in order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).select(col).write.mode(mode).text(path)


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Sizes and modification times of the input files (a listing, no data read)."""
    parts = []
    for p in paths:
        fs, hp = _hadoop_fs(spark, p)
        it = fs.listFiles(hp, True)
        while it.hasNext():
            st = it.next()
            parts.append(f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(parts)).encode()).hexdigest()[:16]


def materialise(spark: SparkSession, name: str, build, options: dict | None = None, inputs: list[str] | None = None,
                refresh: bool = False, root: str | None = None) -> DataFrame:
    """Build once, then read back.  The key holds the name, a hash of the options and a fingerprint
    of the input files, so changed settings or inputs never hit a stale entry."""
    opt_hash = hashlib.sha1(json.dumps(options or {}, sort_keys=True, default=str).encode()).hexdigest()[:12]
    key = f"{name}-{opt_hash}-{fingerprint(spark, inputs or [])}"
    path = os.path.join(root or os.path.join(scratch_root(spark), "cache"), key)
    done = os.path.join(path, "_SUCCESS")
    if refresh or not path_exists(spark, done):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def dir_size(spark: SparkSession, path: str) -> DataFrame:
    """Total bytes and number of all files under ``path``, at any depth, hidden ones too; contents are never read.

    Folders are listed level by level, each level by the tasks; a Spark reader would pass over names that begin with a
    dot or an underscore.
    """
    level = spark.createDataFrame([(path,)], "folder string")
    found = []
    while True:
        entries = cut_lineage(level.repartition("folder").mapInPandas(_entries, "path string, is_dir boolean, length bigint"))
        found.append(entries.where("not is_dir").select("length"))
        level = entries.where("is_dir").select(F.col("path").alias("folder"))
        if level.isEmpty():
            break
    files = found[0]
    for more in found[1:]:
        files = files.union(more)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("n_files"))


def _entries(batches):
    """What stands directly in each folder."""
    import pandas as pd
    import pyarrow.fs as pfs

    for batch in batches:
        for folder in batch["folder"]:
            fs, root = pfs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pfs.LocalFileSystem(), folder)
            infos = fs.get_file_info(pfs.FileSelector(root))
            prefix = folder[: -len(root)] if folder.endswith(root) else ""
            yield pd.DataFrame({"path": pd.Series([prefix + i.path for i in infos], dtype=object),
                                "is_dir": [i.type == pfs.FileType.Directory for i in infos], "length": [max(i.size or 0, 0) for i in infos]})
