"""Training-set preparation (D1-D8): pairs, ordered split, vocabulary, encoding, truncation, batches.

Global positions are computed without a one-task sort: rows are range-partitioned on the order key
(distinct keys, so a hot document is split across tasks), numbered inside each partition, and shifted
by per-partition offsets taken from a table with one row per (partition, group).
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..options import SEQ2SEQ_PREFIX, Options
from ..session import broadcast_if_few, bucketed, cut_lineage, scratch_path, shuffles_removed, stored

# Special tokens and their ids, and the token pattern (covers the cleaning whitelist).
PAD, UNK, BOS, EOS = "[PAD]", "[UNK]", "<s>", "</s>"
SPECIALS = ((PAD, 0), (UNK, 1), (BOS, 2), (EOS, 3))
TOKEN_PATTERN = r"[A-Za-z0-9'-]+|[.,?!]"
LABEL_MASK = -100

VOCABULARY_BYTES = 64 << 20  # a larger vocabulary is not broadcast
_IDX_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index in the partition


def tokens(c) -> F.Column:
    return F.regexp_extract_all(F.col(c) if isinstance(c, str) else c, F.lit(TOKEN_PATTERN), 0)


def make_pairs(df: DataFrame, col: str = "sentence", style: str = "decoder") -> DataFrame:
    """Decoder style keeps ``text``; seq2seq adds the constant prompt prefix."""
    if style == "seq2seq":
        return df.withColumn("input_text", F.concat(F.lit(SEQ2SEQ_PREFIX), F.col(col))).withColumn(
            "target_text", F.col(col)
        )
    return df.withColumn("text", F.col(col))


def global_position(df: DataFrame, order_cols: list[str], group_cols: list[str] | None = None,
                    pos_col: str = "pos", total_col: str | None = None) -> DataFrame:
    """0-based position of each row in ``order_cols`` order, restarting for each ``group_cols`` value.

    ``order_cols`` must be unique within a group.  One shuffle (range), one stored table, one small
    offsets table of at most (partitions + groups) rows.
    """
    group_cols = group_cols or []
    keys = group_cols + order_cols
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    numbered = ranged.select(
        "*",
        F.shiftright(mid, _IDX_BITS).alias("_pid"),
        mid.bitwiseAND((1 << _IDX_BITS) - 1).alias("_idx"),
    )
    # Ids depend on the physical layout: pin it once so both uses below see the same numbers.
    numbered = stored(numbered, "numbered")
    counts = numbered.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_n"), F.min("_idx").alias("_first"))
    w = Window.partitionBy(*group_cols).orderBy("_pid")
    offsets = counts.select(
        "_pid",
        *group_cols,
        "_first",
        F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        *([F.sum("_n").over(Window.partitionBy(*group_cols)).alias(total_col)] if total_col else []),
    )
    out = numbered.join(broadcast_if_few(offsets), ["_pid", *group_cols])
    out = out.withColumn(pos_col, F.col("_off") + F.col("_idx") - F.col("_first"))
    return out.drop("_pid", "_idx", "_off", "_first")


def global_cumsum(df: DataFrame, weight: str, order_cols: list[str], group_cols: list[str], out: str = "start",
                  total_col: str | None = None) -> DataFrame:
    """Exclusive prefix sum of ``weight`` per group in ``order_cols`` order, without a one-task window.

    Rows are dealt by range on (group, order) and checkpointed; sums run inside each range, and a table with one row
    per range and group gives what lies before it.  ``order_cols`` must be unique within a group.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    ranged = cut_lineage(ranged.withColumn("_pid", F.spark_partition_id()))
    totals = ranged.groupBy("_pid", *group_cols).agg(F.sum(weight).alias("_t"))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid", *group_cols, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"),
        *([F.sum("_t").over(Window.partitionBy(*group_cols)).alias(total_col)] if total_col else []),
    )
    inside = Window.partitionBy("_pid", *group_cols).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    res = local.join(broadcast_if_few(offsets), ["_pid", *group_cols])
    return res.withColumn(out, (F.col("_o") + F.col("_local")).cast("bigint")).drop("_pid", "_local", "_o")


def ordered_split(df: DataFrame, v: float = 0.1, order_cols=("doc_id", "sent_no"), group_cols=("model",)) -> DataFrame:
    """First ``int(n*(1-v))`` rows of each group are train, the rest eval; adds ``pos``, ``split``,
    ``split_pos`` (position inside the split) and ``n``.

    The rows are built once, into the shared folder, numbered within their documents and in buckets by document: that is
    the one time that text moves.  One count per document is dealt by range, and a use of the result joins the rows to
    their documents' starts, which are broadcast after a count or else dealt to the buckets.
    """
    doc, *inner = order_cols
    g = list(group_cols)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    within = Window.partitionBy(*g, doc).orderBy(*inner)
    placed = _keyed(df, [*g, doc]).repartition(n, *g, doc).withColumn("_k", F.row_number().over(within) - 1)
    df = bucketed(placed, [*g, doc], "split", dealt=True)
    counts = df.groupBy(*g, doc).agg(F.count(F.lit(1)).alias("_c"))
    starts = global_cumsum(counts, "_c", [doc], g, "_start", "n").drop("_c")
    out = df.join(broadcast_if_few(starts), [*g, doc])
    out = out.withColumn("pos", F.col("_start") + F.col("_k")).drop("_start", "_k")
    cut = F.floor(F.col("n").cast("double") * (F.lit(1.0) - F.lit(float(v))))
    return out.withColumn("split", F.when(F.col("pos") < cut, "train").otherwise("eval")).withColumn(
        "split_pos", F.when(F.col("pos") < cut, F.col("pos")).otherwise(F.col("pos") - cut).cast("bigint")
    )


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a group or a document have no place in an order."""
    for c in keys:
        df = df.where(F.col(c).isNotNull())
    return df


def train_eval_split(df: DataFrame, v: float = 0.1, order_cols=("doc_id", "sent_no"), group_cols=("model",)) -> DataFrame:
    """D2 for uses that ask only which split a row is in: the rows of ``ordered_split`` with ``split`` and no positions.

    Documents stand in order, so the one that holds its group's cut tells the side of every other: a use of the result
    meets one row per group, and no text moves.  Only the rows of those documents are numbered.
    """
    g, (doc, *inner) = list(group_cols), order_cols
    df = stored(_keyed(df, [*g, doc]), "split")
    counts = df.groupBy(*g, doc).agg(F.count(F.lit(1)).alias("_c"))
    starts = global_cumsum(counts, "_c", [doc], g, "_start", "n")
    cut = F.floor(F.col("n").cast("double") * (F.lit(1.0) - F.lit(float(v))))
    holds = starts.where((F.col("_start") <= cut) & (cut < F.col("_start") + F.col("_c")))
    edge = broadcast_if_few(holds.select(*g, F.col(doc).alias("_edge"), (cut - F.col("_start")).alias("_first")))
    inside = (F.col(doc) == F.col("_edge")) & (F.col("_first") > 0)
    side = F.when(F.col("_edge").isNull() | (F.col(doc) < F.col("_edge")), "train").otherwise("eval")
    whole = df.join(edge, g, "left").where(~F.coalesce(inside, F.lit(False))).withColumn("split", side).drop("_edge", "_first")
    k = F.row_number().over(Window.partitionBy(*g, doc).orderBy(*inner)) - 1
    divided = df.join(edge, g).where(inside).withColumn("split", F.when(k < F.col("_first"), "train").otherwise("eval"))
    return whole.unionByName(stored(divided.drop("_edge", "_first"), "divided"))


def build_vocab(df: DataFrame, col: str = "sentence", group_cols=("model",)) -> DataFrame:
    """D3 vocabulary: specials 0-3, then 4.. by (count desc, token asc) per group."""
    g = list(group_cols)
    counts = df.select(*g, F.explode(tokens(col)).alias("token")).groupBy(*g, "token").agg(
        F.count(F.lit(1)).alias("n")
    )
    ranked = global_position(counts.withColumn("_neg", -F.col("n")), ["_neg", "token"], g, "_r")
    words = ranked.select(*g, "token", (F.col("_r") + len(SPECIALS)).alias("id"), "n")
    specials = df.sparkSession.createDataFrame(
        [(t, i) for t, i in SPECIALS], "token string, id bigint"
    ).withColumn("n", F.lit(0).cast("bigint"))
    if g:
        specials = df.select(*g).distinct().crossJoin(specials)
    return words.unionByName(specials)


def encode(df: DataFrame, vocab: DataFrame, col, key_cols: list[str], group_cols=("model",), out_col="ids",
           add_eos: bool = False, dealt_by: list[str] | None = None) -> DataFrame:
    """D3 encode + D6: text -> ``ARRAY<BIGINT>`` ids (unknown -> 1), text column dropped.  ``col`` and ``out_col`` may be
    lists: several texts of a row are encoded together.

    A vocabulary of at most ``VOCABULARY_BYTES`` by its measured size is broadcast to exploded tokens; rows are dealt by
    their keys as text, and tokens are looked up and collected again where their row stands, so that no token moves.  Each
    group is one sentence.  For a larger one, see ``_encode_large``; ``dealt_by``: the rows are dealt by these already.
    """
    g = list(group_cols)
    cols, outs = ([x] if isinstance(x, str | F.Column) else list(x) for x in (col, out_col))
    vocab = stored(vocab.select(*g, "token", "id"), "vocabulary")
    size = vocab.agg(F.sum(F.octet_length("token") + F.lit(64))).first()[0] or 0
    texts = [(F.col(c) if isinstance(c, str) else c).alias(f"_text{k}") for k, c in enumerate(cols)]
    rows = df.select(*g, *key_cols, *texts)
    if size > VOCABULARY_BYTES or len(cols) > 1:
        out = _encode_large(rows, vocab, g, key_cols, outs, dealt_by)
    else:
        rows = rows.repartition(*g, *key_cols)
        # explode_outer keeps rows without tokens; their null entry is skipped by collect_list.
        exploded = rows.select(*g, *key_cols, F.posexplode_outer(tokens("_text0")).alias("_tpos", "token"))
        joined = exploded.join(F.broadcast(vocab), [*g, "token"], "left")
        joined = joined.withColumn("id", F.coalesce("id", F.lit(1).cast("bigint")))
        entry = F.when(F.col("token").isNotNull(), F.struct("_tpos", "id"))
        out = joined.groupBy(*g, *key_cols).agg(
            F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["id"]).alias(outs[0])
        )
    if add_eos:
        out = out.withColumns({c: F.concat(c, F.array(F.lit(3).cast("bigint"))) for c in outs})
    return out


def _encode_large(rows: DataFrame, vocab: DataFrame, g: list[str], key_cols: list[str], outs: list[str],
                  dealt_by: list[str] | None) -> DataFrame:
    """``encode`` with a vocabulary of any size; rows keep their place and no occurrence of a token moves.

    Rows are dealt into buckets.  The distinct tokens of each bucket are joined to the vocabulary, which costs a row per
    bucket and token, and the ids are stored by bucket; the task that holds a bucket's rows reads its ids from there.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if dealt_by is None:
        dealt_by = [*g, *key_cols]
        rows = rows.repartition(n, *dealt_by)
    group = _text_key(g)
    bucket = F.pmod(F.hash(*dealt_by), F.lit(n)).alias("_b")  # as Spark deals rows: a task holds one
    toks = [F.coalesce(tokens(f"_text{k}"), F.array().cast("array<string>")).alias(f"_t{k}") for k in range(len(outs))]
    split = rows.select(*g, *key_cols, bucket, group.alias("_g"), *toks)
    distinct = split.select("_b", "_g", F.concat(*(f"_t{k}" for k in range(len(outs)))).alias("_t"))
    wanted = distinct.mapInArrow(_distinct_tokens, "_b int, _g string, token string")
    known = vocab.select(group.alias("_g"), "token", "id")
    # A token stands once in each bucket, so none is too frequent for a task; nor is there a side to broadcast.
    found = wanted.join(known.hint("shuffle_merge"), ["_g", "token"]).repartition(n, "_b")
    path = scratch_path(spark, "found-ids")
    with shuffles_removed(spark):
        found.write.partitionBy("_b").option("compression", "zstd").parquet(path)
    kept = [f for f in split.schema.fields if f.name in {*g, *key_cols}]
    schema = T.StructType([*kept, *(T.StructField(c, T.ArrayType(T.LongType())) for c in outs)])
    return split.mapInArrow(partial(_looked_up, path, len(outs), [f.name for f in kept], outs), schema)


def _text_key(g: list[str]) -> F.Column:
    """The group as one text, null where a part is null (such rows have no vocabulary)."""
    parts = [F.col(c).cast("string") for c in g]
    return F.concat(F.lit(""), *(x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)))


def _words_of(group, tokens):
    """Group and token as one text; a token holds no NUL, so the last one is the border."""
    import pyarrow.compute as pc

    return pc.binary_join_element_wise(group, tokens, "\0")


def _distinct_tokens(batches):
    """The distinct (bucket, group, token) of a task, from rows of a bucket, a group and a list of tokens."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held: dict[tuple, list] = {}

    def packed(parts):
        return [pc.unique(pa.chunked_array(parts))] if len(parts) > 1 else parts

    for batch in batches:
        b, g = batch.column("_b"), batch.column("_g")
        t, parent = batch.column("_t").flatten(), pc.list_parent_indices(batch.column("_t"))
        table = pa.table({"b": b.take(parent), "g": g.take(parent), "t": t}).group_by(["b", "g", "t"]).aggregate([])
        for key in table.select(["b", "g"]).group_by(["b", "g"]).aggregate([]).to_pylist():
            if key["g"] is None:
                continue
            mine = table.filter(pc.and_(pc.equal(table["b"], key["b"]), pc.equal(table["g"], key["g"])))["t"].combine_chunks()
            parts = held.setdefault((key["b"], key["g"]), [])
            parts.append(mine)
            if len(parts) > 16:
                held[key["b"], key["g"]] = packed(parts)
    for (b, g), parts in held.items():
        t = packed(parts)[0]
        for k in range(0, len(t), 50_000):
            piece = t.slice(k, 50_000)
            yield pa.record_batch({"_b": pa.array([b] * len(piece), pa.int32()), "_g": pa.array([g] * len(piece), pa.string()), "token": piece})


def _looked_up(path: str, n: int, kept: list[str], outs: list[str], batches):
    """Rows with the ids of their tokens (unknown: 1), from the ids stored for their bucket."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.fs as pfs
    import pyarrow.parquet as pq

    fs, root = pfs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pfs.LocalFileSystem(), path)
    held: dict[int, tuple] = {}

    def ids_of(b):
        if b not in held:
            held.clear()
            folder = f"{root}/_b={b}"
            files = [f.path for f in fs.get_file_info(pfs.FileSelector(folder)) if f.path.endswith(".parquet")] if fs.get_file_info(folder).type == pfs.FileType.Directory else []
            tables = [pq.ParquetFile(fs.open_input_file(f)).read(["_g", "token", "id"]) for f in files]
            if tables:
                t = pa.concat_tables(tables).combine_chunks()
                held[b] = _words_of(t["_g"], t["token"]).combine_chunks(), t["id"].combine_chunks()
            else:
                held[b] = pa.array([], pa.string()), pa.array([], pa.int64())
        return held[b]

    for batch in batches:
        table = pa.Table.from_batches([batch])
        for b in pc.unique(batch.column("_b")).to_pylist():
            words, ids = ids_of(b)
            part = table.filter(pc.equal(table["_b"], b)).combine_chunks()
            lists = []
            for k in range(n):
                col = part[f"_t{k}"].combine_chunks()
                keys = _words_of(part["_g"].combine_chunks().take(pc.list_parent_indices(col)), col.flatten())
                found = pc.fill_null(ids.take(pc.index_in(keys, value_set=words)), 1)
                lists.append(pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(pc.list_value_length(col)).cast(pa.int32())]), found))
            yield from pa.table([*(part[c] for c in kept), *lists], [*kept, *outs]).to_batches()


def truncate(df: DataFrame, col: str = "ids", n: int = 128) -> DataFrame:
    """seq2seq inputs and targets are cut to ``n`` tokens."""
    return df.withColumn(col, F.slice(col, 1, n))


def pad_batches(df: DataFrame, batch_size: int = 4, style: str = "decoder", ids: str = "ids",
                labels: str | None = None, pos_col: str = "split_pos", group_cols=("model", "split")) -> DataFrame:
    """``batch_id = pos div batch_size``; pad right to the longest row in the batch.

    Decoder style: labels = ids with padding masked to -100.  Seq2seq: labels = padded targets.
    The window partition is one batch (``batch_size`` rows).
    """
    g = list(group_cols)
    out = df.withColumn("batch_id", F.floor(F.col(pos_col) / batch_size).cast("bigint"))
    w = Window.partitionBy(*g, "batch_id")
    out = out.withColumn("_m", F.max(F.size(ids)).over(w))
    pad = F.col("_m") - F.size(ids)
    out = out.withColumn("mask", F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), pad)))
    if style == "seq2seq" and labels:
        out = out.withColumn("_lm", F.max(F.size(labels)).over(w)).withColumn(
            labels, F.concat(labels, F.array_repeat(F.lit(LABEL_MASK).cast("bigint"), F.col("_lm") - F.size(labels)))
        ).drop("_lm")
        out = out.withColumn(ids, F.concat(ids, F.array_repeat(F.lit(0).cast("bigint"), pad)))
    else:
        out = out.withColumn("labels", F.concat(ids, F.array_repeat(F.lit(LABEL_MASK).cast("bigint"), pad)))
        out = out.withColumn(ids, F.concat(ids, F.array_repeat(F.lit(0).cast("bigint"), pad)))
    return out.drop("_m")


def steps_per_epoch(df: DataFrame, batch_size: int = 4, group_cols=("model",)) -> DataFrame:
    """Train rows div batch size."""
    g = list(group_cols)
    return df.filter(F.col("split") == "train").groupBy(*g).agg(
        F.count(F.lit(1)).alias("n_train"),
        F.floor(F.count(F.lit(1)) / batch_size).cast("bigint").alias("steps_per_epoch"),
    )

