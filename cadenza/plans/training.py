"""Registered queries for training-set preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sentences as S
from ..operators import training as TR
from ..session import table
from . import duck as D
from .registry import query

# Cleaned sentences of every document, one model per `source` (the reference trains one model per corpus).
DUCK_SENTENCES = f"""(SELECT d.source AS model, c.doc_id, c.sent_no, c.sentence
 FROM ({D.clean_corpus_sql('(SELECT doc_id, text FROM documents)')}) c JOIN documents d USING (doc_id))"""
DUCK_SPLIT = f"""(SELECT *, CASE WHEN pos < cut THEN 'train' ELSE 'eval' END AS split,
  CAST(CASE WHEN pos < cut THEN pos ELSE pos - cut END AS BIGINT) AS split_pos FROM (
 SELECT *, CAST(row_number() OVER (PARTITION BY model ORDER BY doc_id, sent_no) - 1 AS BIGINT) AS pos,
  CAST(count(*) OVER (PARTITION BY model) AS BIGINT) AS n,
  floor(CAST(count(*) OVER (PARTITION BY model) AS DOUBLE) * (CAST(1.0 AS DOUBLE) - CAST(0.1 AS DOUBLE))) AS cut
 FROM {DUCK_SENTENCES}))"""
TOKEN_RX = "'[A-Za-z0-9''-]+|[.,?!]'"
DUCK_VOCAB = f"""(SELECT model, token, CAST(3 + row_number() OVER (PARTITION BY model ORDER BY n DESC, token) AS BIGINT) AS id, n
 FROM (SELECT model, token, CAST(count(*) AS BIGINT) AS n FROM (
   SELECT model, unnest(regexp_extract_all(sentence, {TOKEN_RX})) AS token FROM {DUCK_SPLIT} WHERE split = 'train')
  GROUP BY model, token)
 UNION ALL SELECT m.model, s.token, s.id, CAST(0 AS BIGINT) AS n FROM (SELECT DISTINCT model FROM {DUCK_SPLIT} WHERE split = 'train') m,
 (VALUES ('[PAD]', CAST(0 AS BIGINT)), ('[UNK]', 1), ('<s>', 2), ('</s>', 3)) s(token, id))"""
DUCK_ENCODED = f"""(SELECT s.model, s.doc_id, s.sent_no, s.split, s.split_pos,
  list_transform(list_sort(list(struct_pack(p := t.p, id := coalesce(v.id, 1)))), lambda x: x.id) AS ids
 FROM {DUCK_SPLIT} s,
 LATERAL (SELECT unnest(regexp_extract_all(s.sentence, {TOKEN_RX})) AS token,
                 generate_subscripts(regexp_extract_all(s.sentence, {TOKEN_RX}), 1) AS p) t
 LEFT JOIN {DUCK_VOCAB} v ON v.model = s.model AND v.token = t.token
 GROUP BY s.model, s.doc_id, s.sent_no, s.split, s.split_pos)"""


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("model"), "text")
    return S.clean_corpus(docs, keep=("model",))


def split_sentences(spark, sf_dir) -> DataFrame:
    return TR.ordered_split(sentences(spark, sf_dir))


def train_eval(spark, sf_dir) -> DataFrame:
    """The split of every sentence without its position."""
    return TR.train_eval_split(sentences(spark, sf_dir))


def vocab(split: DataFrame) -> DataFrame:
    return TR.build_vocab(split.filter(F.col("split") == "train"))


SPLIT_BY = ["model", "doc_id"]  # ``ordered_split`` stores its rows in buckets by these


def encoded(split: DataFrame, voc: DataFrame) -> DataFrame:
    return TR.encode(split, voc, "sentence", ["doc_id", "sent_no", "split", "split_pos"], dealt_by=SPLIT_BY)


def ids_str(c: str = "ids"):
    return F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), " ")


@query(
    "d1_make_pairs",
    f"""SELECT model, doc_id, sent_no, 'write a lyric based on this text: ' || sentence AS input_text, sentence AS target_text
 FROM {DUCK_SENTENCES}""",
)
def d1_make_pairs(spark, sf_dir):
    return TR.make_pairs(sentences(spark, sf_dir), style="seq2seq").select(
        "model", "doc_id", "sent_no", "input_text", "target_text"
    )


@query("d1_make_pairs_decoder", f"SELECT model, doc_id, sent_no, sentence AS text FROM {DUCK_SENTENCES}")
def d1_make_pairs_decoder(spark, sf_dir):
    return TR.make_pairs(sentences(spark, sf_dir)).select("model", "doc_id", "sent_no", "text")


@query("d2_ordered_split", f"SELECT model, doc_id, sent_no, pos, split, split_pos FROM {DUCK_SPLIT}")
def d2_ordered_split(spark, sf_dir):
    return split_sentences(spark, sf_dir).select("model", "doc_id", "sent_no", "pos", "split", "split_pos")


@query("d3_build_vocab", f"SELECT * FROM {DUCK_VOCAB}")
def d3_build_vocab(spark, sf_dir):
    return vocab(train_eval(spark, sf_dir)).select("model", "token", "id", "n")


@query(
    "d3_encode",
    f"SELECT model, doc_id, sent_no, array_to_string(ids, ' ') AS ids FROM {DUCK_ENCODED}",
)
def d3_encode(spark, sf_dir):
    split = split_sentences(spark, sf_dir)
    return encoded(split, vocab(split)).select("model", "doc_id", "sent_no", ids_str().alias("ids"))


@query(
    "d5_truncate",
    f"""SELECT model, doc_id, sent_no, CAST(len(ids) AS BIGINT) AS n_ids, array_to_string(ids[1:128], ' ') AS ids
 FROM {DUCK_ENCODED}""",
)
def d5_truncate(spark, sf_dir):
    split = split_sentences(spark, sf_dir)
    enc = encoded(split, vocab(split)).withColumn("n_ids", F.size("ids").cast("bigint"))
    return TR.truncate(enc, "ids", 128).select("model", "doc_id", "sent_no", "n_ids", ids_str().alias("ids"))


@query(
    "d6_drop_text",
    f"SELECT model, doc_id, sent_no, split, CAST(len(ids) AS BIGINT) AS n_ids FROM {DUCK_ENCODED}",
)
def d6_drop_text(spark, sf_dir):
    split = split_sentences(spark, sf_dir)
    enc = encoded(split, vocab(split))
    return enc.select("model", "doc_id", "sent_no", "split", F.size("ids").cast("bigint").alias("n_ids"))


@query(
    "d7_pad_batches",
    f"""SELECT model, split, split_pos, batch_id, array_to_string(ids || list_transform(range(m - len(ids)), lambda x: 0), ' ') AS ids,
  array_to_string(list_transform(range(len(ids)), lambda x: 1) || list_transform(range(m - len(ids)), lambda x: 0), ' ') AS mask,
  array_to_string(ids || list_transform(range(m - len(ids)), lambda x: -100), ' ') AS labels
 FROM (SELECT *, max(len(ids)) OVER (PARTITION BY model, split, batch_id) AS m FROM (
   SELECT *, CAST(floor(split_pos / 4) AS BIGINT) AS batch_id FROM {DUCK_ENCODED}))""",
)
def d7_pad_batches(spark, sf_dir):
    split = split_sentences(spark, sf_dir)
    out = TR.pad_batches(encoded(split, vocab(split)), 4)
    return out.select(
        "model", "split", "split_pos", "batch_id", ids_str("ids").alias("ids"), ids_str("mask").alias("mask"),
        ids_str("labels").alias("labels"),
    )


_PADDED = "array_to_string({0} || list_transform(range(max(len({0})) OVER (PARTITION BY model, split, batch_id) - len({0})), lambda x: {1}), ' ')"


# Inputs are the prompted sentence and targets the sentence, both with an end mark and cut to 128 tokens.
@query(
    "d7_pad_batches_seq2seq",
    f"""SELECT model, split, split_pos, batch_id, {_PADDED.format('ids', '0')} AS ids, {_PADDED.format('mask', '0')} AS mask,
  {_PADDED.format('labels', '-100')} AS labels
 FROM (SELECT *, list_transform(range(len(ids)), lambda x: 1) AS mask, CAST(floor(split_pos / 4) AS BIGINT) AS batch_id FROM (
  SELECT model, split, split_pos, (list_concat(i.ids, [3]))[1:128] AS ids, (list_concat(t.ids, [3]))[1:128] AS labels
  FROM (SELECT * FROM {DUCK_ENCODED}) t JOIN (SELECT * FROM {DUCK_ENCODED.replace("s.sentence", "('write a lyric based on this text: ' || s.sentence)")}) i
  USING (model, doc_id, sent_no, split, split_pos)))""",
)
def d7_pad_batches_seq2seq(spark, sf_dir):
    split = split_sentences(spark, sf_dir)
    voc, keys = vocab(split), ["doc_id", "sent_no", "split", "split_pos"]
    pairs = TR.make_pairs(split, style="seq2seq")
    both = TR.encode(pairs, voc, ["input_text", "target_text"], keys, out_col=["ids", "labels"], add_eos=True, dealt_by=SPLIT_BY)
    both = TR.truncate(TR.truncate(both, "ids", 128), "labels", 128)
    out = TR.pad_batches(both, 4, "seq2seq", labels="labels")
    return out.select("model", "split", "split_pos", "batch_id", ids_str("ids").alias("ids"), ids_str("mask").alias("mask"), ids_str("labels").alias("labels"))


@query(
    "d8_steps_per_epoch",
    f"""SELECT model, CAST(count(*) AS BIGINT) AS n_train, CAST(floor(count(*) / 4) AS BIGINT) AS steps_per_epoch
 FROM {DUCK_SPLIT} WHERE split = 'train' GROUP BY model""",
)
def d8_steps_per_epoch(spark, sf_dir):
    return TR.steps_per_epoch(train_eval(spark, sf_dir), 4)


# ---- D4: sub-word merges ------------------------------------------------------------------------
DUCK_BPE_WORDS = f"""(SELECT model, word, count(*) AS freq,
  list_concat(regexp_extract_all(word, '.')[1:-2], [regexp_extract_all(word, '.')[-1] || '</w>']) AS s
 FROM (SELECT model, unnest(regexp_extract_all(sentence, {TOKEN_RX})) AS word FROM {DUCK_SPLIT} WHERE split = 'train')
 GROUP BY model, word)"""


@query(
    "d4_bpe_pair_counts",
    f"""SELECT model, s[i] AS "left", s[i + 1] AS "right", CAST(sum(freq) AS BIGINT) AS n FROM (
  SELECT model, s, freq, unnest(range(1, len(s))) AS i FROM {DUCK_BPE_WORDS} WHERE len(s) > 1)
 GROUP BY model, s[i], s[i + 1]""",
)
def d4_bpe_pair_counts(spark, sf_dir):
    from ..operators import bpe

    split = train_eval(spark, sf_dir).filter(F.col("split") == "train")
    return bpe.pair_counts(bpe.word_table(split)).select("model", "left", "right", "n")


FIRST_MERGES = 20  # merges of each model that the query with an oracle asks for

_A, _Z = "chr(1)", "chr(2)"  # around each symbol, so that one replacement merges pairs from left to right
DUCK_BPE = f"""(WITH RECURSIVE w AS (
  SELECT 0 AS rank, model, array_to_string(list_transform(s, lambda x: {_A} || x || {_Z}), '') AS s, CAST(freq AS BIGINT) AS freq,
   '' AS "left", '' AS "right", CAST(0 AS BIGINT) AS n FROM {DUCK_BPE_WORDS}
  UNION ALL
  SELECT rank + 1, model, replace(s, {_A} || b.l || {_Z} || {_A} || b.r || {_Z}, {_A} || b.l || b.r || {_Z}), freq, b.l, b.r, b.n
  FROM (
   SELECT rank, model, s, freq, any_value(b) AS b FROM (
    SELECT *, first_value({{'l': l, 'r': r, 'n': c}}) OVER (PARTITION BY model ORDER BY c DESC NULLS LAST, l, r) AS b FROM (
     SELECT *, CAST(CASE WHEN l IS NOT NULL THEN sum(freq) OVER (PARTITION BY model, l, r) END AS BIGINT) AS c FROM (
      SELECT rank, model, s, freq, p[i] AS l, p[i + 1] AS r FROM (
       SELECT rank, model, s, freq, p, unnest(CASE WHEN len(p) > 1 THEN range(1, len(p)) ELSE [0] END) AS i FROM (
        SELECT *, regexp_extract_all(s, '[^' || {_A} || {_Z} || ']+') AS p FROM w WHERE rank < {FIRST_MERGES})))))
   GROUP BY rank, model, s, freq)
  WHERE b.n >= 2)
 SELECT DISTINCT model, CAST(rank AS INTEGER) AS rank, "left", "right", n FROM w WHERE rank > 0)"""


def _bpe_words(spark, sf_dir):
    from ..operators import bpe

    return bpe.word_table(train_eval(spark, sf_dir).filter(F.col("split") == "train"))


@query("d4_bpe_first_merges", f"SELECT * FROM {DUCK_BPE}")
def d4_bpe_first_merges(spark, sf_dir):
    """The operator with a vocabulary of ``FIRST_MERGES`` merges, against SQL that takes every merge."""
    from ..operators import bpe

    return bpe.learn_bpe(_bpe_words(spark, sf_dir), FIRST_MERGES)


@query("d4_learn_bpe")
def d4_learn_bpe(spark, sf_dir):
    """Every merge of every model, to the stop rule; thousands of rounds are too many for SQL (see tests/test_bpe.py)."""
    from ..operators import bpe

    return bpe.learn_bpe(_bpe_words(spark, sf_dir))
