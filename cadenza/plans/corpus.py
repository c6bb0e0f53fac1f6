"""Registered queries for line rules (B), text rules (C) and the cleaning flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import sentences as S
from ..session import ensure_parallelism, stored, table
from . import duck as D
from .fixtures import DUCK_INJECTED, INJECT_SQL
from .registry import query


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(INJECT_SQL).alias("text"))


def raw_lines(df: DataFrame) -> DataFrame:
    """Document rows -> ``(doc_id, line_no, line)``; ``line_no`` 0-based."""
    return df.select("doc_id", F.posexplode(T.split_lines("text")).alias("line_no", "line")).withColumn(
        "line_no", F.col("line_no").cast("bigint")
    )


def stripped_lines(df: DataFrame) -> DataFrame:
    """B2: stripped, non-blank lines."""
    return raw_lines(df).withColumn("line", T.py_strip("line")).filter(F.col("line") != "")


def joined(spark, sf_dir) -> DataFrame:
    """B1-B12 on the injected documents."""
    return injected(spark, sf_dir).select("doc_id", T.filter_lines("text").alias("text"))


# ---- DuckDB relations ----------------------------------------------------------------------------
DUCK_RAW_LINES = f"""(SELECT doc_id, CAST(generate_subscripts(lines, 1) - 1 AS BIGINT) AS line_no, unnest(lines) AS line
 FROM (SELECT doc_id, {D.split_lines('text')} AS lines FROM {DUCK_INJECTED}))"""
DUCK_STRIPPED = f"(SELECT doc_id, line_no, {D.strip('line')} AS line FROM {DUCK_RAW_LINES} WHERE {D.strip('line')} <> '')"
DUCK_JOINED = f"""(SELECT doc_id, array_to_string(list_filter(list_transform(lines, lambda l: {D.clean_line('l')}),
 lambda l: {D.keep_line('l')}), ' ') AS text FROM (
 SELECT doc_id, {D.slice_between('lines')} AS lines FROM (
 SELECT doc_id, {D.split_lines('text')} AS lines FROM {DUCK_INJECTED})))"""
DUCK_REPAIRED = f"(SELECT doc_id, {D.repair_text('text')} AS text FROM {DUCK_JOINED})"
DUCK_SANITIZED = f"(SELECT doc_id, {D.sanitize('text')} AS text FROM {DUCK_REPAIRED})"
DUCK_NORMALISED = f"(SELECT doc_id, {D.strip_page_marks('text')} AS text FROM {DUCK_SANITIZED})"
DUCK_PIECES = f"({D.sentences_sql('SELECT * FROM ' + DUCK_NORMALISED)})"


def _line_map(sql_fn):
    return f"SELECT doc_id, line_no, {sql_fn('line')} AS line FROM {DUCK_STRIPPED}"


def _line_keep(sql_pred):
    return f"SELECT doc_id, line_no, line FROM {DUCK_STRIPPED} WHERE NOT {sql_pred('line')}"


# ---- B: line operators ---------------------------------------------------------------------------
@query(
    "b1_slice_between",
    f"""SELECT doc_id, CAST(generate_subscripts(lines, 1) - 1 AS BIGINT) AS line_no, unnest(lines) AS line FROM (
 SELECT doc_id, {D.slice_between('lines')} AS lines FROM (SELECT doc_id, {D.split_lines('text')} AS lines FROM {DUCK_INJECTED}))""",
)
def b1_slice_between(spark, sf_dir):
    docs = injected(spark, sf_dir)
    return docs.select(
        "doc_id", F.posexplode(T.slice_between(T.split_lines("text"))).alias("line_no", "line")
    ).withColumn("line_no", F.col("line_no").cast("bigint"))


@query("b2_drop_blank_lines", f"SELECT * FROM {DUCK_STRIPPED}")
def b2_drop_blank_lines(spark, sf_dir):
    return stripped_lines(injected(spark, sf_dir))


@query("b3_strip_verse_ref", _line_map(D.strip_verse_ref))
def b3_strip_verse_ref(spark, sf_dir):
    return stripped_lines(injected(spark, sf_dir)).withColumn("line", T.strip_verse_ref("line"))


@query("b4_strip_subtitle_cues", f"SELECT doc_id, {D.strip_subtitle_cues('text')} AS text FROM {DUCK_INJECTED}")
def b4_strip_subtitle_cues(spark, sf_dir):
    return injected(spark, sf_dir).withColumn("text", T.strip_subtitle_cues("text"))


@query("b5_strip_urls", _line_map(D.strip_urls))
def b5_strip_urls(spark, sf_dir):
    return stripped_lines(injected(spark, sf_dir)).withColumn("line", T.strip_urls("line"))


@query("b6_strip_see_more", _line_map(D.strip_see_more))
def b6_strip_see_more(spark, sf_dir):
    return stripped_lines(injected(spark, sf_dir)).withColumn("line", T.strip_see_more("line"))


@query("b7_drop_title_lines", _line_keep(D.is_title_line))
def b7_drop_title_lines(spark, sf_dir):
    return stripped_lines(injected(spark, sf_dir)).filter(~T.is_title_line("line"))


@query("b8_drop_book_headings", _line_keep(D.is_book_heading))
def b8_drop_book_headings(spark, sf_dir):
    return stripped_lines(injected(spark, sf_dir)).filter(~T.is_book_heading("line"))


@query("b9_drop_digit_lines", _line_keep(D.is_digit_line))
def b9_drop_digit_lines(spark, sf_dir):
    return stripped_lines(injected(spark, sf_dir)).filter(~T.is_digit_line("line"))


@query("b10_drop_short_caps", _line_keep(D.is_short_caps))
def b10_drop_short_caps(spark, sf_dir):
    return stripped_lines(injected(spark, sf_dir)).filter(~T.is_short_caps("line"))


@query("b11_min_letters", f"SELECT doc_id, line_no, line FROM {DUCK_STRIPPED} WHERE {D.has_min_letters('line')}")
def b11_min_letters(spark, sf_dir):
    return stripped_lines(injected(spark, sf_dir)).filter(T.has_min_letters("line"))


@query("b12_join_lines", f"SELECT * FROM {DUCK_JOINED}")
def b12_join_lines(spark, sf_dir):
    return joined(spark, sf_dir)


# ---- C: text operators ---------------------------------------------------------------------------
def _text_map(rel, sql_fn):
    return f"SELECT doc_id, {sql_fn('text')} AS text FROM {rel}"


@query("c1_repair_text", f"SELECT * FROM {DUCK_REPAIRED}")
def c1_repair_text(spark, sf_dir):
    return joined(spark, sf_dir).withColumn("text", T.repair_text("text"))


@query("c2_expand_ie", _text_map(DUCK_REPAIRED, lambda x: f"regexp_replace({x}, '(?i)\\bi\\.e\\.\\b', 'that is', 'g')"))
def c2_expand_ie(spark, sf_dir):
    return joined(spark, sf_dir).withColumn("text", F.regexp_replace(T.repair_text("text"), T.IE_PATTERN, "that is"))


@query("c3_expand_eg", _text_map(DUCK_REPAIRED, lambda x: f"regexp_replace({x}, '(?i)\\be\\.g\\.\\b', 'for example', 'g')"))
def c3_expand_eg(spark, sf_dir):
    return joined(spark, sf_dir).withColumn(
        "text", F.regexp_replace(T.repair_text("text"), T.EG_PATTERN, "for example")
    )


@query("c4_strip_footnotes", _text_map(DUCK_REPAIRED, D.strip_footnotes))
def c4_strip_footnotes(spark, sf_dir):
    return joined(spark, sf_dir).withColumn("text", T.strip_footnotes(T.repair_text("text")))


@query("c5_strip_brackets_quotes", _text_map(DUCK_REPAIRED, lambda x: D.strip_quotes(D.strip_brackets(x))))
def c5_strip_brackets_quotes(spark, sf_dir):
    return joined(spark, sf_dir).withColumn("text", T.strip_quotes(T.strip_brackets(T.repair_text("text"))))


@query("c6_whitelist", _text_map(DUCK_REPAIRED, D.whitelist))
def c6_whitelist(spark, sf_dir):
    return joined(spark, sf_dir).withColumn("text", T.whitelist(T.repair_text("text")))


@query("c7_squeeze", _text_map(DUCK_REPAIRED, D.squeeze))
def c7_squeeze(spark, sf_dir):
    return joined(spark, sf_dir).withColumn("text", T.squeeze(T.repair_text("text")))


@query("c8_sanitize", f"SELECT * FROM {DUCK_SANITIZED}")
def c8_sanitize(spark, sf_dir):
    return joined(spark, sf_dir).withColumn("text", T.sanitize(T.repair_text("text")))


@query("c9_strip_page_marks", f"SELECT * FROM {DUCK_NORMALISED}")
def c9_strip_page_marks(spark, sf_dir):
    return joined(spark, sf_dir).withColumn("text", T.normalise_text("text"))


def _pieces(spark, sf_dir) -> DataFrame:
    return S.explode_sentences(joined(spark, sf_dir).withColumn("text", T.normalise_text("text")))


@query("c10_split_sentences", f"SELECT * FROM {DUCK_PIECES}")
def c10_split_sentences(spark, sf_dir):
    return _pieces(spark, sf_dir)


DUCK_CLEAN_INJECTED = D.clean_corpus_sql(DUCK_INJECTED)


@query(
    "c11_learn_abbreviations",
    f"""SELECT * EXCLUDE (d, p), round(2 * (n_dot * ln(0.99 / (d / (d + p))) + n_nodot * ln((1 - 0.99) / (1 - d / (d + p)))), 6) AS score FROM (
SELECT *, sum(n_dot) OVER () AS d, sum(n_nodot) OVER () AS p FROM (
SELECT token, CAST(count_if(dotted) AS BIGINT) AS n_dot, CAST(count_if(NOT dotted) AS BIGINT) AS n_nodot,
 (count_if(dotted) >= 5 AND regexp_matches(token, '^[a-z]+\\z') AND length(token) <= 5
  AND count_if(dotted) / (count_if(dotted) + count_if(NOT dotted)) >= 0.9) AS is_abbrev
FROM (SELECT lower(regexp_replace(tok, '\\.\\z', '')) AS token, ends_with(tok, '.') AS dotted
      FROM (SELECT unnest({D.words('sentence')}) AS tok FROM ({DUCK_CLEAN_INJECTED})))
WHERE token <> '' GROUP BY token))""",
)
def c11_learn_abbreviations(spark, sf_dir):
    return S.learn_abbreviations(S.clean_corpus(injected(spark, sf_dir)))


@query(
    "c12_filter_word_count",
    f"SELECT * FROM {DUCK_PIECES} WHERE {D.word_count('sentence')} BETWEEN 3 AND 150",
)
def c12_filter_word_count(spark, sf_dir):
    return S.filter_word_count(_pieces(spark, sf_dir))


@query("c13_sentence_case", f"SELECT doc_id, sent_no, {D.sentence_case('sentence')} AS sentence FROM {DUCK_PIECES}")
def c13_sentence_case(spark, sf_dir):
    return _pieces(spark, sf_dir).withColumn("sentence", T.sentence_case("sentence"))


DUCK_CLEAN = D.clean_corpus_sql("(SELECT doc_id, text FROM documents)")


@query(
    "c14_corpus_stats",
    f"""SELECT (SELECT CAST(count(DISTINCT doc_id) AS BIGINT) FROM documents) AS n_files,
 (SELECT CAST(count(*) AS BIGINT) FROM (SELECT unnest({D.split_lines('text')}) FROM documents)) AS n_lines,
 (SELECT CAST(count(*) AS BIGINT) FROM ({DUCK_CLEAN})) AS n_sentences""",
)
def c14_corpus_stats(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return S.corpus_stats(raw_lines(docs), S.clean_corpus(docs))


@query("c15_clean_corpus", DUCK_CLEAN)
def c15_clean_corpus(spark, sf_dir):
    return S.clean_corpus(documents(spark, sf_dir))


@query("c15_clean_corpus_injected", DUCK_CLEAN_INJECTED)
def c15_clean_corpus_injected(spark, sf_dir):
    return S.clean_corpus(injected(spark, sf_dir))


@query("c15_clean_lines", DUCK_CLEAN_INJECTED)
def c15_clean_lines(spark, sf_dir):
    """C15 from numbered lines instead of whole texts."""
    from ..operators.lines import clean_lines

    return clean_lines(raw_lines(ensure_parallelism(injected(spark, sf_dir))))


@query(
    "c11_merge_abbrev",
    f"""WITH s AS ({DUCK_CLEAN_INJECTED}),
 ab AS (SELECT token FROM (SELECT lower(regexp_replace(tok, '\\.\\z', '')) AS token, ends_with(tok, '.') AS dotted
     FROM (SELECT unnest({D.words('sentence')}) AS tok FROM s)) WHERE token <> '' GROUP BY token
   HAVING count_if(dotted) >= 5 AND regexp_matches(token, '^[a-z]+\\z') AND length(token) <= 5
     AND count_if(dotted) / (count_if(dotted) + count_if(NOT dotted)) >= 0.9),
 f AS (SELECT s.*, lower(regexp_extract(sentence, '([^ ]+)\\.$', 1)) IN (SELECT token FROM ab) AS cont FROM s),
 l AS (SELECT *, coalesce(lag(cont) OVER (PARTITION BY doc_id ORDER BY sent_no), false) AS prev FROM f),
 g AS (SELECT *, sum(CASE WHEN prev THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY sent_no ROWS UNBOUNDED PRECEDING) AS sid FROM l)
 SELECT doc_id, min(sent_no) AS sent_no, string_agg(sentence, ' ' ORDER BY sent_no) AS sentence FROM g GROUP BY doc_id, sid""",
)
def c11_merge_abbrev(spark, sf_dir):
    sents = stored(S.clean_corpus(injected(spark, sf_dir)), "clean")  # read for learning and for merging
    return S.merge_abbrev(sents, S.learn_abbreviations(sents))
