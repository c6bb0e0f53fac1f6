"""Registered queries for prompt selection (F1-F4) and song assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import prompts as P
from ..operators import songs as G
from ..options import DEFAULT_SONG_STRUCTURE, Options
from ..session import ensure_parallelism, table
from . import duck as D
from .registry import query

SEED = 42
KEYWORD = "the"  # the default keyword never occurs in the driver's documents
OPTS = Options(keyword=KEYWORD, seed=SEED)
NS = D.rx(D.NON_SPACE + "+")


def _words(x):
    return f"regexp_extract_all({x}, {NS})"


DUCK_F1 = f"""SELECT doc_id, CASE WHEN len(w) > 5 THEN array_to_string(w[s + 1:s + 5], ' ') ELSE 'The world is' END AS prompt
FROM (SELECT doc_id, w, CASE WHEN len(w) > 5 THEN {D.md5_int("'42|' || doc_id")} % (len(w) - 4) END AS s
      FROM (SELECT doc_id, {_words('text')} AS w FROM documents))"""
DUCK_F2_EXPR = f"""(SELECT CASE WHEN len(hits) > 0 THEN array_to_string({_words('list_min(hits).s')}[1:20], ' ') END FROM (
  SELECT list_filter(list_transform({D.split_sentences('text')},
     lambda s, i: {{'h': md5('{SEED}|' || doc_id || '|' || (i - 1)), 's': s}}),
   lambda x: contains(lower(x.s), '{KEYWORD}')) AS hits))"""
DUCK_F3_EXPR = f"array_to_string({_words('text')}[1:10], ' ')"
DUCK_F4_EXPR = f"CASE WHEN text IS NULL THEN 'The world is' ELSE coalesce({DUCK_F2_EXPR}, {DUCK_F3_EXPR}) END"

_TAGS = "[" + ", ".join(f"'{t}'" for t in DEFAULT_SONG_STRUCTURE) + "]"
DUCK_SONGS = f"""(SELECT s.doc_id AS song_id, d.source AS model, {DUCK_F4_EXPR.replace('text', 'd.text').replace('doc_id', 'd.doc_id')} AS idea,
  {D.split_sentences('s.text')} AS pieces
 FROM ({D.joined_text_sql('(SELECT doc_id, text FROM documents)')}) s JOIN documents d ON d.doc_id = s.doc_id)"""
DUCK_SECTIONS = f"""(SELECT song_id, model, idea, pos, tag,
  {D.format_lines("array_to_string(list_filter(pieces, lambda x, i: (i - 1) % 7 = pos), ' ')", 5)} AS content
 FROM (SELECT *, unnest({_TAGS}) AS tag, CAST(generate_subscripts({_TAGS}, 1) - 1 AS INTEGER) AS pos FROM {DUCK_SONGS}))"""
DUCK_RESOLVED = f"""(SELECT song_id, model, idea, pos, tag,
  CASE WHEN contains(lower(tag), 'chorus') THEN coalesce(first_value(nullif(content, '') IGNORE NULLS) OVER (
    PARTITION BY song_id, contains(lower(tag), 'chorus') ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), content)
  ELSE content END AS content FROM {DUCK_SECTIONS})"""
DUCK_ASSEMBLED = f"""(SELECT song_id, any_value(idea) AS idea,
  {D.strip("string_agg(chr(10) || chr(10) || tag || chr(10) || content, '' ORDER BY pos)")} AS lyrics
 FROM {DUCK_RESOLVED} GROUP BY song_id)"""


def docs(spark, sf_dir) -> DataFrame:
    return ensure_parallelism(table(spark, sf_dir, "documents"))


def songs(spark, sf_dir) -> DataFrame:
    d = docs(spark, sf_dir)
    return d.select(
        F.col("doc_id").alias("song_id"), F.col("source").alias("model"),
        P.initial_prompt("text", F.col("doc_id"), OPTS).alias("idea"),
        T.split_sentences(T.normalise_text(T.filter_lines("text"))).alias("pieces"),
    )


def sections(spark, sf_dir) -> DataFrame:
    s = G.expand_structure(songs(spark, sf_dir), G.structure())
    body = F.array_join(F.filter("pieces", lambda x, i: F.pmod(i, F.lit(7)) == F.col("pos")), " ")
    return s.select("song_id", "model", "idea", "pos", "tag", G.format_lines(body, 5).alias("content"))


def resolved(spark, sf_dir) -> DataFrame:
    return G.reuse_chorus(sections(spark, sf_dir))


def assembled(spark, sf_dir) -> DataFrame:
    return G.assemble(resolved(spark, sf_dir), same=("idea",))


@query("f1_random_window", DUCK_F1)
def f1_random_window(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", P.random_window(F.col("text"), F.col("doc_id"), SEED).alias("prompt"))


@query("f2_keyword_prompt", f"SELECT doc_id, {DUCK_F2_EXPR} AS prompt FROM documents")
def f2_keyword_prompt(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", P.keyword_prompt(F.col("text"), F.col("doc_id"), KEYWORD, SEED).alias("prompt"))


@query("f3_head_words", f"SELECT doc_id, {DUCK_F3_EXPR} AS prompt FROM documents")
def f3_head_words(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", P.head_words(F.col("text")).alias("prompt"))


@query("f4_initial_prompt", f"SELECT doc_id, {DUCK_F4_EXPR} AS prompt FROM documents")
def f4_initial_prompt(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", P.initial_prompt("text", F.col("doc_id"), OPTS).alias("prompt"))


@query(
    "g1_format_lines",
    f"SELECT doc_id, {D.format_lines('text', 5)} AS lyrics FROM ({D.joined_text_sql('(SELECT doc_id, text FROM documents)')})",
)
def g1_format_lines(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select("doc_id", G.format_lines(T.normalise_text(T.filter_lines("text")), 5).alias("lyrics"))


@query(
    "g2_expand_structure",
    f"SELECT doc_id AS song_id, CAST(generate_subscripts({_TAGS}, 1) - 1 AS INTEGER) AS pos, unnest({_TAGS}) AS tag FROM documents",
)
def g2_expand_structure(spark, sf_dir):
    s = docs(spark, sf_dir).select(F.col("doc_id").alias("song_id"))
    return G.expand_structure(s, G.structure()).select("song_id", "pos", "tag")


@query(
    "g4_section_prompt",
    f"""SELECT song_id, pos, CASE WHEN pos = 0 THEN idea ELSE array_to_string(list(chr(10) || chr(10) || tag || chr(10) || content)
  OVER (PARTITION BY song_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END
  || chr(10) || chr(10) || tag || chr(10) AS prompt FROM {DUCK_RESOLVED}""",
)
def g4_section_prompt(spark, sf_dir):
    return G.section_prompt(resolved(spark, sf_dir)).select("song_id", "pos", "prompt")


@query("g4_section_prompt_seq2seq", f"SELECT song_id, pos, 'write a ' || lower(tag) || ' about: ' || idea AS prompt FROM {DUCK_RESOLVED}")
def g4_section_prompt_seq2seq(spark, sf_dir):
    return G.section_prompt(resolved(spark, sf_dir), style="seq2seq").select("song_id", "pos", "prompt")


@query("g5_reuse_chorus", f"SELECT song_id, pos, tag, content FROM {DUCK_RESOLVED}")
def g5_reuse_chorus(spark, sf_dir):
    return resolved(spark, sf_dir).select("song_id", "pos", "tag", "content")


@query("g6_assemble", f"SELECT song_id, lyrics FROM {DUCK_ASSEMBLED}")
def g6_assemble(spark, sf_dir):
    return assembled(spark, sf_dir).select("song_id", "lyrics")


DUCK_G7_NEW = "(SELECT doc_id, source AS model, lang AS name, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS r FROM documents)"
DUCK_G7_EX = "(SELECT DISTINCT d.source AS model, d.lang AS name, l.doc_id % 9 + 1 AS song_no FROM labels l JOIN documents d USING (doc_id))"


@query(
    "g7_assign_song_no",
    f"""WITH k AS (SELECT model, name, count(*) AS m, (SELECT count(*) FROM {DUCK_G7_EX} e WHERE e.model = n.model AND e.name = n.name) AS e
   FROM {DUCK_G7_NEW} n GROUP BY model, name),
 c AS (SELECT model, name, unnest(range(1, m + e + 1)) AS song_no FROM k),
 f AS (SELECT model, name, song_no, row_number() OVER (PARTITION BY model, name ORDER BY song_no) AS r FROM c
   WHERE NOT EXISTS (SELECT 1 FROM {DUCK_G7_EX} e WHERE e.model = c.model AND e.name = c.name AND e.song_no = c.song_no))
 SELECT n.doc_id, n.model, n.name, CAST(f.song_no AS BIGINT) AS song_no FROM {DUCK_G7_NEW} n JOIN f USING (model, name, r)""",
)
def g7_assign_song_no(spark, sf_dir):
    d = docs(spark, sf_dir)
    new = d.select("doc_id", F.col("source").alias("model"), F.col("lang").alias("name"))
    lab = table(spark, sf_dir, "labels").select("doc_id")
    existing = lab.join(d.select("doc_id", "source", "lang"), "doc_id").select(
        F.col("source").alias("model"), F.col("lang").alias("name"), (F.col("doc_id") % 9 + 1).alias("song_no")
    )
    return G.assign_song_no(new, existing, ["model", "name"], "doc_id").select("doc_id", "model", "name", "song_no")


_G8_PATH = "'/corpus/' || source || '/' || lang || ' LYRICS of doc ' || doc_id || '.txt'"


@query(
    "g8_song_name",
    f"""SELECT doc_id, replace({D.strip("regexp_replace(regexp_replace(regexp_extract(" + _G8_PATH + ", '([^/]*)$', 1), '^(\\.*[^.].*)\\.[^.]*$', '\\1'), '(?i)lyrics', '', 'g')")}, ' ', '_') AS name,
  replace('google/' || source, '/', '_') AS model_folder FROM documents""",
)
def g8_song_name(spark, sf_dir):
    d = docs(spark, sf_dir)
    path = F.concat(F.lit("/corpus/"), "source", F.lit("/"), "lang", F.lit(" LYRICS of doc "), F.col("doc_id").cast("string"), F.lit(".txt"))
    return d.select("doc_id", G.song_name(path).alias("name"), G.model_folder(F.concat(F.lit("google/"), "source")).alias("model_folder"))


_HEADER = ("--- Generation Parameters ---\nmodel_name: gpt2-medium\ntokens_per_section: 75\nideal_words_per_line: 5\n"
           "creativity_temperature: 0.7\nlearning_rate: 3e-05\n" + "-" * 40 + "\nStarting song with initial idea: '")


@query(
    "g9_render_song",
    f"SELECT song_id, {D.lit(_HEADER)} || idea || {D.lit(chr(39) + chr(10) + '-' * 40 + chr(10) + chr(10))} || lyrics AS content FROM {DUCK_ASSEMBLED}",
)
def g9_render_song(spark, sf_dir):
    a = assembled(spark, sf_dir)
    return a.select("song_id", G.render_song(F.col("lyrics"), F.col("idea"), OPTS).alias("content"))
