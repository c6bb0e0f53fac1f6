"""The operators' registered queries, each over its whole table, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_parallelism, table
from . import decontaminate as contamination
from . import exact_dedup as exact
from . import html_extract, langid, lexical, licenses, merkle, mixing, pii, quality, sentencepieces, simhash, substrings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return deco


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ensure_parallelism(table(spark, sf_dir, "documents"))


@_register(r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(_documents(spark, sf_dir))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_register(rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, width, array_to_string(w[i:i + width - 1], ' ') AS phrase
        FROM (SELECT item_id, w, least(13, len(w)) AS width, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
              FROM b WHERE len(w) > 0)),
widths AS (SELECT DISTINCT width FROM win),
grams AS (SELECT doc_id, width, i, array_to_string(w[i:i + width - 1], ' ') AS phrase
          FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM d, widths WHERE len(w) >= width)),
hits AS (SELECT doc_id, item_id, i, g.width FROM grams g JOIN win USING (phrase) WHERE g.width = win.width),
spots AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM (SELECT DISTINCT doc_id, i, width FROM hits)) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return contamination.report(contamination.decontaminate(_documents(spark, sf_dir), benchmark))


@_register()
def op3_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(ensure_parallelism(table(spark, sf_dir, "pages")))


@_register()
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    weights, temperature = licenses.fit(spark, docs.select("doc_id", "text"))
    return licenses.licences(docs, weights, temperature)


@_register()
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = langid.detect(docs, langid.fit(langid.training_rows(docs)))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@_register()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = quality.fit(quality.training_rows(docs, table(spark, sf_dir, "labels")))
    return quality.score(docs, model)


@_register()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_documents(spark, sf_dir))


@_register()
def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "taken", "source", "copies")


@_register()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(_documents(spark, sf_dir))


@_register()
def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(_documents(spark, sf_dir))


# Runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case.
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@_register(rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
scores AS (SELECT item_id, r, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms))))) AS BIGINT) AS score
           FROM q JOIN tf USING (term) JOIN df USING (term), s GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
""")
def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@_register()
def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentencepieces.encode(_documents(spark, sf_dir), model, add_eos=True)
    return sentencepieces.digests(sentencepieces.decode(encoded, model))


def _part(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE octet_length(encode(CAST({column} AS VARCHAR))) || ':' || {column} END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_part, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


# A tree's levels, one after the other: parents hash every two consecutive nodes, the last one alone where it is odd.
@_register(f"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS tab FROM (
   WITH RECURSIVE b AS (SELECT i, 0 AS k, CAST(i AS BIGINT) AS c FROM range(256) t(i)
     UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM b WHERE k < 8)
   SELECT i, c FROM b WHERE k = 8)),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, lang, {_leaf('n_chars')} AS leaf, {_leaf('(n_chars + 1)')} AS other,
   coalesce(xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, x: xor(tab[(xor(a, x) & 255) + 1], a >> 8))) % 7 = 0, false) AS touched
  FROM documents, crc),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS total FROM d),
g AS MATERIALIZED (
  SELECT lang, 0 AS lev, pos AS i, total AS n, leaf AS h FROM p
  UNION ALL
  SELECT lang, any_value(lev) + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM g WHERE n > 1 GROUP BY lang, i // 2),
top AS MATERIALIZED (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM g WHERE n = 1),
u AS MATERIALIZED (
  SELECT 0 AS lev, i, n, h FROM top
  UNION ALL
  SELECT any_value(lev) + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY i // 2),
proof AS (
  SELECT r, string_agg(h, '' ORDER BY part, lev) AS hs FROM (
   SELECT r, 0 AS part, g.lev, g.h FROM p JOIN g ON p.lang IS NOT DISTINCT FROM g.lang AND g.i = xor(p.pos >> g.lev, 1) AND g.n > 1
   UNION ALL
   SELECT r, 1, u.lev, u.h FROM p JOIN top ON p.lang IS NOT DISTINCT FROM top.lang JOIN u ON u.i = xor(top.i >> u.lev, 1) AND u.n > 1)
  GROUP BY r),
f AS (
  SELECT r, lang, 0 AS lev, pos AS i, total AS n, CASE WHEN touched THEN other ELSE leaf END AS h FROM p
  UNION ALL
  SELECT f.r, f.lang, f.lev + 1, f.i // 2, (f.n + 1) // 2, sha256(CASE WHEN s.h IS NULL THEN f.h WHEN f.i % 2 = 1 THEN s.h || f.h ELSE f.h || s.h END)
  FROM f LEFT JOIN g s ON s.lang IS NOT DISTINCT FROM f.lang AND s.lev = f.lev AND s.i = xor(f.i, 1) WHERE f.n > 1),
f2 AS (
  SELECT f.r, 0 AS lev, top.i AS i, top.n AS n, f.h FROM f JOIN top ON f.lang IS NOT DISTINCT FROM top.lang WHERE f.n = 1
  UNION ALL
  SELECT f2.r, f2.lev + 1, f2.i // 2, (f2.n + 1) // 2, sha256(CASE WHEN s.h IS NULL THEN f2.h WHEN f2.i % 2 = 1 THEN s.h || f2.h ELSE f2.h || s.h END)
  FROM f2 LEFT JOIN u s ON s.lev = f2.lev AND s.i = xor(f2.i, 1) WHERE f2.n > 1)
SELECT p.doc_id, p.leaf, top.h AS subroot, root.h AS root, sha256(coalesce(proof.hs, '')) AS proof_sha256, f2.h AS folded_root, f2.h = root.h AS verified
FROM p JOIN top ON p.lang IS NOT DISTINCT FROM top.lang JOIN f2 ON f2.r = p.r AND f2.n = 1 LEFT JOIN proof ON proof.r = p.r, (SELECT h FROM u WHERE n = 1) root
""")
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return merkle.verified(merkle.manifest(docs, changed=merkle.tampered(docs)))
