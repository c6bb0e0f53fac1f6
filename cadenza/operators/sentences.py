"""Corpus cleaning at document grain: lines -> joined text -> sentences.

Each document is one row; every rule is a column expression over that row, so the plan is
scan -> project -> generate -> filter with no shuffle before the explode.  The unit of work is one
document (the reference's rules span whole files: bracket spans, sentence breaks across lines).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..options import Options
from ..session import broadcast_if_few, cut_lineage, ensure_parallelism, stored
from .training import global_cumsum


def explode_sentences(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sentence piece, ``sent_no`` = 0-based position in the document."""
    return docs.select(
        key, F.posexplode(T.split_sentences(F.col(text_col))).alias("sent_no", "sentence")
    ).withColumn("sent_no", F.col("sent_no").cast("bigint"))


def filter_word_count(sents: DataFrame, lo: int = 3, hi: int = 150, col: str = "sentence") -> DataFrame:
    """Inclusive word-count window."""
    return sents.filter(T.has_words(F.col(col), lo, hi))


def clean_corpus(docs: DataFrame, opts: Options = Options(), key: str = "doc_id", text_col: str = "text",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents -> ``(*keep, key, sent_no, sentence)``; one lazy, shuffle-free plan."""
    docs = ensure_parallelism(docs.select(*keep, key, text_col))
    joined = docs.select(
        *keep, key, T.normalise_text(T.filter_lines(F.col(text_col), opts.strip_subtitle_cues)).alias("text")
    )
    sents = joined.select(
        *keep, key, F.posexplode(T.split_sentences(F.col("text"))).alias("sent_no", "sentence")
    ).withColumn("sent_no", F.col("sent_no").cast("bigint"))
    sents = filter_word_count(sents, opts.min_words, opts.max_words)
    return sents.withColumn("sentence", T.sentence_case(F.col("sentence")))


def corpus_stats(lines: DataFrame, sentences: DataFrame, key: str = "doc_id") -> DataFrame:
    """C14: files read, lines read, sentences kept (one row)."""
    a = lines.agg(F.countDistinct(key).alias("n_files"), F.count(F.lit(1)).alias("n_lines"))
    b = sentences.agg(F.count(F.lit(1)).alias("n_sentences"))
    return a.crossJoin(b)


# ---- C11: corpus-learned abbreviations (stand-in for a pretrained sentence model) ----------------
ABBREVIATION_DOT = 0.99  # how often an abbreviation is followed by a dot, in the score's alternative hypothesis


def learn_abbreviations(sents: DataFrame, col: str = "sentence", min_dot: int = 5, max_len: int = 5,
                        min_ratio: float = 0.9) -> DataFrame:
    """Count each lower-cased token with and without a final dot; flag likely abbreviations.

    ``score`` is the log-likelihood ratio of Kiss and Strunk (2006): how much better the counts fit a token that nearly
    always has a dot than one that has it as often as any token.  It is reported and not used as the cut.  Partial
    aggregation happens map-side, so a hot token only costs one row per partition; the two totals are one row.
    """
    toks = sents.select(F.explode(T.words(F.col(col))).alias("tok"))
    toks = toks.select(
        F.lower(F.regexp_replace("tok", r"\.\z", "")).alias("token"),
        F.col("tok").endswith(".").alias("dotted"),
    ).filter(F.col("token") != "")
    counts = cut_lineage(toks.groupBy("token").agg(
        F.count_if(F.col("dotted")).alias("n_dot"), F.count_if(~F.col("dotted")).alias("n_nodot")
    ))
    dots, plain = counts.agg(F.sum("n_dot"), F.sum("n_nodot")).first()
    any_ = (dots or 0) / max(1, (dots or 0) + (plain or 0))
    ratio = F.col("n_dot") / (F.col("n_dot") + F.col("n_nodot"))
    # Where no token, or every token, has a dot, the two hypotheses cannot be told apart.
    score = 2 * (F.col("n_dot") * F.lit(math.log(ABBREVIATION_DOT / any_)) + F.col("n_nodot") * F.lit(
        math.log((1 - ABBREVIATION_DOT) / (1 - any_)))) if 0 < any_ < 1 else F.lit(0.0)
    return counts.withColumn("score", F.round(score, 6)).withColumn(
        "is_abbrev",
        (F.col("n_dot") >= min_dot)
        & F.col("token").rlike(r"^[a-z]+\z")
        & (F.length("token") <= max_len)
        & (ratio >= min_ratio),
    )


def merge_abbrev(sents: DataFrame, abbrevs: DataFrame, key: str = "doc_id", col: str = "sentence") -> DataFrame:
    """Re-join a sentence piece to the next one when it ends in a learned abbreviation.

    The id of a merged sentence is the number of real boundaries before it in its document: a prefix sum over ranges of
    (document, sentence), so that one huge document is numbered by many tasks.  The rows are written once under a row
    number, and only the numbers are dealt by range: text moves for pieces that are joined to others and for no others.
    """
    last = F.lower(F.regexp_extract(F.col(col), r"([^ ]+)\.\z", 1))
    flagged = sents.select(key, "sent_no", col).join(
        broadcast_if_few(abbrevs.filter("is_abbrev").select(F.col("token").alias("_abbr"))),
        last == F.col("_abbr"),
        "left",
    ).withColumn("_real", F.col("_abbr").isNull().cast("bigint")).drop("_abbr")
    # A row without a key has no place in a document (``global_cumsum``).
    rows = stored(flagged.where(F.col(key).isNotNull()).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    numbered = cut_lineage(global_cumsum(rows.drop(col), "_real", ["sent_no"], [key], "_sid"))
    joined = numbered.where("_real = 0").select(key, "_sid").distinct()
    joined = broadcast_if_few(numbered.join(broadcast_if_few(joined), [key, "_sid"]).select("_row", "_sid"))
    merged = rows.join(joined, "_row").groupBy(key, "_sid").agg(
        F.min("sent_no").alias("sent_no"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("sent_no", col))), lambda x: x[col]), " "
        ).alias(col),
    ).drop("_sid")
    alone = rows.join(joined, "_row", "left_anti").select(key, "sent_no", F.coalesce(col, F.lit("")).alias(col))
    return alone.unionByName(merged)
