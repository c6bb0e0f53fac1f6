"""Cleaning at line grain (C15 for texts of any size): one enormous file is cleaned by many tasks.

The rules of C15 span lines in five ways: the two markers around the core text, the entity rule that looks for ``<`` in
the whole text, bracket spans, footnote marks and sentences.  Each becomes a small state instead of one long string:

* first marker lines and "holds ``<``" are one aggregate per document;
* whether a bracket is open behind a line is decided by the last bracket up to there, and only while a closing one still
  follows.  That is a prefix maximum: rows are dealt by range, each range hands on its own maximum, and a table with one
  row per range and document carries it over;
* a line that ends a sentence, outside brackets and not behind a footnote mark, ends a *passage*.  Cleaning the passages
  one by one gives what cleaning the whole text gives, so passages are the unit of work.  Passage numbers, and the
  numbers of their sentences, are prefix sums of the same kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..options import GUTENBERG_END, GUTENBERG_START, Options
from ..session import broadcast_if_few, cut_lineage, stored
from .sentences import filter_word_count
from .training import global_cumsum

_OPEN, _CLOSE = r"\[", r"\]"


def slice_lines(lines: DataFrame, key: str = "doc_id", line: str = "line") -> DataFrame:
    """B1 on ``(key, line_no, line)``: lines strictly between the first START and the first END line of documents that
    hold both."""
    marks = lines.groupBy(key).agg(
        F.min(F.when(F.col(line).contains(GUTENBERG_START), F.col("line_no"))).alias("_s"),
        F.min(F.when(F.col(line).contains(GUTENBERG_END), F.col("line_no"))).alias("_e"),
    ).where("_s IS NOT NULL AND _e IS NOT NULL").withColumnRenamed(key, "_k")
    out = lines.join(broadcast_if_few(marks), F.col(key) == F.col("_k"), "left")
    inside = F.col("_k").isNull() | ((F.col("line_no") > F.col("_s")) & (F.col("line_no") < F.col("_e")))
    return out.where(inside).drop("_k", "_s", "_e")


def _carried(rows: DataFrame, key: str, value: str, order: str, name: str) -> DataFrame:
    """``name``: the largest ``value`` up to and including each row of its key, in ``order`` order.

    ``rows`` stand in ranges (``_pid``) of (key, order).  One row per range and key carries the maxima over.
    """
    tops = rows.groupBy("_pid", key).agg(F.max(value).alias("_top"))
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("_pid", F.col(key).alias("_k"), F.max("_top").over(before).alias("_before")).withColumnRenamed("_pid", "_p")
    inside = Window.partitionBy("_pid", key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_local", F.max(value).over(inside))
    out = local.join(broadcast_if_few(tops), (F.col("_pid") == F.col("_p")) & (F.col(key) == F.col("_k")))
    return out.withColumn(name, F.greatest("_local", "_before")).drop("_local", "_before", "_p", "_k")


def _last(text: Column, bracket: str) -> Column:
    """1-based place of the last ``bracket``, 0 where there is none."""
    behind = F.length(F.regexp_extract(text, rf"(?s){bracket}([^{bracket}]*)\z", 1))
    return F.when(text.rlike(bracket), F.length(text) - behind).otherwise(0)


def passages(lines: DataFrame, key: str = "doc_id", line: str = "line") -> DataFrame:
    """``(key, passage, line_no, line)``: the kept lines (B1-B11, C1) with the number of their passage."""
    kept = slice_lines(lines.select(key, F.col("line_no").cast("bigint").alias("line_no"), F.col(line).alias("line")), key)
    kept = stored(kept.withColumn("line", T.clean_line("line")).where(T.keep_line("line")), "lines")
    # The entity rule needs to know whether '<' stands anywhere in the document.
    less = kept.where(F.col("line").contains("<")).groupBy(F.col(key).alias("_k")).agg(F.lit(True).alias("_less"))
    kept = kept.join(broadcast_if_few(less), F.col(key) == F.col("_k"), "left").drop("_k")
    repaired = T.repair_text("line", F.coalesce("_less", F.lit(False)))
    kept = stored(kept.select(key, "line_no", repaired.alias("line")), "repaired")
    opens, closes = _last(F.col("line"), _OPEN), _last(F.col("line"), _CLOSE)
    # 2 * line_no + 1 where the line's last bracket opens, 2 * line_no where it closes: the larger one came later.
    bracket = F.when(opens > closes, 2 * F.col("line_no") + 1).when(closes > 0, 2 * F.col("line_no"))
    # Only what stands behind the line's last bracket is sure to stay, whatever is open before the line.
    tail = F.regexp_replace("line", r"(?s)\A.*[\[\]]", "")
    ends = T.sanitize(tail).rlike(r"[.?!]\z") & ~F.col("line").rlike(rf"\^{T.SPACE}*\z")
    marks = kept.select(key, "line_no", bracket.alias("_b"), ends.alias("_ends"), F.when(closes > 0, F.col("line_no")).alias("_closes"))
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = cut_lineage(marks.repartitionByRange(n, key, "line_no").withColumn("_pid", F.spark_partition_id()))
    last_close = marks.groupBy(F.col(key).alias("_q")).agg(F.max("_closes").alias("_last_close"))
    state = _carried(marks, key, "_b", "line_no", "_state").join(broadcast_if_few(last_close), F.col(key) == F.col("_q"), "left")
    # Open only if a closing bracket follows: one that never closes spans nothing.
    is_open = F.coalesce((F.col("_state") % 2 == 1) & (F.col("line_no") < F.col("_last_close")), F.lit(False))
    numbered = state.select(key, "line_no", (F.col("_ends") & ~is_open).cast("bigint").alias("_end"))
    numbered = global_cumsum(numbered, "_end", ["line_no"], [key], "passage").select(F.col(key).alias("_k"), F.col("line_no").alias("_l"), "passage")
    return kept.join(numbered, (F.col(key) == F.col("_k")) & (F.col("line_no") == F.col("_l"))).select(key, "passage", "line_no", "line")


def clean_lines(lines: DataFrame, opts: Options = Options(), key: str = "doc_id", line: str = "line") -> DataFrame:
    """C15 from ``(key, line_no, line)``: ``(key, sent_no, sentence)``, equal to ``clean_corpus`` on the joined texts.

    Lines come numbered (``read_lines``); a passage, the lines up to one that ends a sentence, is one group.  The opt-in
    rule for subtitle cues spans raw line ends and is not taken here.
    """
    if opts.strip_subtitle_cues:
        raise ValueError("subtitle cues span lines: clean whole documents with clean_corpus")
    parts = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    text = F.array_join(F.transform(parts, lambda x: x["line"]), " ")
    joined = passages(lines, key, line).groupBy(key, "passage").agg(text.alias("text"))
    cleaned = joined.select(key, "passage", T.split_sentences(T.strip_page_marks(T.sanitize("text"))).alias("_pieces"))
    cleaned = stored(cleaned, "passages")
    # A piece is counted, kept or not, as in a whole text; sentences of later passages follow on.
    sizes = cleaned.select(key, "passage", F.size("_pieces").cast("bigint").alias("_n"))
    starts = global_cumsum(sizes, "_n", ["passage"], [key], "_start").select(F.col(key).alias("_k"), F.col("passage").alias("_p"), "_start")
    sents = cleaned.join(starts, (F.col(key) == F.col("_k")) & (F.col("passage") == F.col("_p")))
    sents = sents.select(key, "_start", F.posexplode("_pieces").alias("_i", "sentence"))
    sents = sents.select(key, (F.col("_start") + F.col("_i")).alias("sent_no"), "sentence")
    return filter_word_count(sents, opts.min_words, opts.max_words).withColumn("sentence", T.sentence_case(F.col("sentence")))
