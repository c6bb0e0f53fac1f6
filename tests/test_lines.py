"""Line-grain cleaning equals cleaning whole texts, also for one file that several tasks read; lines keep their task."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators.lines import clean_lines, passages
from cadenza.operators.sentences import clean_corpus
from cadenza.sources.files import read_lines

PIECES = ["The river runs through the old valley.", "and nobody knows why", "He said [aside", "foo.]", "more text] here.", "[gone.]", "open [ for ever",
          "a mark ^", "12 men came home.", "Page", "3 of 10 is here.", "Chapter", "7 begins now!", "THE END", "42", "one &amp; two.", "a < b here.",
          "Is it so?", "  ", "See https://x.example/a", "i.e. not so", "closing ] alone.", "“Curly” ﬁne ［wide］ text.", "Itâ€™s ﬁne [x] [y", "] \"ok.\""]
MARKS = ["*** START OF THE PROJECT GUTENBERG EBOOK X ***", "*** END OF THE PROJECT GUTENBERG EBOOK X ***"]


def texts(seed, n, size):
    rng = random.Random(seed)
    for k in range(n):
        lines = [rng.choice(PIECES) for _ in range(rng.randrange(size))]
        for mark in MARKS:
            if rng.random() < 0.3:
                lines.insert(rng.randrange(len(lines) + 1), mark)
        yield k, "\n".join(lines)


def rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "sent_no", "sentence").collect())


def test_equal_to_whole_texts(spark):
    docs = spark.createDataFrame([*texts(3, 150, 40), (1000, ""), (1001, None)], "doc_id long, text string")
    lines = docs.select("doc_id", F.posexplode(T.split_lines("text")).alias("line_no", "line")).repartition(7)
    want = rows(clean_corpus(docs))
    assert len(want) > 500 and rows(clean_lines(lines)) == want


def test_one_file_is_cleaned_by_several_tasks(spark):
    path = os.path.join(tempfile.mkdtemp(), "one.txt")
    text = "\n".join(t for _, t in texts(4, 400, 40) if not any(m in t for m in MARKS))
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        lines = read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 3
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan  # lines stay in their tasks
        assert [r.line for r in lines.orderBy("line_no").collect()] == text.split("\n")
        assert [r.line_no for r in lines.orderBy("line_no").collect()] == list(range(text.count("\n") + 1))
        lines = lines.withColumn("doc_id", F.lit(1))
        assert passages(lines).select("passage").distinct().count() > 500
        assert rows(clean_lines(lines)) == rows(clean_corpus(spark.createDataFrame([(1, text)], "doc_id long, text string")))
    finally:
        spark.conf.set(key, before)
