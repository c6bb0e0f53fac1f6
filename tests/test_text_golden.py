"""Golden cases G-1 and G-2 (worked out by hand from the reference's code) and cleaning properties."""

from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators.sentences import clean_corpus

G1_LINES = [
    "Header junk",
    "*** START OF THE PROJECT GUTENBERG EBOOK X ***",
    "The Book of the Prophet Isaiah",
    "BOOK IV.",
    "1:1 In the beginning there was light.",
    "CHAPTER ONE",
    "42",
    "(1)",
    "See https://x.example/a now, my friend.",
    'He said [aside] "hello" to me.',
    "*** END OF THE PROJECT GUTENBERG EBOOK X ***",
    "Footer",
]


def _clean(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [r.sentence for r in clean_corpus(df).orderBy("sent_no").collect()]


def test_g1_cleaning(spark):
    assert _clean(spark, "\n".join(G1_LINES)) == [
        "In the beginning there was light.",
        "See now, my friend.",
        "He said hello to me.",
    ]


def test_g1_without_end_marker_keeps_everything(spark):
    lines = [x for x in G1_LINES if not x.startswith("*** END")]
    text = "\n".join(lines)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    joined = df.select(T.filter_lines("text").alias("t")).first().t
    assert joined.startswith("Header junk") and joined.endswith("Footer")


def test_end_before_start_gives_nothing(spark):
    text = "*** END OF THE PROJECT GUTENBERG EBOOK\nSome words here now\n*** START OF THE PROJECT GUTENBERG EBOOK\nMore words here"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert df.select(T.filter_lines("text").alias("t")).first().t == ""


def test_g2_normalisation(spark):
    assert _clean(spark, "Wait Page 3 of 10 here is IBM. Ok no.") == ["Wait  here is ibm."]
    df = spark.createDataFrame(
        [("i.e.x and i.e. y",), ("grace ^ 12 note",), ('a[b]c "d" é€f',), ("a b",)], "s string"
    )
    got = [r.t for r in df.select(T.sanitize("s").alias("t")).collect()]
    assert got == ["that isx and i.e. y", "grace note", "ac d f", "a b"]


def test_line_rules(spark):
    df = spark.createDataFrame(
        [("  \t x 　",), ("BOOK xiv",), ("ÉTÉ COURT",), ("The Song of Songs",), ("١٢٣",)], "s string"
    )
    r = df.select(
        T.py_strip("s").alias("strip"), T.is_book_heading("s").alias("book"), T.is_short_caps("s").alias("caps"),
        T.is_title_line("s").alias("title"), T.is_digit_line("s").alias("digits"),
    ).collect()
    assert r[0].strip == "x"
    assert r[1].book and not r[0].book
    assert r[2].caps and not r[1].caps
    assert r[3].title
    assert r[4].digits  # Unicode digits, as str.isdigit()


def test_sanitize_is_idempotent_and_whitelisted(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    once = docs.select(T.sanitize("text").alias("a"))
    twice = once.select("a", T.sanitize("a").alias("b"))
    assert twice.filter(F.col("a") != F.col("b")).count() == 0
    assert once.filter(F.col("a").rlike(r"[^a-zA-Z0-9 .,?!'-]")).count() == 0


def test_sentences_are_in_word_window(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    s = clean_corpus(docs)
    bad = s.filter(~T.word_count("sentence").between(3, 150))
    assert bad.count() == 0
