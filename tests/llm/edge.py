"""Rows that every operator must take: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

LONG = ("The quick onthe brown of and the fox. " * 30_000).strip()  # over a million characters

ROWS = [
    (1, "The house of the rising sun and the river.", "en", "a"),
    (2, "The  house of\tthe rising\nsun and the river.", "en", "a"),
    (2, "The  house of\tthe rising\nsun and the river.", "en", "a"),
    (3, None, None, None),
    (None, "", "en", "a"),
    (None, "The house of the rising sun and the river.", None, "b"),
    (4, LONG, "en", "a"),
    (5, "   \n\t ", "de", None),
    (6, "Nicht der und die das \U0001F600 é 漢字", "de", "b"),
    (6, "another text for the same id", None, "b"),
]
# Names that operators use themselves.
CLASH = ("kept", "keep_id", "score", "size", "rank", "row", "key", "fp", "digest", "content", "bucket", "spans", "copies",
         "taken", "starts", "items", "version", "text_sha256", "component_id", "family", "_pipeline_id2")
SCHEMA = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASH)


def edge(spark):
    return spark.createDataFrame([(*r, *(c.upper() for c in CLASH)) for r in ROWS], SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def docs_of(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
