"""Golden cases G-4 .. G-8."""

import datetime as dt

from pyspark.sql import functions as F

from cadenza.operators import prompts as P
from cadenza.operators import quantise as Q
from cadenza.operators import requests as R
from cadenza.operators import songs as G


def test_format_lines(spark):
    df = spark.createDataFrame([("a b c d e f g",), ("",), ("x\ny  z",)], "s string")
    got = [r.t for r in df.select(G.format_lines("s", 5).alias("t")).collect()]
    assert got == ["a b c d e\nf g", "", "x y z"]
    assert df.select(G.format_lines("s", 1).alias("t")).first().t == "a\nb\nc\nd\ne\nf\ng"
    n = df.select(G.format_lines(F.col("s"), F.lit(3)).alias("t")).first().t
    assert n == "a b c\nd e f\ng"


def test_chorus_reuse_and_assemble(spark):
    rows = [(1, 0, "[Verse 1]", "a"), (1, 1, "[Chorus]", "c1"), (1, 2, "[Verse 2]", "b"), (1, 3, "[Chorus]", "c2"),
            (2, 0, "Chorus", ""), (2, 1, "Chorus", "c2"), (2, 2, "Chorus", "c3")]
    df = spark.createDataFrame(rows, "song_id long, pos int, tag string, content string")
    got = {(r.song_id, r.pos): r.content for r in G.reuse_chorus(df).collect()}
    assert got[(1, 3)] == "c1" and got[(2, 0)] == "" and got[(2, 1)] == "c2" and got[(2, 2)] == "c2"
    two = spark.createDataFrame([(1, 0, "[Verse 1]", "a"), (1, 1, "[Chorus]", "c")], "song_id long, pos int, tag string, content string")
    assert G.assemble(two).first().lyrics == "[Verse 1]\na\n\n[Chorus]\nc"


def test_song_name_number_display(spark):
    df = spark.createDataFrame([("/x/My Lyrics file.txt",), (".hidden",), ("a.b.txt",)], "p string")
    assert [r.n for r in df.select(G.song_name("p").alias("n")).collect()] == ["My__file", ".hidden", "a.b"]
    new = spark.createDataFrame([(10, "m", "n"), (11, "m", "n")], "doc_id long, model string, name string")
    ex = spark.createDataFrame([("m", "n", 1), ("m", "n", 2), ("m", "n", 4)], "model string, name string, song_no long")
    got = sorted((r.doc_id, r.song_no) for r in G.assign_song_no(new, ex, ["model", "name"], "doc_id").collect())
    assert got == [(10, 3), (11, 5)]
    d = spark.createDataFrame([("google_flan-t5-small_love",)], "m string")
    assert d.select(R.display_name("m").alias("d")).first().d == "Google flan-t5-small love"


def test_prompts(spark):
    df = spark.createDataFrame([(1, "one two three four five"), (2, "a b c d e f"), (3, "Start here. Nothing else")], "doc_id long, text string")
    r = {x.doc_id: x.p for x in df.select("doc_id", P.random_window(F.col("text"), F.col("doc_id"), 42).alias("p")).collect()}
    assert r[1] == "The world is" and r[2] in ("a b c d e", "b c d e f")
    k = {x.doc_id: x.p for x in df.select("doc_id", P.keyword_prompt(F.col("text"), F.col("doc_id"), "art", 42).alias("p")).collect()}
    assert k[3] == "Start here." and k[1] is None
    assert df.select(P.head_words(F.col("text"), 10).alias("h")).first().h == "one two three four five"


def _validated(spark, bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "request_id long, body string")
    models = spark.createDataFrame([("m",)], "model string")
    return {r.request_id: r for r in R.validate(R.with_defaults(R.parse_requests(df)), models).collect()}


def test_requests(spark):
    v = _validated(spark, [
        "{}", '{"model": "m"}', '{"model": "zz", "prompt": "p"}', '{"model": "m", "prompt": "p", "tokens_per_section": "12"}',
        '{"model": "m", "prompt": "p", "tokens_per_section": "x"}', '{"model": "m", "prompt": "p", "tokens_per_section": "3.7"}',
        '{"model": "m", "prompt": "p", "tokens_per_section": 3.7}', '{"model": "m", "prompt": "p"}', "{bad",
    ])
    assert [v[i].status for i in range(9)] == [400, 400, 404, 200, 500, 500, 200, 200, 500]
    assert v[3].tokens_per_section == 12 and v[6].tokens_per_section == 3 and v[7].tokens_per_section == 75
    assert v[2].error == "Model 'zz' not found. Please check the model name."


def test_quota(spark):
    base = dt.datetime(2024, 1, 1, 8, 0)
    rows = [(i, base + dt.timedelta(minutes=i), 7) for i in range(6)] + [(6, dt.datetime(2024, 1, 2, 0, 0, 1), 7)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long")
    got = {r.event_id: (r.attempt_no, r.allowed) for r in R.daily_quota(df).collect()}
    assert [got[i][1] for i in range(6)] == [True] * 5 + [False]
    assert got[6] == (1, True)


def test_quantise(spark):
    df = spark.createDataFrame([(1, [0.5, -1.0, 0.25]), (2, [1.0]), (3, [0.0, 0.0])], "vec_id long, embedding array<float>")
    q = {r.vec_id: r for r in Q.quantise(df).collect()}
    assert abs(q[1].scale - 1 / 127.5) < 1e-12 and list(q[1].q) == [64, -128, 32]
    assert list(q[2].q) == [127] and q[3].scale == 1.0 and list(q[3].q) == [0, 0]


def test_quant_error_bound(spark, sf):
    e = Q.quant_error(Q.quantise(spark.read.parquet(f"{sf}/embeddings.parquet")))
    # Error is at most half a step, except at the positive clamp (one full step there).
    assert e.filter(F.col("max_err") > F.col("scale") * 1.0000001).count() == 0
