"""Work that must grow with the text alone: long lines, long texts, one-file tables, rows that stay where they are."""

import tempfile
import time

from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.operators import songs as G
from cadenza.operators import training as TR
from cadenza.operators.lines import clean_lines
from cadenza.operators.ngram import next_token_dist
from cadenza.operators.sentences import clean_corpus


def seconds(df):
    start = time.time()
    rows = df.collect()
    return time.time() - start, rows


def test_classes_test_the_common_characters_first(spark):
    df = spark.range(4).select(F.repeat(F.lit("plain words, é and　more; "), 40_000).alias("text"))
    df = df.localCheckpoint()

    def count(pattern):
        return df.select(F.regexp_count("text", F.lit(pattern)).alias("n"))

    for new, old in ((f"{T.NON_SPACE}+", f"[^{T.WS}]+"), (T.WHITELIST_PATTERN, f"[^a-zA-Z0-9{T.WS}.,?!'-]+")):
        fast, slow = (min((seconds(count(p)) for _ in range(3)), key=lambda x: x[0]) for p in (new, old))
        assert fast[1] == slow[1]
        assert fast[0] < 0.7 * slow[0]


def test_a_long_line_with_a_bracket_is_read_once(spark):
    text = "so [many] words " + "in one line here. " * 20_000
    lines = spark.createDataFrame([(1, 0, text)], "doc_id long, line_no long, line string")
    took, rows = seconds(clean_lines(lines))
    want = clean_corpus(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert sorted(r.sent_no for r in rows) == sorted(r.sent_no for r in want)
    assert took < 30


def test_layout_of_a_long_text(spark):
    words = [f"w{k}" for k in range(100_000)]
    df = spark.createDataFrame([(" \n".join(words), n) for n in (0, 1, 7, 99_999, 100_000, 2_000_000_000)] + [("", 3), (None, 3), ("  ", 3)], "text string, n long")
    took, rows = seconds(df.select("text", "n", G.format_lines("text", F.col("n")).alias("out")))
    for r in rows:
        w, n = (r.text or "").split(), max(r.n, 1)
        assert r.out == "\n".join(" ".join(w[k:k + n]) for k in range(0, len(w), n))
    assert took < 20


def test_encode_moves_rows_and_not_tokens(spark):
    df = spark.createDataFrame([("m", k, f"a b{k} c, a") for k in range(50)], "model string, doc_id long, sentence string")
    voc = spark.createDataFrame([("m", "a", 4), ("m", "c", 5), ("m", ",", 6)], "model string, token string, id long")
    enc = TR.encode(df, voc, "sentence", ["doc_id"])
    plan = enc._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Generate") < plan.index("Exchange hashpartitioning")
    assert {tuple(r.ids) for r in enc.collect()} == {(4, 1, 5, 6, 4)}


def test_one_file_is_read_by_all_tasks(spark, sf):
    from cadenza.plans.songs import g1_format_lines

    assert g1_format_lines(spark, sf).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_a_single_continuation_is_certain(spark):
    df = spark.createDataFrame([([("x", 3)],)], "c array<struct<token:string,cnt:bigint>>")
    dist = df.select(next_token_dist(F.col("c"), F.lit(3), F.array(F.lit("x")), 0.7, 50, 0.95, 1.25).alias("d"))
    assert [tuple(x) for x in dist.first().d] == [("x", 1, 1.0)]
    plan = dist._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.index("size(") < plan.index("aggregate(")


def test_lines_of_many_documents_come_from_few_folders(spark):
    from cadenza.plans.sources import a1_read_lines

    texts = {k: "\n".join(f"{k} line {j}" for j in range(k % 700)) + ("\r\nx\r" if k % 3 == 0 else "") for k in range(1500)} | {1500: None}
    sf_dir = tempfile.mkdtemp()
    rows = [(k, t) for k, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{sf_dir}/documents.parquet")
    start = time.time()
    found = a1_read_lines(spark, sf_dir)
    assert len(found.inputFiles()) <= 4
    got = {(r.doc_id, r.line_no): r.line for r in found.collect()}
    want = {(k, j): line for k, t in texts.items() for j, line in enumerate((t + "\n").replace("\r\n", "\n").replace("\r", "\n").split("\n")[:-1] if t else [""])}
    assert got == want
    assert time.time() - start < 60


def test_only_pieces_that_are_merged_move_their_text(spark):
    from cadenza.operators.sentences import merge_abbrev

    rows = [(d, 3 * k, "Met by dr." if k % 5 == d else f"Piece {k} of {d}.") for d in range(3) for k in range(40)] + [(7, 0, "Last word dr.")] + 2 * [(8, 0, "Twice.")]
    df = spark.createDataFrame(rows, "doc_id long, sent_no long, sentence string")
    out = merge_abbrev(df, spark.createDataFrame([("dr", True), ("by", False)], "token string, is_abbrev boolean"))
    want = []
    for d, n, text in sorted(rows):
        if want and want[-1][0] == d and want[-1][2].endswith("dr."):
            want[-1] = (d, want[-1][1], f"{want[-1][2]} {text}")
        else:
            want.append((d, n, text))
    assert sorted(map(tuple, out.collect())) == want
    # One branch hands pieces on as they are, the other groups the merged ones.
    alone = out._jdf.queryExecution().optimizedPlan().children().head().toString()
    assert "collect_list" not in alone and "Aggregate" not in alone


def test_a_stream_of_one_file_is_cleaned_by_all_tasks(spark):
    folder = tempfile.mkdtemp()
    rows = [(k, f"Sentence number {k} of the file. And a second one.") for k in range(64)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/in")
    sdf = spark.readStream.schema("doc_id long, text string").parquet(f"{folder}/in")
    parts = []

    def keep(batch, _):
        parts.append(batch.rdd.getNumPartitions())

    clean_corpus(sdf).writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()
    assert parts == [spark.sparkContext.defaultParallelism]


def test_rounds_with_a_low_penalty_do_not_double_their_plan(spark):
    from cadenza.operators import ngram as NG
    from cadenza.operators.generate import CandidateTables, Step, init_states
    from cadenza.session import cut_lineage

    sents = spark.createDataFrame([("m", 1, "a b c d."), ("m", 2, "a c b d.")], "model string, doc_id long, sentence string")
    step = Step(CandidateTables(cut_lineage(NG.fit_ngrams(sents)), 10), 7, low_penalties=True)
    state = [(1, "m", 0, "a", "a\n\n[Verse 1]\n", 9, 0.7, 3, 0.95, 0.2, 1)]
    columns = ("song_id long, model string, section_pos int, idea string, prompt string, budget int, temperature double, top_k int, "
               "top_p double, penalty double, attempt int")
    packed, sizes = step.pack(cut_lineage(init_states(spark.createDataFrame(state, columns)))), []
    for _ in range(3):
        packed = step(packed)
        sizes.append(packed._jdf.queryExecution().optimizedPlan().toString().count("Join"))
    assert sizes[2] <= sizes[0]


def test_the_split_without_positions_numbers_one_document_of_a_group(spark, monkeypatch):
    from pyspark.sql import functions as F

    from cadenza.operators import training as TR

    rows = [(f"m{d % 3}", None if d == 50 else d, s, f"text {d} {s}") for d in range(61) for s in range(0, 2 * (d % 5 + 1), 2)]
    df = spark.createDataFrame(rows, "model string, doc_id long, sent_no long, sentence string").repartition(5)
    want = TR.ordered_split(df).select("model", "doc_id", "sent_no", "sentence", "split")
    names, kept = [], TR.stored
    monkeypatch.setattr(TR, "stored", lambda d, name: names.append((name, d)) or kept(d, name))
    got = TR.train_eval_split(df)
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())
    assert {r.split for r in got.select("split").collect()} == {"train", "eval"}
    (_, first), (_, divided) = names
    assert "Window" not in first._jdf.queryExecution().toString()
    assert divided.groupBy("model").agg(F.countDistinct("doc_id").alias("n")).where("n > 1").isEmpty()


def test_words_are_taken_apart_once_they_are_counted(spark):
    from cadenza.operators import bpe

    df = spark.createDataFrame([("a", "the cat, the hat."), ("a", "a the"), ("b", "x")], "model string, sentence string")
    pairs = bpe.pair_counts(bpe.word_table(df))
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1  # the count of words is behind it: no condition is moved below that
    got = {(r.model, r.left, r.right): r.n for r in pairs.collect()}
    assert got == {("a", "t", "h"): 3, ("a", "h", "e</w>"): 3, ("a", "c", "a"): 1, ("a", "a", "t</w>"): 2, ("a", "h", "a"): 1}


def test_the_states_are_hashed_and_the_candidate_table_is_not_sorted(spark):
    from cadenza.operators import generate as G
    from cadenza.operators import ngram as NG

    ngrams = NG.fit_ngrams(spark.createDataFrame([("m", "the cat sat on the mat.")], "model string, sentence string"))
    prompts = spark.createDataFrame([(1, "m", 0, 1, "the cat", "the cat", 4, 0.7, 50, 0.95, 1.25)], "song_id long, model string, section_pos int, "
                                    "attempt int, prompt string, idea string, budget int, temperature double, top_k int, top_p double, penalty double")
    cands = G.CandidateTables(ngrams, 60, broadcast_limit=0)
    step = G.Step(cands, 42)
    plan = step(step.pack(G.init_states(prompts)))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BuildLeft" in plan and "SortMergeJoin" not in plan
    assert [r.tokens for r in G.generate_section(prompts, cands, 42).collect()] == [
        r.tokens for r in G.generate_section(prompts, G.CandidateTables(ngrams, 60), 42).collect()]
