"""D2, D3, D7 where the vocabulary is too large to be broadcast: rows keep their place, and no occurrence of a token moves."""

import random

import pytest

from cadenza.operators import training as TR


def rows_of(spark, n=120):
    rng = random.Random(3)
    text = lambda: None if rng.random() < 0.05 else " ".join(rng.choice(("the", f"w{rng.randrange(300)}", "it's", ",", "é?")) for _ in range(rng.randrange(12)))
    rows = [(f"m{d % 3}" if d % 17 else None, d, s, text()) for d in range(n) for s in range(4)]
    return spark.createDataFrame(rows, "model string, doc_id long, sent_no long, sentence string").repartition(5)


def test_a_large_vocabulary_gives_the_same_ids(spark, monkeypatch):
    df = rows_of(spark)
    voc = TR.build_vocab(df.where("doc_id < 80"))
    keys = ["doc_id", "sent_no"]
    want = {tuple(r[:3]): r.ids for r in TR.encode(df, voc, "sentence", keys, add_eos=True).collect()}
    monkeypatch.setattr(TR, "VOCABULARY_BYTES", 0)
    got = TR.encode(df, voc, "sentence", keys, add_eos=True).collect()
    assert len(got) == len(want) and {tuple(r[:3]): r.ids for r in got} == want
    assert any(1 in ids for ids in want.values()) and any(max(ids) > 50 for ids in want.values())


@pytest.mark.parametrize("dealt_by", [None, ["model", "doc_id"], ["doc_id"]])
def test_two_texts_are_encoded_together_and_no_token_moves(spark, monkeypatch, dealt_by):
    monkeypatch.setattr(TR, "VOCABULARY_BYTES", 0)
    df = TR.make_pairs(rows_of(spark), style="seq2seq")
    voc, keys = TR.build_vocab(df), ["doc_id", "sent_no"]
    both = TR.encode(df, voc, ["input_text", "target_text"], keys, out_col=["ids", "labels"], dealt_by=dealt_by)
    plan = both._jdf.queryExecution().executedPlan().toString()
    # One dealing of rows as text, or none where the caller has dealt them; tokens are never exploded.
    assert "Generate" not in plan and "Join" not in plan
    got = {tuple(r[:3]): (r.ids, r.labels) for r in both.collect()}
    for k, (c, name) in enumerate((("input_text", "ids"), ("target_text", "labels"))):
        assert {x: v[k] for x, v in got.items()} == {tuple(r[:3]): r[name] for r in TR.encode(df, voc, c, keys, out_col=name).collect()}


def test_the_split_is_stored_in_buckets_and_its_uses_move_no_text(spark, monkeypatch):
    df = rows_of(spark).where("model IS NOT NULL")
    want = {}
    for r in sorted(df.collect(), key=lambda r: (r.model, r.doc_id, r.sent_no)):
        want.setdefault(r.model, []).append((r.doc_id, r.sent_no))
    # Starts that are too many to broadcast are dealt to the buckets.
    monkeypatch.setattr(TR, "broadcast_if_few", lambda d: TR.stored(d, "starts"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = TR.ordered_split(df, v=0.3)
        plan = split._jdf.queryExecution().executedPlan().toString()
        got = split.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # of the starts
    assert plan.index("Bucketed: true") < plan.index("Exchange hashpartitioning")  # the rows are the other side
    for r in got:
        n = len(want[r.model])
        cut = int(n * 0.7)
        assert r.n == n and want[r.model][r.pos] == (r.doc_id, r.sent_no)
        assert (r.split, r.split_pos) == (("train", r.pos) if r.pos < cut else ("eval", r.pos - cut))
    assert len(got) == sum(map(len, want.values()))
