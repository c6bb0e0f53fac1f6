from collections import defaultdict

import pytest

from cadenza.llm import mixing
from cadenza.llm.mixing import mix, pivotal, ranked, targets_of

from .edge import ROWS, edge, none


def brute_targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in capped else share[s] for s in order}
        capped |= over


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 50, "c": 1000, "d": 3, "é": 70, None: 20}, {None: 5}, {"x": 0, "y": 10},
    {f"s{k}": (k * 37) % 11 * 10 for k in range(30)},
])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in targets_of(frame).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s]) for s in want)


def test_ranks(spark):
    frame = spark.createDataFrame([(s,) for s in ["b", None, "a", "é", "Z"]], "source string")
    assert {r.source: r["rank"] for r in ranked(frame, "source").collect()} == {"Z": 0, "a": 1, "b": 2, "é": 3, None: 4}


def mixed(df, **more):
    return df.select("doc_id", "source", "size", "source_size", "target", "copies", "taken").collect()


@pytest.mark.parametrize("group_rows", [4, 256])
def test_sources_meet_their_targets(spark, sf, group_rows):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixed(mix(docs, group_rows=group_rows))
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    sizes = {r.doc_id: len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", r.text or "")]) for r in docs.collect()}
    taken, source_size, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.size == sizes[r.doc_id] and r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] += r.taken
        source_size[r.source] += r.size
        largest[r.source] = max(largest[r.source], r.size)
    want = brute_targets(source_size)
    for r in rows:
        assert r.source_size == source_size[r.source] and r.target == pytest.approx(want[r.source])
        assert abs(taken[r.source] - r.target) <= largest[r.source]
    assert sorted(rows) == sorted(mixed(mix(docs.repartition(5), group_rows=group_rows)))


def test_expected_copies_are_kept(spark):
    rows = [("k", i, 10 + i % 7, (10 + i % 7) * 0.3) for i in range(40)]
    frame = spark.createDataFrame([(f"k{s}", i, a, m) for s in range(120) for _, i, a, m in rows], "key string, id bigint, size bigint, m double")
    up = defaultdict(int)
    for r in pivotal(frame, group_rows=8, seed=1).collect():
        up[r.id] += r.up
    mean = sum(up.values()) / 40 / 120
    assert mean == pytest.approx(0.3, abs=0.02)


def test_rows_equal_in_everything_are_dealt_into_small_groups(spark):
    rows = spark.range(20_000).selectExpr("named_struct('source', 'a') AS key", "cast(null as bigint) AS id", "10L AS size", "3.5D AS m")
    sizes = []
    folded = mixing.cut_lineage
    try:
        mixing.cut_lineage = lambda df: sizes.append(df.selectExpr("size(s.done) AS n").agg({"n": "max"}).first()[0] if "s" in df.columns else 0) or folded(df)
        out = pivotal(rows)
        up = out.where("up").count()
    finally:
        mixing.cut_lineage = folded
    assert out.count() == 20_000 and abs(up * 10 - 20_000 * 3.5) < 10
    assert max(sizes) < 2 * mixing.GROUP_ROWS


def test_a_seed_changes_the_draw(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(mixed(mix(docs, seed=1))) != sorted(mixed(mix(docs, seed=2)))


def test_edge_rows_and_empty_table(spark):
    rows = mixed(mix(edge(spark)))
    assert sorted((r.doc_id, r.source) for r in rows if r.doc_id is not None and r.source) == sorted((r[0], r[3]) for r in ROWS if r[0] is not None and r[3])
    assert len(rows) == len(ROWS) and all(r.taken <= 3 * r.size for r in rows)
    assert {r.size for r in rows if r.doc_id in (3, 5)} == {0}
    assert mix(none(spark)).count() == 0


def test_plan_has_no_python(spark, sf):
    plan = mix(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
