import hashlib
import random
import re

from cadenza.llm.decontaminate import decontaminate, report

from .edge import ROWS, edge, none


def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, slop=0):
    out = []
    for doc_id, text in docs:
        w, hit, found, near = words(text), set(), set(), set()
        for item, phrase in items:
            p = words(phrase)
            if not p or item is None:
                continue
            n = min(13, len(p))
            for k in range(len(p) - n + 1):
                window = p[k : k + n]
                for s in range(-slop, len(w)):
                    if w[max(s, 0) : s + n] == window and s >= 0:
                        hit |= set(range(s, s + n))
                        found.add(item)
                    if slop and all(window[o] in w[max(0, s + o - slop) : max(0, s + o + slop + 1)] for o in range(n)):
                        near.add(item)
        ids = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w), tuple(sorted(near | found))))
    return sorted(out, key=str)


def rows_of(found):
    near = sorted(((r.doc_id, tuple(r.near_items)) for r in found.collect()), key=str)
    return sorted((tuple(r) for r in report(found).collect()), key=str), near


def check(spark, docs, items, slop=0, **sizes):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got, near = rows_of(decontaminate(frame, bench, slop=slop, **sizes))
    want = brute(docs, items, slop)
    assert got == sorted((w[:6] for w in want), key=str)
    assert near == sorted(((w[0], w[6]) for w in want), key=str)


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = [f"t{k}" for k in range(12)] + ["é", "Ab"]

    def text(n):
        return rng.choice([" ", ", ", "-"]).join(rng.choice(vocabulary) for _ in range(n))

    items = [(k, text(rng.choice([1, 3, 12, 13, 14, 40]))) for k in range(20)] + [(3, text(15)), (90, None), (91, " .,"), (None, "t1")]
    docs = []
    for k in range(60):
        parts = [text(rng.randrange(30))]
        if k % 2:
            item = words(items[rng.randrange(20)][1])
            at = rng.randrange(max(1, len(item) - 12))
            parts.append(" ".join(item[at : at + rng.choice([12, 13, 20])]))
        docs.append((k, " ".join([*parts, text(5)])))
    return docs, items


def test_against_brute_force(spark):
    check(spark, *random_case(1))


def test_blocks_of_the_benchmark_and_small_shards(spark):
    check(spark, *random_case(2), block_words=60, shard_tokens=40)


def test_proximity(spark):
    docs = [(1, "a x b c d"), (2, "a b c d"), (3, "d c b a"), (4, "a b"), (5, "c a b d"), (6, None)]
    check(spark, docs, [(7, "a b c d"), (8, "b a")], slop=1)


def test_a_long_item_is_searched_in_overlapping_pieces(spark):
    item = [f"i{k}" for k in range(9000)]
    docs = [(1, " ".join(item[8185:8198])), (2, " ".join(item[8192:8205])), (3, " ".join(item[8180:8192])), (4, " ".join(item[8987:]))]
    got = {r.doc_id: r.n_hit for r in report(decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string"))).collect()}
    assert got == {1: 13, 2: 13, 3: 0, 4: 13}


def test_edge_rows_and_empty_tables(spark):
    items = [(1, "house of the rising sun"), (2, ""), (3, "brown of and the fox the quick onthe brown of and the fox")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((tuple(r) for r in report(decontaminate(edge(spark), bench)).collect()), key=str)
    want = [w[:6] for w in brute([r[:2] for r in ROWS if r[0] != 4], items)]
    assert [g for g in got if g[0] != 4] == sorted(want, key=str)
    assert [g for g in got if g[0] == 4][0][2] == 8 * 30_000 - 3  # all but the first three words
    assert decontaminate(none(spark), bench).count() == 0
    assert {r.n_hit for r in report(decontaminate(edge(spark), bench.limit(0))).collect()} == {0}
