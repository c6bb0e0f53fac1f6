import math
import random
import re

import numpy as np
import pytest

from cadenza.llm.lexical import Shard, search, term_counts

from .edge import ROWS, edge, none


def terms(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=50):
    """docs and items: (id, text); the contract word by word."""
    lists = [(d, terms(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in lists), sum(len(w) for _, w in lists)
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(terms(text))
    df = {t: sum(t in w for _, w in lists) for t in set().union(*wanted.values())}
    out = []
    for item, words in wanted.items():
        found = []
        for d, w in lists:
            if w:
                m = 100 - 50 + (50 * len(w) * n_docs) // n_terms
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * w.count(t)) // (1000 * w.count(t) + 20 * m))
                            for t in words if t in w)
                if score > 0:
                    found.append((-score, d is None, d or 0))
        out += [(item, r + 1, None if last else d, -s) for r, (s, last, d) in enumerate(sorted(found)[:k])]
    return sorted(out)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


def case(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(150)] + ["é", "漢字", "Ab9"]
    weights = [1 / (k + 1) for k in range(len(words))]

    def text(n):
        return rng.choice([" ", ", ", "-", "\n"]).join(rng.choices(words, weights, k=n))

    docs = [(k, text(rng.choice([0, 1, 3, 20, 20, 200]))) for k in range(n)]
    docs += [(7, docs[3][1]), (7, docs[3][1]), (None, docs[5][1]), (None, docs[5][1]), (900, None), (901, " .,")] + [(1000 + k, "w1 w2 w3 w4") for k in range(80)]
    items = [(k, text(rng.choice([1, 2, 8, 30]))) for k in range(25)] + [(3, "w9 w10"), (50, None), (51, " - "), (52, "nowhere"), (None, "w1")]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"shard_postings": 300, "block_docs": 2}, {"shard_postings": 2000, "block_docs": 8, "block_terms": 40, "k": 5}])
def test_against_brute_force(spark, sizes):
    docs, items = case(1)
    got = sorted(tuple(r) for r in search(*frames(spark, docs, items), **sizes).select("item_id", "rank", "doc_id", "score").collect())
    assert got == brute(docs, items, sizes.get("k", 50))


def shard_of(docs, block_docs):
    vocabulary, rows = {}, []
    for d, t in docs:
        counts = term_counts((t or "").encode())
        known = sorted((vocabulary.setdefault(w, len(vocabulary)), c) for w, c in counts.items())
        if known:
            rows.append((d, counts.total(), np.array([k for k, _ in known]), np.array([c for _, c in known])))
    rng = np.random.default_rng(3)
    return Shard(*zip(*rows), rng.integers(100, 9000, len(vocabulary)), len(rows), sum(r[1] for r in rows), block_docs), vocabulary


def test_summaries_are_the_largest_impacts_and_blocks_hold_every_posting():
    docs = [d for d in case(2)[0] if d[0] is not None]
    shard, vocabulary = shard_of(docs, 4)
    for term in range(len(vocabulary)):
        members, starts, heads, s_terms, s_most = shard.blocks_of(term)
        assert sorted(members.tolist()) == sorted(shard.postings[shard.bounds[term] : shard.bounds[term + 1]].tolist())
        for b, (first, last) in enumerate(zip(starts, [*starts[1:], len(members)])):
            most = {}
            for d in members[first:last]:
                for p in range(shard.starts[d], shard.ends[d]):
                    t = int(shard.terms[p])
                    most[t] = max(most.get(t, 0), int(shard.parts[p]))
            span = slice(heads[b], heads[b + 1] if b + 1 < len(heads) else None)
            assert dict(zip(s_terms[span].tolist(), s_most[span].tolist())) == most


def test_blocks_are_skipped():
    """Rare terms settle the best documents; most blocks of a frequent term then cannot reach them."""
    rng = random.Random(4)
    docs = [(k, " ".join(["the"] + [f"{'ab'[k % 2]}{rng.randrange(40)}" for _ in range(12)] + (["rare"] * 3 if k < 8 else []))) for k in range(4000)]
    shard, vocabulary = shard_of(docs, 16)
    shard.weights[:] = 50
    shard.weights[vocabulary[b"rare"]] = 9000
    shard.most = np.array([int((shard.parts * (shard.terms == t)).max()) for t in range(len(vocabulary))]) * shard.weights
    seen = []
    better = Shard._better
    try:
        Shard._better = lambda self, best, new, weights, k: seen.append(len(new)) or better(self, best, new, weights, k)
        shard.search(np.array([vocabulary[b"rare"], vocabulary[b"the"]]), (np.empty(0, np.int64), np.empty(0, np.int64)), 5)
    finally:
        Shard._better = better
    assert sum(seen) < 400


def test_edge_rows_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "House of the RISING sun"), (2, "漢字"), (3, None)], "item_id bigint, text string")
    got = sorted(tuple(r) for r in search(edge(spark), items).collect())
    assert got == brute([r[:2] for r in ROWS], [(1, "House of the RISING sun"), (2, "漢字")])
    assert search(none(spark), items).count() == 0 and search(edge(spark), items.limit(0)).count() == 0
