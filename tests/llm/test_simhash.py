import re
from collections import defaultdict

import pytest
import xxhash

from cadenza.llm import simhash
from cadenza.llm.simhash import simhash_dedup

from .edge import ROWS, docs_of, edge, none


def brute_print(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=3):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        ids[find(k)].append(doc_id)
    least = {r: min((i for i in x if i is not None), default=None) for r, x in ids.items()}
    return sorted(((i, f"{p:016x}", least[find(k)]) for k, ((i, _), p) in enumerate(zip(rows, prints))), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_edge_rows_and_empty_table(spark):
    short = [(i, t if t is None or len(t) < 1000 else t[:380]) for i, t, *_ in ROWS]
    got = rows_of(simhash_dedup(edge(spark)))
    assert [g for g in got if g[0] != 4] == [g for g in brute(short) if g[0] != 4]
    assert simhash_dedup(none(spark)).count() == 0


@pytest.mark.parametrize("segments, tile_rows", [(2, 4096), (4, 3), (1, 5)])
def test_sample_table_in_any_tiling(spark, sf, segments, tile_rows):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(simhash_dedup(docs, segments=segments, tile_rows=tile_rows)) == want


def test_chain_and_dense_group(spark):
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words[:k] + ["changed"] + words[k + 1 :]) for k in range(0, 400, 3)] + ["one", "one two", ""]
    assert rows_of(simhash_dedup(docs_of(spark, texts), tile_rows=7)) == brute(list(enumerate(texts)))


def test_many_near_pairs_link_without_being_listed(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    base = int(rng.integers(1 << 62))
    prints = {base ^ (1 << a) ^ (1 << b) for a in range(60) for b in range(60)}
    nodes = spark.createDataFrame([(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints], "fp bigint")
    edges = simhash.links(nodes, 3).collect()
    roots = {}

    def find(x):
        while roots.get(x, x) != x:
            x = roots[x]
        return x

    for u, v in edges:
        roots[max(find(u), find(v))] = min(find(u), find(v))
    assert len({find(p) for p in prints}) == 1
    assert len(edges) < 30 * len(prints)
