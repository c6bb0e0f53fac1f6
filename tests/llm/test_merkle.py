import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cadenza.llm.merkle import Tree, digest, manifest, nodes, tampered, verified

from .edge import ROWS, edge, none

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def up(level):
    return [H(*level[k : k + 2]) for k in range(0, len(level), 2)]


def way(levels, k):
    """(siblings, and a function that folds a leaf) from position k."""
    steps = []
    for level in levels[:-1]:
        steps.append((k % 2, level[k ^ 1] if k ^ 1 < len(level) else None))
        k //= 2
    return steps


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(up(levels[-1]))
    return levels


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {}
    for lang in langs:
        mine = [(r, leaf(r[0], r[3], r[2], r[4], r[1])) for r in rows if r[2] == lang]
        mine.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        groups[lang] = mine, levels_of([h for _, h in mine])
    top = levels_of([groups[lang][1][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        mine, levels = groups[lang]
        for pos, (r, h) in enumerate(mine):
            steps = way(levels, pos) + way(top, k)
            node = h
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                node = leaf(r[0], r[3], r[2], r[4] + 1, r[1])
            for right, beside in steps:
                node = H(node) if beside is None else H(beside, node) if right else H(node, beside)
            proof = H(*(s for _, s in steps if s is not None))
            out.append((r[0], h, levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def random_rows(seed, n):
    rng = random.Random(seed)
    rows = [(rng.randrange(2 * n), rng.choice(["", "a", "é漢\n", None, "text " * 50]), rng.choice(["en", "en", "en", "de", "Z", "é", None]), rng.choice(["s", None]), rng.choice([None, 5, 100])) for _ in range(n)]
    return rows + rows[:5] + [(None, "x", "en", "s", 3), (None, "x", "en", "s", 3), (None, None, None, None, None), (5, "alone", "only", "s", 1)]


def rows_of(df):
    return sorted((tuple(r) for r in verified(manifest(df, changed=tampered(df), block_bits=2)).collect()), key=str)


@pytest.mark.parametrize("n", [1, 3, 60, 300])
def test_against_brute_force(spark, n):
    rows = random_rows(n, n)
    got = rows_of(spark.createDataFrame(rows, DDL).repartition(5))
    assert got == brute(rows)
    assert n < 60 or {r[-1] for r in got} == {True, False}


def test_blocks_of_any_size_give_the_same(spark):
    df = spark.createDataFrame(random_rows(9, 200), DDL)
    one, *others = [sorted((tuple(r) for r in verified(manifest(df, changed=tampered(df), block_bits=b)).collect()), key=str) for b in (1, 3, 12)]
    assert all(o == one for o in others)


def test_versions_copy_ancestors_only_and_share_the_rest():
    leaves = [digest(bytes([k]) * 32) for k in range(11)]
    tree = Tree(leaves)
    before = [list(level) for level in tree.levels]
    changed = digest(b"x" * 32)
    copied = tree.version(6, changed)
    fresh = Tree([changed if k == 6 else n for k, n in enumerate(leaves)])
    assert tree.levels == before and len(copied) == len(tree.levels)
    for level, (old, new) in enumerate(zip(tree.levels, fresh.levels)):
        assert [k for k, (a, b) in enumerate(zip(old, new)) if a != b] == [6 >> level] and new[6 >> level] == copied[level]


def test_versions_and_stored_nodes(spark):
    rows = random_rows(4, 120)
    df = spark.createDataFrame(rows, DDL)
    found = manifest(df, changed=tampered(df), block_bits=2).collect()
    assert all((r.version is None) == (r.folded_root == r.root) or r.version[-1] == r.folded_root for r in found)
    base = {}
    for r in nodes(df, block_bits=2).collect():
        base.setdefault(r.grp, {})[r.level, r.at] = r.node
    for r in found:
        mine = base[r.grp]
        assert mine[max(mine)] == r.subroot and r.leaf in [mine[k] for k in mine if k[0] == 0]
        n = sum(level == 0 for level, _ in mine)
        for level in range(max(mine)[0] + 1):
            assert sorted(k for lv, k in mine if lv == level) == list(range(-(-n // 2**level)))


def test_edge_rows_and_empty_table(spark):
    df = edge(spark).withColumn("n_chars", F.length("text").cast("bigint"))
    got = rows_of(df)
    assert got == brute([(*r, None if r[1] is None else len(r[1])) for r in ROWS])
    assert manifest(none(spark).withColumn("n_chars", F.lit(1).cast("bigint"))).count() == 0
