import hashlib
import re
from collections import defaultdict

import pytest

from cadenza.llm.exact_dedup import ContentTable, exact_dedup

from .edge import ROWS, docs_of, edge, none


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[norm(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        least = min(known) if known else None
        kept = False
        for i in sorted(ids, key=lambda x: (x is None, x or 0)):
            stays = i == least and not kept
            kept |= stays
            out.append((i, least, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def test_edge_rows_and_empty_table(spark):
    assert rows_of(exact_dedup(edge(spark))) == brute([r[:2] for r in ROWS])
    assert exact_dedup(none(spark)).count() == 0


def test_buckets_are_split_until_they_fit(spark):
    texts = [f"text {k % 37} " + "x" * (k % 5) for k in range(600)]
    got = rows_of(exact_dedup(docs_of(spark, texts), bucket_bytes=900, fill_bytes=1 << 20, local_bytes=500, step_bits=2))
    assert got == brute(list(enumerate(texts)))


def test_a_hot_copy_group(spark):
    texts = ["the same  text"] * 500 + ["the same text"] * 500 + [f"own {k}" for k in range(500)]
    got = exact_dedup(docs_of(spark, texts).repartition(7), local_bytes=300)
    assert rows_of(got) == brute(list(enumerate(texts)))


def test_table_compares_the_whole_content():
    table = ContentTable(2)
    same_slot = [(bytes([k]) + b"12345678", str(k).encode()) for k in range(20)]
    assert [table.add(*x) for x in same_slot] == [(k, True) for k in range(20)]
    assert [table.add(*x) for x in same_slot] == [(k, False) for k in range(20)]
    with pytest.raises(ValueError):
        table.add(same_slot[3][0], b"other content")


def test_sample_table_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert rows_of(exact_dedup(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
