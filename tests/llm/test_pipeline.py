import os
import subprocess
import sys
import uuid

import duckdb
import pytest

import corpus_pipeline as cp
from cadenza.llm import queries
from cadenza.llm.exact_dedup import exact_dedup

from .edge import ROWS, edge, none
from .test_decontaminate import brute as brute_contamination
from .test_exact_dedup import norm
from .test_simhash import brute as brute_simhash

SMALL = "/root/testdata/sf0.001"


def written(spark, df, path):
    path = f"{path}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(cp.STAGES)
    assert list(stages) == ["quality classifier", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights"]

    first = written(spark, stages["quality classifier"](spark, docs, SMALL), tmp_path)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {r.doc_id for r in first.collect()}
    assert sum(labels[i] == 1 for i in labels if i in kept) >= 0.95 * sum(q == 1 for q in labels.values())
    assert sum(labels[i] == 0 for i in labels if i in kept) <= 0.2 * sum(q == 0 for q in labels.values())

    rows = sorted((r.doc_id, r.text) for r in first.collect())
    second = written(spark, stages["exact dedup"](spark, first, SMALL), tmp_path)
    seen = {}
    for doc_id, text in rows:
        seen.setdefault(norm(text), (doc_id, text))
    rows = sorted(seen.values())
    assert sorted((r.doc_id, r.text) for r in second.collect()) == rows

    third = written(spark, stages["SimHash near-dedup"](spark, second, SMALL), tmp_path)
    stays = {i for i, _, least in brute_simhash(rows) if i == least}
    rows = [r for r in rows if r[0] in stays]
    assert sorted((r.doc_id, r.text) for r in third.collect()) == rows

    fourth = written(spark, stages["benchmark decontamination"](spark, third, SMALL), tmp_path)
    bad = {w[0] for w in brute_contamination(rows, items) if w[5]}
    rows = [r for r in rows if r[0] not in bad]
    assert bad and sorted((r.doc_id, r.text) for r in fourth.collect()) == rows
    assert fourth.schema == docs.schema

    last = stages["mixing sources to target weights"](spark, fourth, SMALL).collect()
    assert {r.doc_id for r in last} <= {i for i, _ in rows}
    assert all(1 <= r.copies <= 3 and r.taken == r.copies * len(r.text.split()) for r in last)


def test_stages_take_edge_rows_and_empty_tables(spark, tmp_path):
    for k, (name, stage) in enumerate(cp.STAGES):
        for table, most in ((edge(spark), len(ROWS)), (none(spark), 0)):
            out = stage(spark, table, SMALL)
            assert out.count() <= most
            if k < 4:
                assert out.schema.names == table.schema.names
    exact = dict(cp.STAGES)["exact dedup"](spark, edge(spark), SMALL)
    assert exact.count() == exact_dedup(edge(spark)).select("text_sha256").distinct().count()
    assert exact.where("kept = 'KEPT'").count() == exact.count()


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    cursor = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(cursor.fetchall())


def test_the_rest_imports_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import shutil

    shutil.copytree(f"{root}/cadenza", tmp_path / "cadenza", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; n = e.queries(); assert 'pipeline' not in n and len(n) > 70; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
