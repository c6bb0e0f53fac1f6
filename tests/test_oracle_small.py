"""Every registered query with an oracle, Spark vs DuckDB on the sf0.001 tables (multiset of rows)."""

import math
import tempfile
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
SQL = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return "NULL" if v is None else str(v)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


SONGS = ("h4_serve_batch", "h11_serve_stream")  # about 600 rounds on the whole table, so their table is smaller here


@pytest.fixture(scope="module")
def few_requests(spark, sf):
    """The sample tables with sixteen requests, for sections of 3 to 29 tokens."""
    folder = tempfile.mkdtemp()
    spark.read.parquet(f"{sf}/documents.parquet").write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{sf}/events.parquet").where("event_id between 200 and 215").coalesce(1).write.parquet(f"{folder}/events.parquet")
    c = duckdb.connect()
    for t in ("documents", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    return folder, c


@pytest.mark.parametrize("name", SONGS)
def test_songs_match_oracle(spark, few_requests, name):
    folder, con = few_requests
    compare(E.queries()[name](spark, folder), con, name)


@pytest.mark.parametrize("name", sorted(set(SQL) - set(SONGS)))
def test_query_matches_oracle(spark, sf, con, name):
    compare(E.queries()[name](spark, sf), con, name)


def compare(df, con, name):
    cols = df.columns
    srows = df.collect()
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    so = sorted(range(len(cols)), key=lambda i: cols[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = Counter(tuple(_norm(r[i]) for i in so) for r in srows)
    b = Counter(tuple(_norm(r[i]) for i in do) for r in drows)
    assert a == b, (len(srows), len(drows))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "sent_no", "sentence"]
    assert df.count() > 0
