"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and, when one exists,
an equivalent DuckDB SQL over the driver's tables (used as the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a Spark query under ``name``; ``sql`` is its DuckDB oracle (None: rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every plan module so that its queries register themselves."""
    from . import corpus, model, requests, sources, songs, streams, training, vectors  # noqa: F401
