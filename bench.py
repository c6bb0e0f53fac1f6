"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list to
override the default set).  Every query runs to completion through a no-op sink (all rows computed,
nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "c15_clean_corpus",
    "d2_ordered_split",
    "d3_encode",
    "e1_fit_ngrams",
    "e2_perplexity",
    "e3_next_token_dist",
    "f4_initial_prompt",
    "g6_assemble",
    "h2_validate",
    "h5_random_prompt",
    "h7_daily_quota",
    "i1_quantise",
    "e5_generate_section",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cadenza-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from cadenza.plans.registry import QUERIES, load_all
    from cadenza.session import prepare

    prepare(spark)
    load_all()
    # Warm the JVM once (class loading, codegen caches) on the smallest input; not timed.
    QUERIES["c15_clean_corpus"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t0, 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    rates = {}
    if "c15_clean_corpus" in timings:
        rates["c15_chars_per_sec"] = round(chars / timings["c15_clean_corpus"], 1)
    if "h7_daily_quota" in timings:
        rates["h7_rows_per_sec"] = round(events / timings["h7_daily_quota"], 1)
    if "e5_generate_section" in timings:
        from cadenza.plans.model import GEN_BUDGET

        rates["e5_tokens_per_sec"] = round(docs.count() * GEN_BUDGET / timings["e5_generate_section"], 1)
        rates["e5_tokens_per_section"] = GEN_BUDGET
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "rates": rates,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
