"""Time headline queries beside their SQL in DuckDB on the same tables and cores; prints one JSON line.

A time includes planning, code generation and every stored intermediate. Two queries run before the clock. Each number
is the best of BENCH_RUNS runs (2 unless set). Key ``sql`` holds DuckDB's times; BENCH_SQL=0 leaves them out.

BENCH_SF_DIR, BENCH_CPUS: data folder and cores. BENCH_QUERIES: comma-separated names, or ``all``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from panelspark.suite import ORACLES, QUERIES  # noqa: E402

HEADLINE = [
    "wide_panel", "rate_metrics", "peer_percentiles", "specialist_percentiles", "composite_score", "quadrants",
    "quadrants_median", "group_distribution", "entity_trends", "consistency", "squad_profile", "valuation", "dim_entity",
    "metric_profile", "similar_entities", "zscore_features", "knn_vectors", "deduplicate", "pivot_counts", "unpivot_long",
    "union_relations", "null_profile", "clean_numeric", "fold_names", "slugify", "extract_links", "chk_equality",
    "chk_exclusive_ranges", "chk_relationships", "chk_sequential_values", "chk_unique_combination", "check_report",
]


def seconds_of(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    scratch = tempfile.mkdtemp(prefix="panelspark-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("panelspark-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "12g")
             .config("spark.checkpoint.dir", scratch)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    for warm in ("rate_metrics", "pivot_counts"):
        QUERIES[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()

    runs = range(int(os.environ.get("BENCH_RUNS", "2")))
    seconds, sql_seconds = {}, {}
    for name in names:
        seconds[name] = min(
            seconds_of(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()) for _ in runs)
    if os.environ.get("BENCH_SQL", "1") != "0":
        from tests.oracle import connect
        connection = connect(sf_dir)
        connection.execute(f"SET threads TO {cpus}")
        for name in names:
            if name in ORACLES:
                sql_seconds[name] = min(seconds_of(
                    lambda: connection.execute(f"CREATE OR REPLACE TEMP TABLE bench_out AS {ORACLES[name]}")) for _ in runs)
    spark.stop()
    out = {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
           "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}
    if sql_seconds:
        out["sql"] = sql_seconds
    print(json.dumps(out))


if __name__ == "__main__":
    main()
