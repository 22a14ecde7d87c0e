"""Time the headline queries on local Spark and print one JSON line.

BENCH_SF_DIR: table folder (default /root/testdata/sf0.1); BENCH_CPUS: local cores (default 8);
BENCH_ALL=1 times every named query.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

# Named for what they measure: native and handler forms of the same work stand side by side.
HEADLINE = [
    "even_odd_daily",
    "reduce_fixed_keyed",
    "reduce_fixed_unkeyed",
    "lineitem_weekly",
    "reduce_mergeable_handler",
    "reduce_handler",
    "session_counts",
    "session_hot_keys",
    "session_mergeable_handler",
    "early_counter",
    "early_running",
    "early_sum",
    "running_counter",
    "sorted_stream",
    "late_split",
    "flat_map_documents",
    "map_stream_handler",
    "map_handler",
    "batch_map_handler",
    "sink_split",
    "side_input_asof",
    "stream_reduce",
    "stream_sessions",
    "stream_sink_routes",
]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from msgflow.session import builder, ship_package

    spark = (
        builder("msgflow-bench")
        .master(f"local[{cpus}]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)

    from msgflow.plans.catalogue import QUERIES

    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    # Start the JVM's and the Python workers' code paths before timing.
    for name in ("reduce_fixed_keyed", "map_handler"):
        QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": base.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
