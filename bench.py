"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

A time covers everything a user waits for: building the plan, jobs that store an intermediate table, and
producing every row of the result. Each query runs once to warm up, then ``$BENCH_RUNS`` times; the
median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from areascore.catalog import QUERIES
from areascore.session import build_session

HEADLINES = (
    "silver_referential",
    "silver_facilities",
    "gold_environment",
    "gold_social",
    "gold_governance",
    "gold_area_final",
    "gold_basin_final",
    "q_suite",
    "b6_key_indicators",
    "audit_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            # The test tables are small enough to be merged into one partition; keep the cores busy.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    times = {}
    for name in sys.argv[1:] or HEADLINES:
        seconds(name)
        times[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
        print(name, times[name], file=sys.stderr)
    spark.stop()
    scale = sf_dir.rstrip("/").rsplit("/sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
