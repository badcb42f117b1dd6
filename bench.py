"""Benchmark of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed runs
after one warm-up (the median counts). Results are forced with the ``noop`` writer.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from airgrain.checks.queries import QUERIES  # noqa: E402
from airgrain.session import local_session  # noqa: E402

HEADLINE = (
    "aqi_daily", "daily_mean_first", "interpolate_linear", "clean_weather_rows", "training_rows",
    "metrics_persistence", "refresh_average_recency", "lags_segmented", "upsert_forecast",
    "browse_range", "current_conditions",
)


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(QUERIES[name], spark, sf_dir)
        seconds[name] = round(statistics.median(run(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
