"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs one warm-up of the flagship query, then each headline query ``BENCH_RUNS`` times
(default 3) and reports the median wall time per query. Every query is executed in full
with the ``noop`` sink (all stages run, nothing is collected to the driver). Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from screenroi.plans.catalog import QUERIES  # noqa: E402
from screenroi.session import local_session  # noqa: E402

HEADLINE = [
    "clean_watch_history",
    "clean_licensing",
    "review_sentiment",
    "usage_by_title_region_year",
    "license_pick",
    "content_performance",
    "fact_load",
    "content_performance_mart",
    "dq_report",
    "play_events_usage",
    "stream_daily_usage",
    "stream_usage_refresh",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(
        cpus,
        shuffle_partitions=2 * cpus,
        app="screenroi-bench",
        # spark.checkpoint.dir comes from the environment when it names one; otherwise the
        # library falls back to a folder below this run's warehouse dir.
        extra={"spark.sql.warehouse.dir": f"{scratch}/warehouse", "spark.driver.memory": "16g"},
    )
    run_once(spark, "content_performance", sf_dir)  # warm-up (JIT, file listing caches)
    per_query = {}
    for name in names:
        times = [run_once(spark, name, sf_dir) for _ in range(runs)]
        per_query[name] = round(statistics.median(times), 3)
    total = round(sum(per_query.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_median_sec",
        "value": total,
        "unit": "sec",
        "queries": per_query,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "shuffle_partitions": 2 * cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
