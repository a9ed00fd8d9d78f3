"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder with the tables    (default /root/testdata/sf0.1)
BENCH_CPUS     local cores               (default 8)
BENCH_RUNS     timed runs per query      (default 3; the median counts)

Lazy queries are executed whole into a no-op sink after one untimed run. Queries that
write tables are timed once, with all their writes.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from tripwright.plans.queries import QUERIES
from tripwright.session import local_session

LAZY = [
    "trips_raw",
    "raw_normalize",
    "stg_trips",
    "mart_trips_daily",
    "mart_trips_zone",
    "mart_revenue_trends",
    "zone_mode_dropoff",
    "dq_not_null",
    "dq_between",
    "dq_report",
    "raw_file_summary",
    "top_zones",
    "latest_trends",
]
STORED = ["daily_incremental", "load_month_idempotent", "stored_marts"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(
        cores,
        **{
            "spark.sql.shuffle.partitions": cores,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in LAZY:
        timed(name)
        seconds[name] = statistics.median(timed(name) for _ in range(runs))
    for name in STORED:
        seconds[name] = timed(name)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
