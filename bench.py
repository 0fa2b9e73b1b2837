"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder and BENCH_CPUS the number of threads. Two queries warm the
session up, then each query runs BENCH_RUNS times and the median counts. Results go to a sink that
computes every row.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tripmill.plans.queries import QUERIES  # noqa: E402
from tripmill.session import build_session  # noqa: E402

HEADLINE = (
    "silver_rides", "dedup_first_rownum", "dedup_first_minby", "hourly_metrics", "driver_metrics",
    "driver_metrics_nodistinct", "passenger_metrics", "passenger_metrics_nodistinct",
    "rides_summary", "recent_summary_topk", "fact_trip", "fact_driver_daily", "platform_daily",
    "dim_driver_scd2", "scd2_lookup", "fact_rides_star", "flatten_payload", "event_id_check",
    "fare_audit_service", "distance_audit", "surge_by_cell", "lifecycle_violations",
    "rides_current", "dq_summary", "reconcile", "window_5min_metrics", "window_5min_stream",
    "stream_dedup", "stream_rides_current", "landing", "ride_state_upsert", "ride_delete", "event_history",
    "id_difference", "unseen_events",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            # Small tables on one machine: keep enough partitions for every thread.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
            "spark.ui.enabled": "false",
            # A folder of its own for what queries store; a cluster names a shared one.
            "spark.checkpoint.dir": os.environ.get("BENCH_WORK_DIR", tempfile.mkdtemp(prefix="bench-")),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in ("driver_metrics", "window_5min_metrics"):
        once(name)
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
