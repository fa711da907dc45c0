"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
Each query runs once to warm up; the faster of two further runs counts, planning
included, until all rows and columns are produced.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from setwise.plans.catalog import QUERIES  # noqa: E402
from setwise.session import session  # noqa: E402

HEADLINE = (
    "rising_edges", "island_runs", "first_run_class", "toggle_latch", "relative_time", "phase_labels",
    "rolling_max_101", "phase_spans", "session_summary", "conditional_aggregates", "raster_columns",
    "clean_samples", "asof_hold_last", "semi_join_keys", "upsert", "change_feed", "incremental_read",
    "confusion_metrics", "world_frame", "tree_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="8g",
        # The tables are small: without this, one task would get all shuffled rows.
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    cold, warm = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        cold[name] = round(run(name), 3)
        warm[name] = round(min(run(name), run(name)), 3)
    total = round(sum(warm.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds", "value": total, "unit": "sec", "queries": warm, "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
