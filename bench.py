"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES (optional) a
comma-separated choice. Each query is run once to warm up and then BENCH_RUNS times (default 3) to
the end of its plan without collecting rows; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallymart import build_session  # noqa: E402
from tallymart.plans.catalogue import QUERIES  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "contact_rollup outcome_pivot episode_fact kpi_quarterly kpi_scorecard service_reach clean_indicator "
    "clean_indicator_ages clean_dedup scope_release profile_release indicator_trend_band indicator_trend_category "
    "benchmark_unit condition_gaps area_pivot area_trend area_hotspots order_rank peer_comparison criteria_check "
    "q_contact_window q_first_contact q_unique_combo q_drift q_report"
).split()


def main() -> None:
    chosen = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or HEADLINE
    spark = build_session(
        "tallymart-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__log__level="OFF",
    )
    seconds = {}
    for name in chosen:
        runs = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of median times",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
