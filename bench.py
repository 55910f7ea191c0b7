"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the sample tables, BENCH_CPUS the cores. Every query runs to a sink that drops its rows, once to warm
up and then BENCH_RUNS times; the figure is the median. Planning and reading the table schemas are part of it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from convoy.plans.sample_queries import queries  # noqa: E402
from convoy.session import build_session  # noqa: E402

HEADLINE = (
    "delivery_trend fuel_efficiency cost_per_delivery idle_time maintenance_kpi route_performance vehicle_kpi "
    "depot_performance executive_kpis dashboard_summary fleet_status latest_position live_fleet trail_points "
    "reference_checks silver_gps"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "convoy-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    seconds = {}
    for name in wanted:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    result = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
