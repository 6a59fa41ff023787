"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local
cores (default 8). Each query runs twice to warm up and then three times, of which
the best counts. Results go to Spark's no-op sink, so every row is computed and none
collected.
"""

from __future__ import annotations

import json
import os
import time

from tradewind import local_session
from tradewind.queries import REGISTRY

HEADLINE = [
    "a3_daily_regional_revenue",
    "a9_segment_revenue",
    "q5_order_outcomes",
    "q5_item_outcomes",
    "a2_daily_revenue",
    "a4_daily_revenue_by_category",
    "a8b_distinct_orders_by_region",
    "j4_star_join",
    "w1_latest_customer",
    "w5_dedup_items",
    "a13e_profile_top_values",
    "a14_histogram",
    "a18_item_defects",
    "s15_change_feed",
]


def measure(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in HEADLINE:
        runs = [measure(spark, name, sf_dir) for _ in range(5)]
        times[name] = round(min(runs[2:]), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
