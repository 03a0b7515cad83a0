"""Benchmark: headline queries, warm, median of 3 runs.

Prints one JSON line. Environment: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8), BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mortar.registry import QUERIES  # noqa: E402
from mortar.session import get_session, remove_scratch  # noqa: E402

HEADLINE = [
    "dim_customers",
    "customer_orders",
    "daily_metrics",
    "customers_enriched",
    "restaurant_metrics",
    "cuisine_metrics",
    "order_status_pivot",
]
# Stage queries timed alongside (not in the total).
EXTRA = ["open_tickets_daily", "active_subscriptions", "search_terms"]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - t0
    remove_scratch(spark)
    return took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="mortar-bench")
    times: dict[str, float] = {}
    for name in HEADLINE + EXTRA:
        run(spark, name, sf_dir)  # warm-up
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": round(sum(times[q] for q in HEADLINE), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
