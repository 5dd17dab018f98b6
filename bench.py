"""Time headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the best time
counts. Results are written to Spark's no-op sink, so every row and column is
computed and nothing reaches the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "daily_trends",
    "kpi_month_to_date",
    "cohort_retention",
    "top_categories",
    "category_trends",
    "stg_orders",
    "dim_customers",
    "dim_sellers",
    "fct_orders",
    "fct_daily_metrics",
    "fct_product_performance",
    "fct_seller_performance",
    "funnel_overall",
    "sessionize_by_gap",
    "event_transitions",
    "session_metrics",
    "live_kpis",
    "window_metrics",
    "delivery_alerts",
    "unified_orders_stream_wins",
    "batch_stream_reconciliation",
    "standard_checks",
    "anomaly_scan",
    "fct_experiment_results",
    "experiment_frame",
    "descriptives",
    "mann_whitney_revenue",
    "experiment_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE

    from agorakit.plans import registry
    from agorakit.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory="16g")
    registry.load_all()
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        first[name] = round(taken[0], 3)
        times[name] = round(min(taken[1:]), 3)
        print(f"{name}: first {first[name]} best {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
