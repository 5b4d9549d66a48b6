"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs to completion into Spark's ``noop`` sink (every row computed,
nothing collected). Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # ingest and conform
    "parse_fixed_width", "ingest_union", "pivot_daily", "json_parallel_arrays", "dim_date",
    # quality
    "gap_analysis", "decade_completeness", "outlier_scan", "duplicate_grain", "fk_violations", "model_ready",
    # views and questions
    "daily_enriched", "monthly_summary", "rolling_climate", "record_days", "station_thresholds",
    "top_records", "longest_streak", "extreme_days",
    # EDA
    "doy_anomalies", "correlations", "annual_trend",
    # series, features, models
    "densify_daily", "features", "monthly_series", "forecast_scores", "fit_linear", "seasonal_forecast",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else sf_dir

    from stationlake.session import drop_tables, get_spark
    from stationlake.plans.registry import QUERIES

    parts = os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus.isdigit() else "8")
    spark = get_spark(cpus=cpus, shuffle_partitions=int(parts))
    # JIT, class-loading and Python-worker warm-up: one untimed pass on the smallest tables (other
    # files, so no plan, broadcast decision or data carries over to the timed runs).
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for name in HEADLINE:
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        drop_tables(spark)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
