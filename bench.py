"""Benchmark: the batch job and the dashboard queries at one scale factor.

Prints one JSON line:
  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

* ``pipeline``: read the four sources from CSV and JSON files (written from the
  driver tables beforehand, not timed), land bronze, write silver (staged DQ
  split, quarantine, DQ trend) and gold (dims, fact, monthly aggregate, wide
  table) as parquet tables. The reference's job does the same three stages.
* one entry per dashboard / report query and three metric-layer questions,
  run on the written gold tables (what a dashboard does), timed to a full
  ``collect``: the median of three runs.
* ``e2e_top_products``: the flagship query planned from the raw tables.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="auric-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]")
             .appName("auric-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "4g"))
             .config("spark.sql.shuffle.partitions", str(max(cpus, 4)))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
             .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from auric.plans import metrics as M
    from auric.plans import reports as R
    from auric.plans.catalog import QUERIES
    from auric.plans.pipeline import Layout, gold_tables, land_files, run_gold, run_silver
    from auric.sources.fixtures import FIXTURE_CTX, source_files

    timings: dict[str, float] = {}

    def timed(name, fn, runs=1):
        took = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            took.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(took), 3)

    layout = Layout()
    paths = source_files(spark, sf_dir, os.path.join(scratch, "sources"))

    def pipeline():
        land_files(spark, paths, FIXTURE_CTX, layout)
        run_silver(spark, FIXTURE_CTX, layout)
        run_gold(spark, layout)

    timed("pipeline", pipeline)
    g = gold_tables(spark, layout)
    agg, wide = g["agg_sales_monthly"], g["wide_sales"]
    reports = {
        "kpi_mom": lambda: R.kpi_mom(agg),
        "trend_by_segment": lambda: R.trend_by_segment(agg),
        "top_states": lambda: R.top_states(agg),
        "top_products": lambda: R.top_products(wide),
        "category_segment": lambda: R.category_segment(agg),
        "top_customers": lambda: R.top_customers(wide),
        "weekday_split": lambda: R.weekday_split(wide),
        "headline_kpis": lambda: R.headline_kpis(wide),
        "top_states_exact": lambda: R.top_states_exact(wide),
        "revenue_by_segment": lambda: R.revenue_by_segment(wide),
        "dash_kpi": lambda: R.dash_kpi(agg, [1997, 1999], [1, 2, 3, 4, 5, 6]),
        "dash_trend": lambda: R.dash_trend(agg),
        "dash_heatmap": lambda: R.dash_heatmap(agg),
        "loyalty_performance": lambda: R.loyalty_performance(
            g["fact_sales"], g["dim_customer"], g["dim_loyalty_segment"]),
        "metric_top_products_last_quarter": lambda: M.top_products_last_quarter(wide, g["dim_date"]),
        "metric_month_compare": lambda: M.latest_month_vs_previous(wide, g["dim_date"]),
        "metric_platinum_state_category": lambda: M.best_state_then_category(wide),
    }
    for name, build in reports.items():
        timed(name, lambda b=build: b().collect(), runs=3)
    timed("e2e_top_products", lambda: QUERIES["top_products"](spark, sf_dir).collect())

    sf_match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf_match.group(1)) if sf_match else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
