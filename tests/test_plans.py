"""Plan-shape guards for the properties the design relies on at scale."""

import re

from pyspark.sql import functions as F

from auric.operators.dedup import keep_latest


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_rows_per_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    p = plan(keep_latest(df, ["k"], ["ts"]))
    # WindowGroupLimit appears on both sides of the exchange (partial + final).
    assert p.count("WindowGroupLimit") >= 2
    assert p.index("Exchange") < p.rindex("WindowGroupLimit")


def test_hot_key_dedup_is_exact(spark):
    hot = spark.range(30000).select(F.lit(1).alias("k"), F.col("id").alias("ts"))
    cold = spark.range(60000).select((F.col("id") + 2).alias("k"), F.col("id").alias("ts"))
    out = keep_latest(hot.unionByName(cold).repartition(16), ["k"], ["ts"])
    assert out.count() == 60001
    assert out.filter("k = 1").first().ts == 29999


def test_line_dedup_adds_no_shuffle_to_stored_orders(spark, scratch, lakehouse):
    from auric.operators.silver import explode_line_items
    path = f"{scratch}/stored_orders"
    lakehouse.silver.orders_deduped.write.mode("overwrite").parquet(path)
    lines = explode_line_items(spark.read.parquet(path))
    assert not any(x in plan(lines) for x in ("Exchange", "Window", "Sort "))
    assert lines.count() == lakehouse.silver.order_line_items.tagged.count()


def test_counts_of_orders_and_customers_need_no_expand(lakehouse):
    from auric.plans import metrics as M
    from auric.plans import reports as R
    w = lakehouse.gold.wide_sales
    for df in (R.headline_kpis(w), R.kpi_mom_exact(w), M.metric_query(w, ["orders", "customers"], ["state"])):
        assert "Expand" not in plan(df)


def test_best_state_reads_the_lines_once(spark, scratch, lakehouse):
    from auric.plans.metrics import best_state_then_category
    path = f"{scratch}/wide_once"
    lakehouse.gold.wide_sales.write.mode("overwrite").parquet(path)
    assert plan(best_state_then_category(spark.read.parquet(path))).count("FileScan") == 1


def test_monthly_cube_has_no_expand(lakehouse):
    assert "Expand" not in plan(lakehouse.gold.agg_sales_monthly)


def test_bounded_dimensions_are_broadcast(lakehouse):
    p = plan(lakehouse.gold.wide_sales)
    assert p.count("BroadcastHashJoin") >= 2


def test_period_metric_prunes_month_partitions(spark, scratch, lakehouse):
    from auric.plans.metrics import top_products_last_quarter
    path = f"{scratch}/wide_by_month"
    lakehouse.gold.wide_sales.write.partitionBy("year_month").mode("overwrite").parquet(path)
    df = top_products_last_quarter(spark.read.parquet(path), lakehouse.gold.dim_date)
    p = plan(df)
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", p)
    assert any("year_month" in f for f in filters)
    assert df.count() == 10
