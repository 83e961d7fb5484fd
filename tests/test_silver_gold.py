import datetime as dt

from pyspark.sql import functions as F

from auric.context import RunContext
from auric.operators import gold, silver
from auric.sources.fixtures import FIXTURE_CTX as CTX

TS = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
ORDER_SCHEMA = ("order_number string, customer_id string, customer_name string, "
                "order_datetime string, number_of_line_items string, "
                "ordered_products array<struct<id:string,name:string,price:string,qty:string,"
                "curr:string>>, _ingest_ts timestamp")


def _orders(spark, rows):
    return spark.createDataFrame(rows, ORDER_SCHEMA)


def line(i, price, qty):
    return (i, f"p{i}", price, qty, "USD")


def test_orders_newest_copy_wins_and_blank_ts_is_bad(spark):
    df = _orders(spark, [
        ("1", "9", " A ", "946684800", "1", [line("7", "2.5", "2")], TS),
        ("1", "9", " A ", "946598400", "1", [line("7", "9.0", "9")], TS),
        ("2", "9", "B", "", "1", [line("8", "1.0", "1")], TS),
        ("3", None, "C", "abc", None, None, TS),
    ])
    s = silver.build_silver({"sales_orders": df, **_empty_sources(spark)}, CTX)
    orders = {r.order_number: r for r in s.orders_deduped.collect()}
    assert orders["1"].order_date == dt.date(2000, 1, 1)
    q = {r.order_number: r["_dq_reason"] for r in s.orders.quarantine.collect()}
    assert q == {"2": "bad_ts", "3": "null_customer_id"}
    lines = {(r.order_number, r.product_id): r for r in s.order_line_items.clean.collect()}
    assert lines[("1", "7")].line_revenue == 5.0
    # Lines of quarantined orders still reach the line table; order 2 then
    # fails the line rule on its NULL date.
    lq = {r.order_number: r["_dq_reason"] for r in s.order_line_items.quarantine.collect()}
    assert lq == {"2": "null_date"}


def test_future_date_uses_as_of(spark):
    df = _orders(spark, [("5", "1", "X", "4102444800", "1", [line("1", "1.0", "1")], TS)])
    ctx = RunContext("b", TS, dt.date(2026, 1, 1))
    s = silver.build_silver({"sales_orders": df, **_empty_sources(spark)}, ctx)
    assert [r["_dq_reason"] for r in s.orders.quarantine.collect()] == ["future_date"]
    later = RunContext("b", TS, dt.date(2100, 1, 2))
    s2 = silver.build_silver({"sales_orders": df, **_empty_sources(spark)}, later)
    assert s2.orders.quarantine.count() == 0


def test_duplicate_product_lines_keep_highest_price_then_qty(spark):
    df = _orders(spark, [("1", "9", "A", "946684800", "3",
                          [line("7", "2.0", "1"), line("7", "3.0", "1"), line("7", "3.0", "4")],
                          TS)])
    s = silver.build_silver({"sales_orders": df, **_empty_sources(spark)}, CTX)
    rows = s.order_line_items.clean.collect()
    assert [(r.unit_price, r.quantity) for r in rows] == [(3.0, 4)]


def _empty_sources(spark):
    from auric.sources import schemas
    out = {}
    for name, schema in (("customers", schemas.CUSTOMERS_CSV), ("products", schemas.PRODUCTS_CSV),
                         ("loyalty_segments", schemas.LOYALTY_CSV)):
        out[name] = spark.createDataFrame([], schema).withColumn("_ingest_ts", F.lit(TS))
    return out


def test_loyalty_null_threshold_stays_clean_and_labels(spark):
    from auric.sources import schemas
    rows = [("0", "level_0", "0", "2017-01-01", ""), ("4", "level_4", None, "2017-01-01", None),
            ("9", "level_9", "-1", "2017-01-01", ""), ("2", " ", "30", "2017-01-01", ""),
            ("3", "level_3", "70", "2017-13-01", "")]
    df = spark.createDataFrame(rows, schemas.LOYALTY_CSV).withColumn("_ingest_ts", F.lit(TS))
    r = silver.build_silver({"loyalty_segments": df, **{k: v for k, v in _empty_sources(spark).items()
                                                        if k != "loyalty_segments"},
                             "sales_orders": _orders(spark, [])}, CTX).loyalty_segments
    clean = {x.loyalty_segment_id: x.loyalty_segment_label for x in r.clean.collect()}
    assert clean == {0: "Prospect", 4: "Platinum"}
    q = {x.loyalty_segment_id: x["_dq_reason"] for x in r.quarantine.collect()}
    assert q == {9: "negative_threshold", 2: "null_description", 3: "null_valid_from"}


def test_pii_never_leaves_bronze(lakehouse):
    for df in list(lakehouse.silver_tables().values()) + list(lakehouse.gold.tables().values()):
        assert not {"tax_id", "tax_code"} & set(df.columns)


def test_silver_keys_unique(lakehouse):
    s = lakehouse.silver
    for df, keys in ((s.customers.clean, ["customer_id"]), (s.products.clean, ["product_id"]),
                     (s.orders.clean, ["order_number"]),
                     (s.order_line_items.clean, ["order_number", "product_id"])):
        assert df.groupBy(*keys).count().filter("count > 1").count() == 0


def test_revenue_equal_across_layers(lakehouse):
    from auric.functions.scalars import money_sum
    g = lakehouse.gold
    totals = [df.agg(money_sum(c)).first()[0] for df, c in (
        (lakehouse.silver.order_line_items.clean, "line_revenue"), (g.fact_sales, "line_revenue"),
        (g.wide_sales, "line_revenue"), (g.agg_sales_monthly, "total_revenue"))]
    assert len(set(totals)) == 1 and totals[0] > 0


def test_dim_date_contiguous_and_weekend(lakehouse):
    d = lakehouse.gold.dim_date
    lo, hi, n = d.agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()
    assert (hi - lo).days + 1 == n
    sat = d.filter(F.col("date_key") == dt.date(2000, 1, 1)).first()
    assert sat.day_name == "Saturday" and sat.is_weekend and sat.day_of_week == 7
    assert sat.year_month == "2000-01" and sat.month_name == "January" and sat.quarter == 1


def test_dim_date_of_no_lines_is_empty(spark):
    empty = spark.createDataFrame([], "order_date date")
    assert gold.dim_date(empty).count() == 0


def test_sale_id_unique_and_stable(lakehouse, spark):
    f = lakehouse.gold.fact_sales
    assert f.select("sale_id").distinct().count() == f.count()
    from auric.plans.lakehouse import Lakehouse
    again = Lakehouse.from_testdata(spark, "/root/testdata/sf0.001").gold.fact_sales
    assert f.select("sale_id").exceptAll(again.select("sale_id")).count() == 0


def test_wide_has_null_customer_for_quarantined_customers(lakehouse):
    w = lakehouse.gold.wide_sales
    f = lakehouse.gold.fact_sales
    missing = f.join(lakehouse.gold.dim_customer, "customer_id", "left_anti").count()
    assert missing > 0
    assert w.filter(F.col("customer_id").isNull()).count() == missing


def test_output_schemas_follow_the_contracts(lakehouse):
    assert tuple(lakehouse.silver.customers.clean.columns) == silver.CUSTOMER_SILVER_COLUMNS
    assert tuple(lakehouse.gold.wide_sales.columns) == gold.WIDE_COLUMNS
    assert tuple(lakehouse.gold.agg_sales_monthly.columns[:6]) == gold.AGG_KEYS
