import os

from pyspark.sql import functions as F

from auric.sources.fixtures import bronze_sales_orders
from auric.sources.schemas import AUDIT_COLUMNS, SALES_ORDERS_JSON
from auric.streaming.ingest import land_available


def test_stream_lands_each_file_once(spark, scratch):
    src = os.path.join(scratch, "stream_orders")
    docs = bronze_sales_orders(spark, "/root/testdata/sf0.001").drop(*AUDIT_COLUMNS) \
        .filter("try_cast(order_number as long) is not null")
    first = docs.filter(F.col("order_number").try_cast("long") < 700)
    second = docs.filter(F.col("order_number").try_cast("long") >= 700)
    first.coalesce(2).write.json(os.path.join(src, "part1"))
    os.makedirs(os.path.join(src, "all"))

    def move(part):
        for f in os.listdir(os.path.join(src, part)):
            if f.endswith(".json"):
                os.link(os.path.join(src, part, f), os.path.join(src, "all", f"{part}-{f}"))

    move("part1")
    table = "default.stream_orders_raw"
    t = land_available(spark, os.path.join(src, "all"), SALES_ORDERS_JSON, table)
    assert t.count() == first.count()
    # Re-running with no new file lands nothing new.
    assert land_available(spark, os.path.join(src, "all"), SALES_ORDERS_JSON, table).count() \
        == first.count()
    second.coalesce(2).write.json(os.path.join(src, "part2"))
    move("part2")
    t = land_available(spark, os.path.join(src, "all"), SALES_ORDERS_JSON, table)
    assert t.count() == docs.count()
    assert set(AUDIT_COLUMNS) <= set(t.columns)
    assert t.filter(F.col("_source_file").isNull()).count() == 0


def test_stream_lands_csv_source(spark, scratch):
    from auric.sources.fixtures import bronze_customers
    from auric.sources.schemas import CUSTOMERS_CSV
    src = os.path.join(scratch, "stream_customers")
    rows = bronze_customers(spark, "/root/testdata/sf0.001").drop(*AUDIT_COLUMNS)
    rows.select(*CUSTOMERS_CSV.fieldNames()).coalesce(3).write.csv(src, header=True)
    t = land_available(spark, src, CUSTOMERS_CSV, "default.stream_customers_raw",
                       fmt="csv", header="true")
    assert t.count() == rows.count()
    assert t.filter(F.col("_source_file").endswith(".csv")).count() == rows.count()
