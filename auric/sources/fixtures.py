"""Raw sources derived from the driver's parquet tables, for tests and checks.

The driver tables are clean TPC-H-like relations; the pipeline expects the
four raw retail sources (customers CSV, products CSV, loyalty CSV, nested
sales-order JSON) with their dirt. Each derived column is a deterministic
function of the row's key, so the same rows can be rebuilt in SQL by an
independent engine (see ``auric.oracle``). The result is the bronze layer:
source columns as text plus the audit columns.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auric.context import RunContext
from auric.sources.schemas import CORRUPT, RAW, SALES_ORDERS_JSON

FIXTURE_CTX = RunContext(
    batch_id="fixture-batch",
    run_ts=datetime(2026, 1, 1, tzinfo=timezone.utc),
    as_of=date(2026, 1, 1),
)

# --- Fixed values of the fixture design --------------------------------------
# Market segment -> loyalty tier id (alphabetical order of the segments).
SEGMENT_TIER = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3, "MACHINERY": 4}
# Source timestamps: customers become valid from this unix second plus one hour per key.
VALID_FROM_BASE = 1483228800
# valid_to values: one earlier than every valid_from, one in scientific notation.
VALID_TO_EARLY = "1.4E9"
VALID_TO_LATE = "1.648137353E9"
# a valid_to in milliseconds, which is no valid date
VALID_TO_MILLIS = "1648137353000"
# order time of the documents dated after every as-of day
FUTURE_SECONDS = "4102444800"
LOYALTY_VALID_FROM = "2017-01-01"
CURRENCY = "USD"
# -----------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _audit(df: DataFrame, ts: datetime, source: str, ctx: RunContext) -> DataFrame:
    return (df.withColumn("_ingest_ts", F.lit(ts))
              .withColumn("_source_file", F.lit(source))
              .withColumn("_batch_id", F.lit(ctx.batch_id)))


def _s(c: Column) -> Column:
    return c.cast("string")


def _tier(segment: Column) -> Column:
    out = None
    for name, tier in SEGMENT_TIER.items():
        out = (F.when(segment == name, F.lit(tier)) if out is None
               else out.when(segment == name, F.lit(tier)))
    return out


def _copies(key: Column, every: int) -> Column:
    """Copy numbers of a source row: 0 for the current copy, plus 1 for an
    older copy of every ``every``-th key. Exploding this yields both copies
    from one pass over the table."""
    return F.explode(F.when(key % every == 0, F.array(F.lit(0), F.lit(1)))
                      .otherwise(F.array(F.lit(0)))).alias("_copy")


def _ingest_ts(ctx: RunContext) -> Column:
    """Current copies land at the run time, older copies one day earlier."""
    return (F.when(F.col("_copy") == 0, F.lit(ctx.run_ts))
             .otherwise(F.lit(ctx.run_ts - timedelta(days=1))).alias("_ingest_ts"))


def _customer_row(c: DataFrame, ctx: RunContext) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    letters = F.lit("abcde")
    city = (F.when(F.col("_copy") == 0, F.concat(F.lit("City "), _s(n)))
             .otherwise(F.lit("Old City")))
    return c.select("*", _copies(k, 25)).select(
        F.when(k == 88, F.lit(None).cast("string")).otherwise(_s(k)).alias("customer_id"),
        F.concat(F.lit("T"), _s(k)).alias("tax_id"),
        _s(k % 7).alias("tax_code"),
        F.when(k % 97 == 5, F.lit(None).cast("string"))
         .when(k % 20 == 7, F.col("c_name"))
         .otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(",  "),
                             F.col("c_name"), F.lit(" "))).alias("customer_name"),
        F.when(k % 50 == 11, F.lit("XXX"))
         .otherwise(F.concat(F.lit(" "),
                             F.substr(letters, F.floor(n / 5) + 1, F.lit(1)),
                             F.substr(letters, n % 5 + 1, F.lit(1)))).alias("state"),
        city.alias("city"),
        F.when(k % 13 == 0, F.lit("")).otherwise(F.lpad(_s(k), 5, "0")).alias("postcode"),
        F.when(k % 17 == 0, F.lit(" ")).otherwise(F.lit("Main St")).alias("street"),
        _s(k % 900).alias("number"),
        F.when(k % 6 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Apt "), _s(k % 9))).alias("unit"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).when(k % 4 == 1, F.lit(""))
         .otherwise(F.concat(F.lit("R"), _s(n))).alias("region"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("D1")).alias("district"),
        F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(_s(n)).alias("lat"),
        F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(_s(-n)).alias("lon"),
        F.concat(F.lit("Dock "), _s(k % 11)).alias("ship_to_address"),
        F.when(k % 61 == 3, F.lit(None).cast("string"))
         .otherwise(_s(F.lit(VALID_FROM_BASE) + k * 3600)).alias("valid_from"),
        F.when(k % 70 == 1, F.lit(VALID_TO_MILLIS)).when(k % 90 == 0, F.lit(VALID_TO_EARLY)).when(k % 3 == 0, F.lit(VALID_TO_LATE))
         .otherwise(F.lit(None).cast("string")).alias("valid_to"),
        F.concat(_s(k % 200), F.when(k % 3 == 0, ".0").otherwise("")).alias("units_purchased"),
        F.concat(_s(_tier(F.col("c_mktsegment"))), F.when(k % 2 == 0, ".0").otherwise(""))
         .alias("loyalty_segment"),
        _ingest_ts(ctx),
        F.lit("customers/customers.csv").alias("_source_file"),
        F.lit(ctx.batch_id).alias("_batch_id"),
    )


def bronze_customers(spark: SparkSession, sf_dir: str, ctx: RunContext = FIXTURE_CTX) -> DataFrame:
    """Customers as landed; every 25th key also has an older copy in another city."""
    return _customer_row(_table(spark, sf_dir, "customer"), ctx)


def bronze_products(spark: SparkSession, sf_dir: str, ctx: RunContext = FIXTURE_CTX) -> DataFrame:
    """Products as landed; every 33rd key also has an older, renamed copy."""
    p = _table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = (F.when(F.col("_copy") == 0, F.col("p_name"))
             .otherwise(F.concat(F.col("p_name"), F.lit(" (old)"))))
    return p.select("*", _copies(k, 33)).select(
        F.when(k == 71, F.lit(None).cast("string")).otherwise(_s(k)).alias("product_id"),
        F.when(k % 70 == 1, F.lit(None).cast("string")).otherwise(F.col("p_type"))
         .alias("product_category"),
        F.when(k % 73 == 3, F.lit(" ")).otherwise(name).alias("product_name"),
        F.when(k % 40 == 9, F.lit("-1")).when(k % 41 == 9, F.lit(""))
         .when(k % 53 == 9, F.lit("NaN")).when(k % 59 == 9, F.lit("Infinity"))
         .otherwise(_s(F.col("p_retailprice"))).alias("sales_price"),
        F.when(k % 71 == 2, F.lit(None).cast("string")).when(k % 30 == 0, F.lpad(_s(k), 12, "4")).otherwise(F.lpad(_s(k), 13, "4")).alias("EAN13"),
        F.lpad(_s(k % 100000), 5, "0").alias("EAN5"),
        F.when(k % 79 == 4, F.lit("")).otherwise(F.col("p_brand")).alias("product_unit"),
        _ingest_ts(ctx),
        F.lit("products/products.csv").alias("_source_file"),
        F.lit(ctx.batch_id).alias("_batch_id"),
    )


def bronze_loyalty_segments(spark: SparkSession, sf_dir: str,
                            ctx: RunContext = FIXTURE_CTX) -> DataFrame:
    """One tier per market segment found in the customers, and one row with a
    defect of each kind per region.

    Threshold rule: 10 * (2^tier - 1) units, i.e. 0, 10, 30, 70, 150.
    """
    tier = F.col("tier")
    segs = (_table(spark, sf_dir, "customer").select(_tier(F.col("c_mktsegment")).alias("tier"))
            .distinct())
    rows = segs.select(
        _s(tier).alias("loyalty_segment_id"),
        F.concat(F.lit("level_"), _s(tier)).alias("loyalty_segment_description"),
        _s((F.pow(F.lit(2), tier) - 1).cast("long") * 10).alias("unit_threshold"),
        F.lit(LOYALTY_VALID_FROM).alias("valid_from"),
        F.lit("").alias("valid_to"),
    )
    r = F.col("r_regionkey")
    defects = _table(spark, sf_dir, "region").select(
        F.when(r != 0, _s(r + 10)).alias("loyalty_segment_id"),
        F.when(r == 1, "").otherwise("odd").alias("loyalty_segment_description"),
        F.when(r == 2, "-5").otherwise("5.0").alias("unit_threshold"),
        F.when(r == 3, "").otherwise(LOYALTY_VALID_FROM).alias("valid_from"),
        F.when(r == 4, "2016-01-01").otherwise("").alias("valid_to"),
    )
    rows = rows.unionByName(defects)
    return _audit(rows, ctx.run_ts, "loyalty_segments/loyalty_segment.csv", ctx)


def bronze_sales_orders(spark: SparkSession, sf_dir: str,
                        ctx: RunContext = FIXTURE_CTX) -> DataFrame:
    """One nested document per order; orders without lines get a NULL array.

    Every 29th order also arrives as an older copy, one day earlier. Each
    nation adds a document dated in the future, the first two also one that is
    no valid JSON. The array is built per order, so its size is bounded by one order's lines.
    """
    li = _table(spark, sf_dir, "lineitem")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    qty = (F.when((F.col("l_suppkey") % 37 == 0) & (F.col("l_linenumber") == 7), F.lit(0))
            .otherwise(F.col("l_quantity").cast("int")))
    n = F.col("l_linenumber")
    price = (F.when((n == 5) & (F.col("l_partkey") % 47 == 8), F.lit("-1"))
              .when((n == 5) & (F.col("l_partkey") % 47 == 9), F.lit("NaN"))
              .when(n == 4, _s(F.col("l_extendedprice").cast("double") + 0.004))
              .otherwise(_s(F.col("l_extendedprice"))))
    product = F.when((n != 6) | (F.col("l_partkey") % 43 != 7), _s(F.col("l_partkey")))
    # counted over a window, which deals the lines by order as the numbers they
    # are, before they are written out as text; the lists are made where they lie
    lines = (li.join(part, li.l_partkey == part.p_partkey, "left")
               .withColumn("n_lines", F.count(F.lit(1)).over(Window.partitionBy("l_orderkey")))
               .select("l_orderkey", "n_lines",
                       F.struct(product.alias("id"),
                                F.col("p_name").alias("name"),
                                price.alias("price"),
                                F.concat(_s(qty), F.when(n == 3, ".0").otherwise("")).alias("qty"),
                                F.lit(CURRENCY).alias("curr")).alias("p")))
    docs = lines.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list("p")).alias("ordered_products"),
        F.first("n_lines").alias("n_lines"))
    o = _table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    joined = o.join(docs, o.o_orderkey == docs.l_orderkey, "left").select("*", _copies(k, 29))
    secs = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) - F.col("_copy") * 86400
    own = joined.select(
        F.when(k != 5, _s(k)).alias("order_number"),
        F.when(k % 101 == 3, F.lit(None).cast("string"))
         .otherwise(_s(F.col("o_custkey"))).alias("customer_id"),
        F.concat(F.lit(" Customer "), _s(F.col("o_custkey")), F.lit(" ")).alias("customer_name"),
        F.when(k % 103 == 4, F.lit("")).otherwise(_s(secs)).alias("order_datetime"),
        _s(F.col("n_lines")).alias("number_of_line_items"),
        F.col("ordered_products"),
        F.lit(None).cast("string").alias(CORRUPT),
        _ingest_ts(ctx),
    )
    nation = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"))
    none = F.lit(None).cast("string")
    future = nation.select(
        F.concat(F.lit("F"), _s(F.col("n"))).alias("order_number"), F.lit("1").alias("customer_id"),
        F.lit("Customer 1").alias("customer_name"), F.lit(FUTURE_SECONDS).alias("order_datetime"),
        F.lit("0").alias("number_of_line_items"),
        F.lit(None).cast(own.schema["ordered_products"].dataType).alias("ordered_products"),
        none.alias(CORRUPT), F.lit(ctx.run_ts).alias("_ingest_ts"))
    broken = nation.filter("n < 2").select(
        *[none.alias(c) for c in future.columns[:5]],
        F.lit(None).cast(own.schema["ordered_products"].dataType).alias("ordered_products"),
        broken_document(F.col("n")).alias(CORRUPT), F.lit(ctx.run_ts).alias("_ingest_ts"))
    return (own.unionByName(future).unionByName(broken)
               .withColumn("_source_file", F.lit("sales_orders/"))
               .withColumn("_batch_id", F.lit(ctx.batch_id)))


def broken_document(n: Column) -> Column:
    """Text of an order document that is cut off."""
    return F.concat(F.lit('{"order_number": "B'), _s(n), F.lit('", "customer_id": '))


def order_documents(spark: SparkSession, sf_dir: str, ctx: RunContext = FIXTURE_CTX) -> DataFrame:
    """The order documents as JSON text, the broken ones as they are."""
    o = bronze_sales_orders(spark, sf_dir, ctx)
    text = F.to_json(F.struct(*[f.name for f in SALES_ORDERS_JSON.fields],
                              F.lit("web").alias("channel")))
    return o.select(F.coalesce(CORRUPT, text).alias(RAW), "_ingest_ts", "_source_file", "_batch_id")


def bronze_from_testdata(spark: SparkSession, sf_dir: str,
                         ctx: RunContext = FIXTURE_CTX) -> dict[str, DataFrame]:
    return {
        "customers": bronze_customers(spark, sf_dir, ctx),
        "products": bronze_products(spark, sf_dir, ctx),
        "loyalty_segments": bronze_loyalty_segments(spark, sf_dir, ctx),
        "sales_orders": bronze_sales_orders(spark, sf_dir, ctx),
    }


def source_files(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """The sources as files under ``root``: two CSV, one ``;`` CSV and a folder
    of JSON documents, as an export would deliver them."""
    b = bronze_from_testdata(spark, sf_dir)
    paths = {name: f"{root}/{name}" for name in b}
    audit = ("_ingest_ts", "_source_file", "_batch_id")
    for name, sep in (("customers", ","), ("products", ";"), ("loyalty_segments", ",")):
        b[name].drop(*audit).write.csv(paths[name], header=True, sep=sep)
    order_documents(spark, sf_dir).select(RAW).write.text(paths["sales_orders"])
    return paths
