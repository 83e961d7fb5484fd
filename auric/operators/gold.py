"""Silver -> gold: SCD1 dimensions, date dimension, fact, monthly aggregate, wide table.

Join strategy. The fact is the only table that grows with the business; the
dimensions are joined to it with left outer joins on their natural keys.
No join is hinted: Spark broadcasts a dimension only when its estimated
size (file statistics of a stored table) or, with AQE, its measured size is
under ``spark.sql.autoBroadcastJoinThreshold``, and plans a sort-merge join
otherwise. A hot customer on the fact side of a sort-merge join is split by
AQE's skew-join handling. ``dim_date`` is written for consumers but not
joined: its columns are functions of the day (see ``wide_sales``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.functions.scalars import money
from auric.operators.silver import Silver


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "customer_name", "first_name", "last_name", "state", "city",
        "postcode", "region", "district", "street_address", "ship_to_address", "lat", "lon",
        "loyalty_segment",
        F.col("valid_from").alias("source_valid_from"),
        F.col("valid_to").alias("source_valid_to"),
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "product_name", "product_category",
        F.col("unit_price").alias("list_price"),
        "ean13", "ean5", "product_unit",
    )


def dim_loyalty_segment(loyalty: DataFrame) -> DataFrame:
    return loyalty.select(
        "loyalty_segment_id", "loyalty_segment_label", "loyalty_segment_description",
        "unit_threshold",
        F.col("valid_from").alias("source_valid_from"),
        F.col("valid_to").alias("source_valid_to"),
    )


def calendar(date_key) -> dict:
    """The attributes ``dim_date`` holds for a day, computed from the day."""
    d = F.col(date_key) if isinstance(date_key, str) else date_key
    return {
        "date_key": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "year_month": F.date_format(d, "yyyy-MM"),
        "day": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }


def date_attributes(date_key) -> list:
    return [c.alias(name) for name, c in calendar(date_key).items()]


def calendar_columns(date_key, *names: str) -> list:
    return [calendar(date_key)[name].alias(name) for name in names]


def dim_date(lines: DataFrame) -> DataFrame:
    """One row per day from the first to the last order date of the lines.

    Bounds are a global min/max aggregate inside the plan (no driver round
    trip); no lines gives no days.
    """
    bounds = lines.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    days = bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_key"))
    return days.select(*date_attributes("date_key"))


def fact_sales(lines: DataFrame) -> DataFrame:
    """One row per order line. ``sale_id`` is a SHA-256 of the line's natural key
    (each part with its length in front), so it is the same on every run and
    unique however many lines there are."""
    key = [x for c in ("order_number", "product_id")
           for x in (F.length(c).cast("string"), F.lit(":"), F.col(c))]
    return lines.select(
        F.sha2(F.concat(*key), 256).alias("sale_id"),
        "order_number", "order_ts",
        F.col("order_date").alias("date_key"),
        "customer_id", "product_id", "quantity", "unit_price", "line_revenue", "currency",
    )


def sales_joined(fact: DataFrame, customers: DataFrame, products: DataFrame,
                 loyalty: DataFrame, products_first: bool = False) -> DataFrame:
    """Fact left-joined to the customer, product and tier dimensions; aliases
    f, c, p, l stay usable.

    Customers come first, so that a filter on them spares the lines of others the
    product join. With ``products_first`` the lines of an order lie together at the
    end, where all lines are dealt anew by what the customer and the order decide.
    """
    f = fact.alias("f")
    c, p, l = customers.alias("c"), products.alias("p"), loyalty.alias("l")
    joins = [(c, F.col("f.customer_id") == F.col("c.customer_id")), (p, F.col("f.product_id") == F.col("p.product_id"))]
    for dim, on in reversed(joins) if products_first else joins:
        f = f.join(dim, on, "left")
    return f.join(l, F.col("c.loyalty_segment") == F.col("l.loyalty_segment_id"), "left")


AGG_KEYS = ("year_month", "year", "month", "state", "product_category", "loyalty_segment")


def agg_sales_monthly(wide: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """Month x state x category x tier cube, aggregated from the wide table.

    The wide table already holds the dimension-side columns the cube groups
    by (calendar of the order day, state from ``dim_customer``, category
    from ``dim_product``, tier label from ``dim_loyalty_segment``, customer
    id from the customer dimension so unmatched customers count as NULL),
    so the star join runs once for both tables.

    ``orders`` and ``unique_customers`` are distinct counts per cell; summing
    them across cells over-counts entities that span cells (kept as in the
    dashboards that read this table; exact figures come from the wide table).

    Plan: lines are first reduced to one row per (cell, order, customer),
    which the map-side partial aggregate does before any shuffle, so a hot
    order or customer collapses early. Every line carries its order's single
    customer (orders are deduplicated before their lines are exploded), so
    the orders of a cell are the rows of that reduction and only the
    customer count needs a distinct. This replaces the ``Expand`` that two
    distinct counts in one aggregate would plan, which triples every line
    before the shuffle.

    ``dealt_by``: columns beside the keys that are the same on all lines of an
    order and that ``wide`` is dealt by (``distinct.dealt_lines``); the reduction
    groups by them too and so needs no shuffle.
    """
    per_order = wide.groupBy(*AGG_KEYS, *dealt_by, F.col("order_number").alias("_order"),
                             F.col("customer_id").alias("_customer")).agg(
        F.sum(money("line_revenue")).alias("_amount"),
        F.sum("quantity").alias("_units"),
        F.count(F.lit(1)).alias("_lines"),
    )
    grouped = per_order.groupBy(*AGG_KEYS).agg(
        F.sum("_amount").cast("double").alias("total_revenue"),
        F.sum("_units").alias("total_units"),
        F.count("_order").alias("orders"),
        F.count_distinct("_customer").alias("unique_customers"),
        F.sum("_lines").alias("line_count"),
    )
    return grouped.withColumn(
        "aov", F.when(F.col("orders") > 0, F.col("total_revenue") / F.col("orders"))
                .otherwise(F.lit(0.0)))


WIDE_COLUMNS = (
    "order_number", "order_ts", "order_date", "year", "quarter", "month", "year_month",
    "day_name", "is_weekend", "customer_id", "customer_name", "first_name", "last_name",
    "state", "city", "region", "district", "loyalty_segment", "product_id", "product_name",
    "product_category", "list_price", "product_unit", "quantity", "unit_price",
    "line_revenue", "currency",
)


def wide_sales(joined: DataFrame) -> DataFrame:
    """Denormalised line table. Customer and product keys come from the
    dimension side, so they are NULL when the dimension row is missing.

    The calendar columns are computed from the day instead of joined from
    ``dim_date``: every dim_date column is a function of the day, and
    dim_date spans every fact day by construction (both come from the same
    lines), so the join could only copy them. Skipping it saves a join and,
    in a lazily built plan, a second pass over the line lineage for the
    date bounds. They are computed after the joins, which deal the day alone.
    """
    day = F.col("f.date_key")
    return joined.select(
        F.col("f.order_number"), F.col("f.order_ts"),
        day.alias("order_date"), *calendar_columns(day, "year", "quarter", "month", "year_month",
                                                   "day_name", "is_weekend"),
        F.col("c.customer_id"), F.col("c.customer_name"), F.col("c.first_name"),
        F.col("c.last_name"), F.col("c.state"), F.col("c.city"), F.col("c.region"),
        F.col("c.district"),
        F.col("l.loyalty_segment_label").alias("loyalty_segment"),
        F.col("p.product_id"), F.col("p.product_name"), F.col("p.product_category"),
        F.col("p.list_price"), F.col("p.product_unit"),
        F.col("f.quantity"), F.col("f.unit_price"), F.col("f.line_revenue"), F.col("f.currency"),
    )


@dataclass
class Gold:
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_loyalty_segment: DataFrame
    dim_date: DataFrame
    fact_sales: DataFrame
    agg_sales_monthly: DataFrame
    wide_sales: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(self.__dict__)


def build_gold(silver: Silver) -> Gold:
    lines = silver.order_line_items.clean
    dc = dim_customer(silver.customers.clean)
    dp = dim_product(silver.products.clean)
    dl = dim_loyalty_segment(silver.loyalty_segments.clean)
    dd = dim_date(lines)
    fact = fact_sales(lines)
    wide = wide_sales(sales_joined(fact, dc, dp, dl))
    return Gold(dc, dp, dl, dd, fact, agg_sales_monthly(wide), wide)


def wide_from_tables(tables: dict[str, DataFrame], products_first: bool = False) -> DataFrame:
    """The wide table from stored dims and fact (e.g. after a dim refresh)."""
    return wide_sales(sales_joined(tables["fact_sales"], tables["dim_customer"],
                                   tables["dim_product"], tables["dim_loyalty_segment"], products_first))
