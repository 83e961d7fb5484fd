"""Distinct counts that can be rolled up: bitmaps in a companion of the monthly cube.

A distinct count per cell cannot be summed over cells. Here each cell holds,
beside its sums, bitmaps of the numbers of its orders and customers; bitmaps of
cells are combined with OR and counted, which is exact for every grouping and
filter over the cube's keys.

A bitmap is a word of 64 numbers (``bucket`` says which), so its size is that of
the entities in it: a cell of few orders has few words, and never more of them
than it has orders.

Numbers are dense where they need to be. An entity has a *home*, the cube keys
that are the same on all its rows (an order: month, state and tier; a customer:
state and tier). It is numbered within its home, so that the cells of a home use
the same short range of numbers and their words are well filled. A home's
entities are dealt to ``PARTS`` by a hash and numbered in each, so that no window
holds a whole home.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auric.operators.gold import AGG_KEYS, agg_sales_monthly

PARTS = 16
WORD = 64   # numbers of a bitmap
ORDER_HOME = ("year_month", "year", "month", "state", "loyalty_segment")
CUSTOMER_HOME = ("state", "loyalty_segment")


def _part(entity: str) -> Column:
    return F.pmod(F.xxhash64(entity), F.lit(PARTS)).cast("int")


def customer_numbers(dim_customer: DataFrame, dim_loyalty: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(customer_id, state, loyalty_segment, part, number): every customer
    numbered from 1 on within state, tier and part.

    With ``known``, the numbers given before, a customer whose home is the same
    keeps its number and the others are numbered after the highest one of their
    home: bitmaps of months that are not built again stay right.
    """
    tiers = dim_loyalty.select(F.col("loyalty_segment_id"), F.col("loyalty_segment_label"))
    home = (dim_customer.join(tiers, dim_customer["loyalty_segment"] == tiers["loyalty_segment_id"], "left")
            .select("customer_id", "state", F.col("loyalty_segment_label").alias("loyalty_segment"))
            .filter(F.col("customer_id").isNotNull()).withColumn("part", _part("customer_id")))
    group = ["state", "loyalty_segment", "part"]
    w = Window.partitionBy(*group).orderBy("customer_id")
    if known is None:
        return home.withColumn("number", F.row_number().over(w))
    old = known.select(F.col("customer_id").alias("_id"), F.struct(*group).alias("_home"), "number")
    placed = home.join(old, (F.col("customer_id") == F.col("_id")) & F.struct(*group).eqNullSafe(F.col("_home")), "left")
    highest = known.groupBy(F.struct(*group).alias("_home")).agg(F.max("number").alias("_highest"))
    new = (placed.filter(F.col("number").isNull()).select("customer_id", *group)
                 .withColumn("number", F.row_number().over(w)).withColumn("_own", F.struct(*group)))
    new = new.join(highest, F.col("_own").eqNullSafe(F.col("_home")), "left").withColumn(
        "number", (F.col("number") + F.coalesce("_highest", F.lit(0))).cast("int"))
    return placed.filter(F.col("number").isNotNull()).select("customer_id", *group, "number") \
        .unionByName(new.select("customer_id", *group, "number"))


def _bitmaps(rows: DataFrame, entity: str) -> DataFrame:
    """(keys, entity, part, bucket, bits) from rows of (keys, part, number).
    Rows that come twice set the same bit."""
    place = F.col("number").cast("long") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(WORD)).cast("int"))
    return (rows.groupBy(*AGG_KEYS, "part", F.floor(place / WORD).alias("bucket")).agg(F.bit_or(bit).alias("bits"))
                .select(*AGG_KEYS, F.lit(entity).alias("entity"), "part", "bucket", "bits"))


def dealt_lines(wide: DataFrame) -> DataFrame:
    """The lines with what the cube and its bitmaps read, and ``part``, dealt by
    order home and part once for both of them.

    The operators read different columns, and one of them leaves out lines
    without a customer. Were that done before the lines are dealt, each would have
    a shuffle of its own, and joins of its own below it. So the columns travel as
    one array of a single struct, which no plan takes apart before it is
    unpacked: what is dealt is the same for all, and Spark uses it again.
    """
    other = [c for c in ("product_category", "order_number", "customer_id", "line_revenue", "quantity") if c in wide.columns]
    return (wide.withColumn("part", _part("order_number"))
                .select(*ORDER_HOME, "part", F.array(F.struct(*other)).alias("line"))
                .repartition(*ORDER_HOME, "part")
                .select(*ORDER_HOME, "part", F.inline("line")))


def cube_with_distinct(wide: DataFrame, numbers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The monthly cube and the bitmaps beside it, from lines that are dealt once."""
    lines = dealt_lines(wide)
    return agg_sales_monthly(lines, dealt_by=["part"]), agg_sales_distinct(lines, numbers)


def agg_sales_distinct(wide: DataFrame, numbers: DataFrame) -> DataFrame:
    """Bitmaps of the orders and customers of every cell of the monthly cube.

    ``wide``: the wide table, or ``dealt_lines`` of it. ``numbers``:
    ``customer_numbers`` of the same dimension. NULL orders and customers are not
    counted.

    Plan: a bit that is set twice is set, so lines need no reduction before
    they are numbered. Orders are dealt by home and part once: the numbering,
    the bitmaps and their counts by home all group within that. Customers are
    reduced there to a row with its categories for each month, joined to their
    numbers and dealt by month, home and part, where their bitmaps and counts by
    month group.
    """
    lines = wide if "part" in wide.columns else dealt_lines(wide)
    place = Window.partitionBy(*ORDER_HOME, "part").orderBy(F.col("order_number").asc_nulls_last())
    orders = (lines.select(*AGG_KEYS, "part", "order_number").withColumn("number", F.dense_rank().over(place))
                   .filter(F.col("order_number").isNotNull()))
    # a struct, since a set leaves out NULL and a NULL category is a cell too
    buyers = (lines.filter(F.col("customer_id").isNotNull()).groupBy(*ORDER_HOME, "part", "customer_id")
                   .agg(F.collect_set(F.struct("product_category")).alias("categories"))
                   .select(*ORDER_HOME, "customer_id", "categories"))
    customers = (buyers.join(numbers.select(F.col("customer_id").alias("numbered_id"), "part", "number"),
                             F.col("customer_id") == F.col("numbered_id"))
                       .repartition("year_month", *CUSTOMER_HOME, "part")
                       .select(*ORDER_HOME, "part", "number", F.inline("categories")))
    return _bitmaps(orders, "orders").unionByName(_bitmaps(customers, "customers"))


def count_distinct(distinct: DataFrame, entity: str, dims: Sequence[str] = ()) -> DataFrame:
    """(dims, n): the exact number of different orders or customers of the cells
    in ``distinct`` (filter it first), by ``dims`` of the cube's keys."""
    home = {"orders": ORDER_HOME, "customers": CUSTOMER_HOME}[entity]
    keys = list(dict.fromkeys([*dims, *home]))
    return (distinct.filter(F.col("entity") == entity)
                    .groupBy(*keys, "part", "bucket").agg(F.bit_or("bits").alias("bits"))
                    .groupBy(*dims).agg(F.sum(F.bit_count("bits")).alias("n")))
