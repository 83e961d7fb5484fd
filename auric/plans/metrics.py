"""A small metric layer over the wide sales table.

Measures (fixed definitions):
  revenue   = SUM(line_revenue)
  orders    = COUNT(DISTINCT order_number)
  customers = COUNT(DISTINCT customer_id)
  aov       = revenue / orders, of the same group (never an average of ratios)

``metric_query`` is what a question compiles to: measures by dimensions,
with filters, an order and an optional limit ("top" defaults to 10). Money
is rounded to 2 decimals. Rows whose grouping dimension is NULL are dropped
(NULL region/district are data-quality gaps, not a group).

A question whose grouping, filters and measures the monthly cube holds is
answered from the cube (``Cube``): revenue is additive over its cells, and
orders and customers are counted by the bitmaps beside it.

Relative periods ("last quarter", "last 12 months", "latest complete
month") are anchored on the data's own last order date (the end of the date
dimension), evaluated inside the plan as a scalar subquery, so results do not depend on the day the
query runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auric.functions.scalars import money, money_sum, pct_change, round_half_up, safe_div
from auric.operators.distinct import count_distinct
from auric.operators.gold import AGG_KEYS
from auric.plans.reports import apply_filters, per_order

MEASURES = ("revenue", "orders", "customers", "aov")
DEFAULT_TOP = 10


def _aggregates() -> dict[str, Column]:
    return {
        "_revenue": money_sum("line_revenue"),
        "_orders": F.count_distinct("order_number"),
        "_customers": F.count_distinct("customer_id"),
    }


def _measure(name: str) -> Column:
    if name == "revenue":
        return round_half_up("_revenue", 2).alias("revenue")
    if name == "orders":
        return F.col("_orders").alias("orders")
    if name == "customers":
        return F.col("_customers").alias("customers")
    if name == "aov":
        return round_half_up(safe_div("_revenue", "_orders"), 2).alias("aov")
    raise ValueError(f"unknown measure {name!r}; known: {MEASURES}")


def reads_only(where: Column | None, df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether a condition can be answered from these columns of ``df``: it
    resolves against them and nothing else."""
    if where is None:
        return True
    try:
        df.select(*columns).filter(where).schema
    except AnalysisException:
        return False
    return True


@dataclass(frozen=True)
class Cube:
    """The monthly pre-aggregate, with the bitmaps of its orders and customers
    where they are stored."""
    sums: DataFrame
    distinct: DataFrame | None = None

    def answers(self, measures: Sequence[str], dims: Sequence[str], filters: Mapping[str, Sequence] | None,
                where: Column | None) -> bool:
        """Whether the cube holds the answer: every grouping and filter column is
        one of its keys, which mean the same in the lines, and every measure is
        additive over its cells or counted by its bitmaps."""
        counted = any(m != "revenue" for m in measures)
        return ({*dims, *(filters or {})} <= set(AGG_KEYS) and (not counted or self.distinct is not None)
                and reads_only(where, self.sums, AGG_KEYS))

    def grouped(self, used: Sequence[str], dims: Sequence[str], chosen) -> DataFrame:
        """The aggregates ``used`` by ``dims`` of the cells that ``chosen`` keeps.
        The parts are tables of one row per group and are joined on the group."""
        parts = []
        if "_revenue" in used:
            parts.append(chosen(self.sums).groupBy(*dims).agg(money_sum("total_revenue").alias("_revenue")))
        for entity in ("orders", "customers"):
            if f"_{entity}" in used:
                parts.append(count_distinct(chosen(self.distinct), entity, dims).withColumnRenamed("n", f"_{entity}"))
        out = parts[0]
        for i, part in enumerate(parts[1:]):
            other = part.withColumnsRenamed({d: f"_{i}_{d}" for d in dims})
            on = reduce(and_, (F.col(d).eqNullSafe(F.col(f"_{i}_{d}")) for d in dims), F.lit(True))
            out = out.join(other, on, "left").drop(*(f"_{i}_{d}" for d in dims))
        # a group without orders or customers has no bitmap
        return out.fillna(0, [f"_{e}" for e in ("orders", "customers") if f"_{e}" in used])


def metric_query(wide: DataFrame, measures: Sequence[str] = ("revenue",),
                 dims: Sequence[str] = (), filters: Mapping[str, Sequence] | None = None,
                 where: Column | None = None, order: Sequence[Column | str] | None = None,
                 limit: int | None = None, drop_null_dims: bool = True,
                 cube: Cube | None = None) -> DataFrame:
    """Measures by dimensions. With ``cube``, a question that the cube provably
    answers is planned on it; the lines are not read then."""
    unknown = [m for m in measures if m not in MEASURES]
    if unknown:
        raise ValueError(f"unknown measures {unknown}; known: {MEASURES}")

    def chosen(rows: DataFrame) -> DataFrame:
        rows = apply_filters(rows, filters)
        if where is not None:
            rows = rows.filter(where)
        if drop_null_dims:
            for d in dims:
                rows = rows.filter(F.col(d).isNotNull())
        return rows
    needed = {"revenue": ["_revenue"], "orders": ["_orders"], "customers": ["_customers"],
              "aov": ["_revenue", "_orders"]}
    used = sorted({a for m in measures for a in needed[m]})
    if cube is not None and cube.answers(measures, dims, filters, where):
        grouped = cube.grouped(used, dims, chosen)
    else:
        rows, aggs = chosen(wide), _aggregates()
        if {"_orders", "_customers"} <= set(used):      # both counts without an Expand
            rows = per_order(rows, *dims)
            aggs = {"_revenue": F.sum("_amount").cast("double"), "_orders": F.count("order_number"),
                    "_customers": F.count_distinct("customer_id")}
        grouped = rows.groupBy(*dims).agg(*[aggs[a].alias(a) for a in used])
    out = grouped.select(*dims, *[_measure(m) for m in measures])
    if order is not None:
        out = out.orderBy(*order)
    if limit is not None:
        out = out.limit(limit)
    return out


def last_order_date(days: DataFrame) -> Column:
    """Last day of the date dimension, which ends with the last order day: a
    small table instead of a pass over the lines."""
    return days.select(F.max("date_key")).scalar()


def top_products_last_quarter(wide: DataFrame, days: DataFrame, k: int = DEFAULT_TOP) -> DataFrame:
    """Top products by revenue in the last full quarter before the quarter
    of the latest order. ``days``: the date dimension."""
    this_q = F.trunc(last_order_date(days), "quarter")
    prev_q = F.add_months(this_q, -3)
    in_prev_q = ((F.col("order_date") >= prev_q) & (F.col("order_date") < this_q)
                 # same bounds on the month column: lets a month-partitioned
                 # table skip every partition outside the quarter
                 & (F.col("year_month") >= F.date_format(prev_q, "yyyy-MM"))
                 & (F.col("year_month") < F.date_format(this_q, "yyyy-MM")))
    return metric_query(wide, ["revenue"], ["product_id", "product_name"], where=in_prev_q,
                        order=[F.col("revenue").desc(), F.col("product_id")], limit=k)


def trend_last_months(wide: DataFrame, agg: DataFrame, months: int = 12) -> DataFrame:
    """Monthly revenue by tier over the latest ``months`` months present in the
    monthly aggregate ``agg``."""
    first = (agg.filter(F.col("year_month").isNotNull()).select("year_month").distinct()
             .orderBy(F.col("year_month").desc()).limit(months)
             .select(F.min("year_month")).scalar())
    return metric_query(wide, ["revenue"], ["year_month", "loyalty_segment"],
                        where=F.col("year_month") >= first,
                        order=["year_month", "loyalty_segment"], cube=Cube(agg))


def states_by_aov(wide: DataFrame, k: int = DEFAULT_TOP, cube: Cube | None = None) -> DataFrame:
    return metric_query(wide, ["aov", "revenue", "orders"], ["state"],
                        order=[F.col("aov").desc(), F.col("state")], limit=k, cube=cube)


def growth(wide: DataFrame, measure: str = "revenue", where: Column | None = None,
           cube: Cube | None = None) -> DataFrame:
    """A measure by month with the previous month present and the % change
    ("growth" and "trend" questions group by year_month).

    The lag runs over the month-level result, one row per month."""
    m = metric_query(wide, [measure], ["year_month"], where=where, cube=cube)
    w = Window.orderBy("year_month")
    return (m.withColumn(f"prev_{measure}", F.lag(measure).over(w))
             .withColumn(f"{measure}_mom_pct", pct_change(measure, f"prev_{measure}"))
             .orderBy("year_month"))


def tier_month_over_month(wide: DataFrame, tier: str = "Platinum", cube: Cube | None = None) -> DataFrame:
    return growth(wide, "revenue", where=F.col("loyalty_segment") == tier, cube=cube)


def weekday_share(wide: DataFrame) -> DataFrame:
    """Weekday/weekend revenue, orders, AOV and share of revenue.

    The share's total is a window over the two-row result."""
    base = (wide.groupBy(F.when(F.col("is_weekend"), F.lit("Weekend"))
                         .otherwise(F.lit("Weekday")).alias("day_type"))
            .agg(*[v.alias(k) for k, v in _aggregates().items() if k != "_customers"]))
    total = F.sum("_revenue").over(Window.partitionBy())
    return base.select("day_type", _measure("revenue"), _measure("orders"), _measure("aov"),
                       round_half_up(safe_div(F.lit(100.0) * F.col("_revenue"), total), 2)
                       .alias("revenue_share_pct"))


def top_customers_in_state(wide: DataFrame, state: str, k: int = 5) -> DataFrame:
    return metric_query(wide, ["revenue"], ["customer_id", "first_name", "last_name"],
                        where=F.col("state") == state,
                        order=[F.col("revenue").desc(), F.col("customer_id")], limit=k,
                        drop_null_dims=False)


def latest_month_vs_previous(wide: DataFrame, days: DataFrame, k: int = 5) -> DataFrame:
    """Top products of the latest complete month (the month before the month
    of the last order) with their revenue in the month before that."""
    month = F.add_months(F.trunc(last_order_date(days), "month"), -1)
    cur, prev = F.date_format(month, "yyyy-MM"), F.date_format(F.add_months(month, -1), "yyyy-MM")
    rows = wide.filter(F.col("product_id").isNotNull() & F.col("year_month").isin(cur, prev))
    per = (rows.groupBy("product_id", "product_name")
           .agg(money_sum(F.when(F.col("year_month") == cur, F.col("line_revenue"))).alias("_cur"),
                money_sum(F.when(F.col("year_month") == prev, F.col("line_revenue"))).alias("_prev"))
           .filter(F.col("_cur").isNotNull()))
    return (per.select("product_id", "product_name",
                       round_half_up("_cur", 2).alias("revenue"),
                       round_half_up("_prev", 2).alias("prev_month_revenue"),
                       pct_change("_cur", "_prev").alias("change_pct"))
            .orderBy(F.col("revenue").desc(), F.col("product_id")).limit(k))


def best_state_then_category(wide: DataFrame, tier: str = "Platinum", cube: Cube | None = None) -> DataFrame:
    """State with the most ``tier`` revenue, and its top category for that tier.
    All of it is additive over the cube's cells, so with ``cube`` the lines are
    not read."""
    source, amount = (wide, "line_revenue") if cube is None else (cube.sums, "total_revenue")
    cells = (source.filter((F.col("loyalty_segment") == tier) & F.col("state").isNotNull())
             .groupBy("state", "product_category").agg(F.sum(money(amount)).alias("_c"))
             .withColumn("_s", F.sum("_c").over(Window.partitionBy("state"))))
    # one row per (state, category): the best state's best category comes first
    return (cells.orderBy(F.col("_s").desc(), "state", F.col("product_category").isNull(),
                          round_half_up("_c", 2).desc(), "product_category").limit(1)
            .filter(F.col("product_category").isNotNull())
            .select("state", round_half_up("_s", 2).alias("state_revenue"), "product_category",
                    round_half_up("_c", 2).alias("category_revenue")))


def named(first_name: str, last_name: str) -> Column:
    """Whether a row has this first and last name (the split name columns, not
    the raw LAST, FIRST text); case and surrounding spaces are ignored."""
    same = lambda c, v: F.lower(F.trim(F.col(c))) == F.lit(v.strip().lower())
    return same("first_name", first_name) & same("last_name", last_name)


def customer_by_name(wide: DataFrame, first_name: str, last_name: str) -> DataFrame:
    """Revenue, orders and AOV of the customer(s) of this name."""
    return metric_query(wide, ["revenue", "orders", "aov"],
                        ["customer_id", "first_name", "last_name"],
                        where=named(first_name, last_name), order=["customer_id"])
