"""The batch job: land bronze, write silver (with quarantine and DQ trend), build gold.

Each stage reads the tables the previous stage wrote, so a failed stage can
be re-run alone and every table is replaced as a whole (the DQ trend table
is the exception: one partition per batch, replaced per batch).
``refresh_gold`` builds only the months that changed.

Materialisation points. Every entity's tagged frame (cleaned, deduplicated,
``_dq_reason`` attached) is written once to a staging table and split three
ways from there (clean table, quarantine rows, summary counts); without it
each of the three would redo the scan, casts and dedup shuffle. The staged
tables are ordinary tables under the warehouse, so they survive executor
loss and need no cache.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.context import RunContext, configure_session
from auric.operators import dq
from auric.operators.distinct import agg_sales_distinct, customer_numbers
from auric.operators.gold import (agg_sales_monthly, dim_customer, dim_date,
                                  dim_loyalty_segment, dim_product, fact_sales,
                                  wide_from_tables)
from auric.operators.silver import build_silver
from auric.sinks.tables import (append_batch, create_namespaces, drop_table,
                                overwrite_table, replace_partitions, with_audit)
from auric.sources import readers


@dataclass(frozen=True)
class Layout:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    fmt: str = "parquet"
    # The wide table is stored partitioned by month. Before the write its
    # rows are rebalanced by month: one shuffle, after which AQE splits a
    # big (hot) month over several tasks and merges small months, so files
    # are neither tiny nor one per task per month. Unlike a range
    # repartition, this needs no sampling pass over the joined input.
    wide_partition_by: tuple[str, ...] = ("year_month",)
    # The fact is stored by month as well, so date-bounded reads are pruned.
    fact_partition_by: tuple[str, ...] = ("year_month",)
    # Independent table writes of one stage are submitted together, as
    # concurrent Spark jobs sharing the executors (1 = one after another).
    parallel_writes: int = 4


def _write_all(writes: dict[str, Callable[[], object]], workers: int) -> dict[str, object]:
    """Run independent writes, ``workers`` at a time; re-raise the first error."""
    if workers <= 1 or len(writes) <= 1:
        return {name: write() for name, write in writes.items()}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(write) for name, write in writes.items()}
        return {name: f.result() for name, f in futures.items()}


# Comments say where a value comes from and when it is NULL, by the rules of
# auric.operators.
TABLE_COMMENTS = {
    "customers": "customers_raw after typing and the blocking rules, latest landing of each id; tax columns left out",
    "products": "products_raw after typing and the blocking rules, latest landing of each id",
    "loyalty_segments": "loyalty_segments_raw after typing and the blocking rules, label from the tier id",
    "orders": "sales_orders_raw without its lines, latest document of each order number, blocking rules applied",
    "order_line_items": "ordered_products of the deduplicated orders, one copy of a product per order, "
                        "blocking rules applied to the line alone",
    "dq_quarantine": "what the blocking rules of all entities took out: first rule that failed, row as JSON",
    "dq_results": "rule counts of every batch, one row per entity, partitioned by batch",
    "dim_customer": "customers, current values only",
    "dim_product": "products, current values only",
    "dim_loyalty_segment": "loyalty_segments, current values only",
    "dim_date": "every day between the first and the last order line, calendar attributes computed from the day",
    "fact_sales": "order_line_items with a key of their own, stored by month of the order",
    "agg_sales_monthly": "wide_sales summed by month, state, category and tier",
    "wide_sales": "fact_sales left-joined to its dimensions, stored by month of the order",
    "customer_numbers": "running numbers of the customers of a state and tier, for the bitmaps",
    "agg_sales_distinct": "bitmaps of the orders and customers of each cell of agg_sales_monthly",
}

COLUMN_COMMENTS = {
    "dim_customer": {
        "customer_id": "as landed, text; unique here",
        "customer_name": "as landed, trimmed; expected as last name, comma, first name",
        "first_name": "part of customer_name after the first comma; NULL without a comma",
        "last_name": "part of customer_name before the first comma; all of it without one",
        "state": "upper case, two characters or the row is quarantined",
        "region": "as landed; a missing one is only counted (null_region)",
        "district": "as landed; a missing one is only counted (null_district)",
        "street_address": "the parts of number, street and unit that are not blank, joined by a space",
        "loyalty_segment": "whole number; NULL if the text is none, and then no tier is joined",
    },
    "dim_product": {
        "product_id": "as landed, text; unique here",
        "product_category": "as landed, trimmed; a missing one is only counted (null_category)",
        "list_price": "sales_price as a number; not positive, not finite or too large is quarantined",
        "ean13": "text, so leading zeros stay; other lengths than 13 are only counted",
    },
    "dim_loyalty_segment": {
        "loyalty_segment_id": "whole number or the row is quarantined",
        "loyalty_segment_label": "name of the id by a fixed list; Unknown for an id outside it",
        "unit_threshold": "whole number, not negative; NULL if the text is none",
    },
    "dim_date": {
        "date_key": "the day, session time zone UTC",
        "year_month": "date_key formatted yyyy-MM",
        "day_of_week": "Spark's dayofweek of date_key, which starts with Sunday as 1",
        "is_weekend": "day_of_week is 1 or 7",
    },
    "fact_sales": {
        "sale_id": "SHA-256 over length-prefixed order_number and product_id",
        "date_key": "date of order_ts, which is read from unix seconds",
        "unit_price": "price on the order line, not the product's list_price",
        "line_revenue": "unit_price times quantity as a double; quarantined beyond the money limit",
    },
    "agg_sales_monthly": {
        "total_revenue": "line_revenue added up as decimals, then a double",
        "orders": "different order numbers of this cell alone; an order with two categories is in two cells",
        "unique_customers": "different matched customers of this cell alone; see agg_sales_distinct for roll-ups",
        "aov": "total_revenue by orders of the cell, 0.0 for a cell without an order number",
    },
    "wide_sales": {
        "order_number": "from the fact; repeats for every line of the order",
        "order_ts": "from the fact",
        "order_date": "date_key of the fact",
        "year": "computed from order_date",
        "quarter": "computed from order_date",
        "month": "computed from order_date",
        "year_month": "order_date formatted yyyy-MM; the table is stored by it",
        "day_name": "English weekday of order_date",
        "is_weekend": "as in dim_date",
        "customer_id": "from dim_customer, so NULL on a line whose customer is not there",
        "customer_name": "from dim_customer",
        "first_name": "from dim_customer",
        "last_name": "from dim_customer",
        "state": "from dim_customer",
        "city": "from dim_customer",
        "region": "from dim_customer",
        "district": "from dim_customer",
        "loyalty_segment": "label from dim_loyalty_segment, NULL without customer or tier",
        "product_id": "from dim_product, so NULL on a line whose product is not there",
        "product_name": "from dim_product",
        "product_category": "from dim_product",
        "list_price": "from dim_product",
        "product_unit": "from dim_product",
        "quantity": "from the fact, a positive whole number",
        "unit_price": "from the fact",
        "line_revenue": "from the fact",
        "currency": "from the fact, as on the order document",
    },
}
WIDE_COLUMN_COMMENTS = COLUMN_COMMENTS["wide_sales"]


def land_files(spark: SparkSession, paths: dict[str, str], ctx: RunContext,
               layout: Layout = Layout(), input_bytes: int | None = None) -> dict[str, str]:
    """Read the four raw sources from files and land them as bronze tables.

    ``input_bytes`` (size of the sources) sizes shuffle and scan partitions;
    see ``auric.context.sizing_settings``. Every stage takes its own."""
    configure_session(spark, input_bytes)
    readers.check_sources(spark, paths)
    frames = {name: with_audit(readers.read_source(spark, name, path), ctx)
              for name, path in paths.items()}
    return land(spark, frames, layout, input_bytes)


def land(spark: SparkSession, bronze: dict[str, DataFrame], layout: Layout = Layout(),
         input_bytes: int | None = None) -> dict[str, str]:
    configure_session(spark, input_bytes)
    create_namespaces(spark, [layout.bronze, layout.silver, layout.gold])
    out = {name: f"{layout.bronze}.{name}_raw" for name in bronze}
    _write_all({name: (lambda n=name, df=df: overwrite_table(
        df, out[n], f"Raw {n} as landed, with audit columns.", fmt=layout.fmt))
        for name, df in bronze.items()}, layout.parallel_writes)
    return out


def run_silver(spark: SparkSession, ctx: RunContext, layout: Layout = Layout(),
               input_bytes: int | None = None) -> dict[str, str]:
    """``input_bytes``: size of the bronze tables."""
    configure_session(spark, input_bytes)   # unix seconds -> dates needs the UTC session zone
    bronze = {name: spark.table(f"{layout.bronze}.{name}_raw")
              for name in ("customers", "products", "loyalty_segments", "sales_orders")}

    staged: list[str] = []

    def stage(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        staged.extend(f"{layout.silver}.stage_{n}" for n in frames)
        return _write_all({name: (lambda n=name, df=df: overwrite_table(
            df, f"{layout.silver}.stage_{n}", fmt=layout.fmt)) for name, df in frames.items()},
            layout.parallel_writes)

    silver = build_silver(bronze, ctx, stage)
    out = {r.entity: f"{layout.silver}.{r.entity}" for r in silver.results()}
    out["dq_quarantine"] = f"{layout.silver}.dq_quarantine"
    writes = {r.entity: (lambda r=r: overwrite_table(
        r.clean, out[r.entity], TABLE_COMMENTS[r.entity], fmt=layout.fmt))
        for r in silver.results()}
    writes["dq_quarantine"] = lambda: overwrite_table(
        dq.unified_quarantine(silver.results()), out["dq_quarantine"],
        TABLE_COMMENTS["dq_quarantine"], fmt=layout.fmt)
    _write_all(writes, layout.parallel_writes)
    res = f"{layout.silver}.dq_results"
    append_batch(dq.batch_summary(silver.results()).drop("batch_id"), res, ctx.batch_id,
                 TABLE_COMMENTS["dq_results"], fmt=layout.fmt)
    out["dq_results"] = res
    for name in staged:      # second copies of the data; nothing reads them any more
        drop_table(spark, name)
    return out


def run_gold(spark: SparkSession, layout: Layout = Layout(),
             input_bytes: int | None = None) -> dict[str, str]:
    """``input_bytes``: size of the silver tables."""
    configure_session(spark, input_bytes)
    create_namespaces(spark, [layout.gold])
    s = lambda t: spark.table(f"{layout.silver}.{t}")
    lines = s("order_line_items")
    first = {
        "dim_customer": dim_customer(s("customers")),
        "dim_product": dim_product(s("products")),
        "dim_loyalty_segment": dim_loyalty_segment(s("loyalty_segments")),
        "dim_date": dim_date(lines),
        "fact_sales": fact_sales(lines).withColumn(
            "year_month", F.date_format("date_key", "yyyy-MM")),
    }
    if layout.fact_partition_by:
        first["fact_sales"] = first["fact_sales"].hint("rebalance", *layout.fact_partition_by)
    by = {"fact_sales": layout.fact_partition_by}
    out = {name: f"{layout.gold}.{name}" for name in first}
    stored = _write_all({name: (lambda n=name, df=df: overwrite_table(
        df, out[n], TABLE_COMMENTS[n], COLUMN_COMMENTS[n], fmt=layout.fmt,
        partition_by=by.get(n, ()))) for name, df in first.items()}, layout.parallel_writes)
    stored["fact_sales"] = stored["fact_sales"].drop("year_month")
    # The star join runs once: the wide table is written from it, and the
    # monthly cube is aggregated from the stored wide table (column-pruned).
    wide = wide_from_tables(stored)
    if layout.wide_partition_by:
        wide = wide.hint("rebalance", *layout.wide_partition_by)
    wide_t = f"{layout.gold}.wide_sales"
    stored_wide = overwrite_table(wide, wide_t, TABLE_COMMENTS["wide_sales"],
                                  WIDE_COLUMN_COMMENTS, fmt=layout.fmt,
                                  partition_by=layout.wide_partition_by)
    out["wide_sales"] = wide_t
    agg_t = f"{layout.gold}.agg_sales_monthly"
    overwrite_table(agg_sales_monthly(stored_wide), agg_t, TABLE_COMMENTS["agg_sales_monthly"],
                    COLUMN_COMMENTS["agg_sales_monthly"], fmt=layout.fmt)
    out["agg_sales_monthly"] = agg_t
    # The bitmaps beside the cube: exact distinct counts for any roll-up of it.
    numbers_t, distinct_t = f"{layout.gold}.customer_numbers", f"{layout.gold}.agg_sales_distinct"
    numbers = overwrite_table(customer_numbers(stored["dim_customer"], stored["dim_loyalty_segment"]), numbers_t,
                              TABLE_COMMENTS["customer_numbers"], fmt=layout.fmt)
    overwrite_table(agg_sales_distinct(stored_wide, numbers), distinct_t,
                    TABLE_COMMENTS["agg_sales_distinct"], fmt=layout.fmt)
    out["customer_numbers"], out["agg_sales_distinct"] = numbers_t, distinct_t
    return out


def _fingerprints(rows: DataFrame, month: str) -> DataFrame:
    """(month, n, digest) of the rows of each month, whatever their order."""
    digest = F.sum(F.xxhash64(*[c for c in rows.columns if c != month]).cast("decimal(38,0)"))
    return rows.groupBy(F.col(month).alias("month")).agg(F.count(F.lit(1)).alias("n"), digest.alias("digest"))


def _changed_keys(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Keys whose row is new, gone or different."""
    a, b = (d.select(F.col(key).alias(f"{n}_key"), F.xxhash64(*sorted(new.columns)).alias(f"{n}_hash"))
            for d, n in ((new, "new"), (old, "old")))
    return (a.join(b, F.col("new_key") == F.col("old_key"), "full")
             .filter(~F.col("new_hash").eqNullSafe(F.col("old_hash")))
             .select(F.coalesce("new_key", "old_key").alias("changed")))


def refresh_gold(spark: SparkSession, layout: Layout = Layout(), input_bytes: int | None = None) -> list[str | None]:
    """Bring the gold tables up to the silver ones, building again only the months
    that changed; returns these months.

    A month has changed if its fact rows differ from the stored ones (new, late,
    corrected or withdrawn orders: the months of both are compared by a
    fingerprint, no rows are joined), or if one of its lines belongs to a customer,
    product or tier whose dimension row changed. For those months the fact, the
    wide table, the cube and its bitmaps are built and replace what was there;
    the other months' files are neither read nor written. The dimensions, which
    hold current values only, are replaced whole. The result equals ``run_gold``.
    """
    configure_session(spark, input_bytes)
    s = lambda t: spark.table(f"{layout.silver}.{t}")
    g = lambda t: f"{layout.gold}.{t}"
    lines = s("order_line_items")
    fact = fact_sales(lines).withColumn("year_month", F.date_format("date_key", "yyyy-MM"))
    stored_fact = spark.table(g("fact_sales"))
    new, old = _fingerprints(fact, "year_month"), _fingerprints(stored_fact.select(*fact.columns), "year_month")
    differ = (new.withColumnsRenamed({c: f"new_{c}" for c in new.columns})
              .join(old, F.col("new_month").eqNullSafe(F.col("month")), "full")
              .filter(~(F.col("new_n").eqNullSafe(F.col("n")) & F.col("new_digest").eqNullSafe(F.col("digest"))))
              .select(F.coalesce("new_month", "month").alias("month")))
    dims = {"dim_customer": dim_customer(s("customers")), "dim_product": dim_product(s("products")),
            "dim_loyalty_segment": dim_loyalty_segment(s("loyalty_segments"))}
    keys = {"dim_customer": "customer_id", "dim_product": "product_id", "dim_loyalty_segment": "loyalty_segment_id"}
    changed = {n: _changed_keys(d, spark.table(g(n)), keys[n]) for n, d in dims.items()}
    members = s("customers").select(F.col("customer_id").alias("member"), "loyalty_segment").join(
        changed["dim_loyalty_segment"], F.col("loyalty_segment") == F.col("changed"), "left_semi").select("member")
    touched = (differ
               .unionByName(fact.join(changed["dim_customer"].unionByName(members.withColumnRenamed("member", "changed")),
                                      F.col("customer_id") == F.col("changed"), "left_semi").select(F.col("year_month").alias("month")))
               .unionByName(fact.join(changed["dim_product"], F.col("product_id") == F.col("changed"), "left_semi")
                                .select(F.col("year_month").alias("month"))))
    months = sorted((r["month"] for r in touched.distinct().collect()), key=str)      # one value per month
    numbers = overwrite_table(customer_numbers(dims["dim_customer"], dims["dim_loyalty_segment"], spark.table(g("customer_numbers"))),
                              g("customer_numbers"), TABLE_COMMENTS["customer_numbers"], fmt=layout.fmt)
    dims["dim_date"] = dim_date(lines)
    stored = _write_all({n: (lambda n=n, d=d: overwrite_table(d, g(n), TABLE_COMMENTS[n], COLUMN_COMMENTS[n], fmt=layout.fmt))
                         for n, d in dims.items()}, layout.parallel_writes)
    if not months:
        return months
    chosen = F.col("year_month").isin([m for m in months if m is not None])
    if None in months:
        chosen = chosen | F.col("year_month").isNull()
    rebalanced = lambda df, by: df.hint("rebalance", *by) if by else df
    replace = lambda df, name, by=(): replace_partitions(df, g(name), "year_month", months, layout.fmt, by)
    own = replace(rebalanced(fact.filter(chosen), layout.fact_partition_by), "fact_sales", layout.fact_partition_by)
    wide = wide_from_tables({**stored, "fact_sales": own.filter(chosen).drop("year_month")})
    own_wide = replace(rebalanced(wide, layout.wide_partition_by), "wide_sales", layout.wide_partition_by).filter(chosen)
    replace(agg_sales_monthly(own_wide), "agg_sales_monthly")
    replace(agg_sales_distinct(own_wide, numbers), "agg_sales_distinct")
    return months


def run_all(spark: SparkSession, bronze: dict[str, DataFrame], ctx: RunContext,
            layout: Layout = Layout(), input_bytes: int | None = None) -> dict[str, str]:
    out = {}
    out.update({f"bronze.{k}": v for k, v in land(spark, bronze, layout, input_bytes).items()})
    out.update({f"silver.{k}": v for k, v in run_silver(spark, ctx, layout, input_bytes).items()})
    out.update({f"gold.{k}": v for k, v in run_gold(spark, layout, input_bytes).items()})
    return out


def gold_tables(spark: SparkSession, layout: Layout = Layout()) -> dict[str, DataFrame]:
    names = ("dim_customer", "dim_product", "dim_loyalty_segment", "dim_date", "fact_sales",
             "agg_sales_monthly", "wide_sales")
    tables = {n: spark.table(f"{layout.gold}.{n}") for n in names}
    tables["fact_sales"] = tables["fact_sales"].drop("year_month")   # only the storage column
    return tables
