"""Named queries over the driver's test tables: (spark, sf_dir) -> DataFrame.

Each query builds the lakehouse lazily from the whole input tables and
returns one plan; nothing is collected. ``auric.oracle`` holds the matching
SQL for the checked ones.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.operators import enrich as E
from auric.operators.distinct import cube_with_distinct, customer_numbers
from auric.operators.gold import wide_from_tables
from auric.operators.history import point_in_time_join, scd2_history
from auric.functions.scalars import whole
from auric.operators.silver import customers_tax, prepare_orders
from auric.plans import metrics as M
from auric.plans import reports as R
from auric.plans.lakehouse import Lakehouse
from auric.sources.fixtures import order_documents
from auric.sources.readers import parse_orders

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Callable[[Lakehouse], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: fn(Lakehouse.from_testdata(spark, sf_dir))
        return fn
    return register


def _simple(name: str, get: Callable[[Lakehouse], DataFrame]) -> None:
    query(name)(get)


# --- silver -------------------------------------------------------------------
_simple("silver_customers", lambda lh: lh.silver.customers.clean)
_simple("silver_products", lambda lh: lh.silver.products.clean)
_simple("silver_loyalty", lambda lh: lh.silver.loyalty_segments.clean)
_simple("silver_orders", lambda lh: lh.silver.orders.clean)
_simple("silver_line_items", lambda lh: lh.silver.order_line_items.clean)


# Single operators on every customer / order / line, before the DQ gate.
_simple("customers_name_split", lambda lh: lh.silver.customers.tagged.select(
    "customer_id", "customer_name", "first_name", "last_name"))
_simple("customers_address", lambda lh: lh.silver.customers.tagged.select(
    "customer_id", "number", "street", "unit", "street_address"))
_simple("customers_validity_dates", lambda lh: lh.silver.customers.tagged.select(
    "customer_id", "valid_from", "valid_to"))
_simple("dedup_latest_order", lambda lh: lh.silver.orders_deduped.filter("not _dq_bad_document")
        .select("order_number", "customer_id", "customer_name", "order_ts", "order_date",
                "number_of_line_items"))
# NaN does not equal itself: these two show it as NULL to be comparable
_number = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c.split(".")[-1])
_simple("dedup_order_product", lambda lh: lh.silver.order_line_items.tagged.drop("_dq_reason")
        .withColumns({c: _number(c) for c in ("unit_price", "line_revenue")}))


def _lines(orders: DataFrame) -> DataFrame:
    return (orders.filter(F.col("ordered_products").isNotNull())
             .select("order_number", F.explode("ordered_products").alias("p"))
             .select("order_number", F.col("p.id").alias("product_id"),
                     F.col("p.price").try_cast("double").alias("unit_price"),
                     whole("p.qty", "int").alias("quantity"))
             .withColumn("unit_price", _number("unit_price")))


_simple("explode_orders", lambda lh: _lines(lh.silver.orders_deduped))


# --- data quality -------------------------------------------------------------
@query("dq_summary")
def _dq_summary(lh: Lakehouse) -> DataFrame:
    return lh.dq_results.select("entity", "batch_id", "rows_in", "rows_clean", "rows_quarantine")


@query("dq_batch_report")
def _dq_report(lh: Lakehouse) -> DataFrame:
    from auric.operators.dq import batch_report
    return batch_report(lh.dq_results, lh.ctx.batch_id).drop("reasons_json", "run_ts")


_REASONS = "struct<blocking: map<string, bigint>, warn: map<string, bigint>>"


@query("dq_blocking_counts")
def _dq_blocking(lh: Lakehouse) -> DataFrame:
    """Blocking counts as recorded in the summary's reasons_json."""
    parsed = lh.dq_results.select("entity", F.from_json("reasons_json", _REASONS).alias("r"))
    return parsed.select("entity", F.explode("r.blocking").alias("reason", "rows"))


@query("dq_warn_counts")
def _dq_warn(lh: Lakehouse) -> DataFrame:
    parsed = lh.dq_results.select("entity", F.from_json("reasons_json", _REASONS).alias("r"))
    return parsed.select("entity", F.explode("r.warn").alias("rule", "rows"))


@query("dq_quarantine_counts")
def _dq_qcounts(lh: Lakehouse) -> DataFrame:
    """Counts from the unified quarantine table itself."""
    return lh.quarantine.groupBy("entity", "reason").agg(F.count(F.lit(1)).alias("rows"))


_simple("dq_quarantine", lambda lh: lh.quarantine)
# sample read-back of a table for inspection (the limit is the feature)
_simple("sample_customers", lambda lh: lh.silver.customers.clean
        .select("customer_id", "customer_name", "first_name", "last_name", "state",
                "valid_from", "valid_to").orderBy("customer_id").limit(10))


@query("dq_quarantine_keys")
def _dq_qkeys(lh: Lakehouse) -> DataFrame:
    """Which records were quarantined, read back from the JSON payloads."""
    q = lh.quarantine
    js = lambda path: F.get_json_object("payload", path)
    key = (F.when(F.col("entity") == "customers", js("$.customer_id"))
            .when(F.col("entity") == "products", js("$.product_id"))
            .when(F.col("entity") == "loyalty_segments", js("$.loyalty_segment_id"))
            .when(F.col("entity") == "orders", js("$.order_number"))
            .otherwise(F.concat_ws("|", js("$.order_number"), js("$.product_id"))))
    return q.select("entity", "reason", "batch_id", key.alias("record_key"))

# --- gold ---------------------------------------------------------------------
_simple("dim_customer", lambda lh: lh.gold.dim_customer)
_simple("dim_product", lambda lh: lh.gold.dim_product)
_simple("dim_loyalty_segment", lambda lh: lh.gold.dim_loyalty_segment)
_simple("dim_date", lambda lh: lh.gold.dim_date)
_simple("fact_sales", lambda lh: lh.gold.fact_sales)
_simple("agg_sales_monthly", lambda lh: lh.gold.agg_sales_monthly)
_simple("wide_sales", lambda lh: lh.gold.wide_sales)


@query("layer_row_counts")
def _layer_counts(lh: Lakehouse) -> DataFrame:
    """Rows of every table. Each silver entity is planned once: its summary row
    has the rows of its clean table and what it adds to the quarantine, and the
    dimensions and the fact are projections of clean tables, row for row."""
    from auric.sinks.tables import row_counts
    of_clean = {"customers": "dim_customer", "products": "dim_product", "loyalty_segments": "dim_loyalty_segment",
                "order_line_items": "fact_sales"}
    row = lambda layer, table, n: F.struct(F.lit(layer).alias("layer"), table.alias("table_name"), n.alias("n"))
    gold = F.create_map(*[F.lit(x) for pair in of_clean.items() for x in pair])
    counted = (lh.dq_results.select(F.explode(F.array(
        row("silver", F.col("entity"), F.col("rows_clean")),
        row("silver", F.lit("dq_quarantine"), F.col("rows_quarantine")),
        row("silver", F.lit("dq_results"), F.lit(1).cast("long")),
        row("gold", F.element_at(gold, F.col("entity")), F.col("rows_clean")))).alias("c"))
        .select("c.*").filter(F.col("table_name").isNotNull())
        .groupBy("layer", "table_name").agg(F.sum("n").alias("row_count")))
    g = lh.gold
    tables = [("bronze", f"{k}_raw", v) for k, v in lh.bronze.items()]
    tables += [("gold", n, getattr(g, n)) for n in ("dim_date", "agg_sales_monthly", "wide_sales")]
    return row_counts(tables).unionByName(counted)


# --- reports ------------------------------------------------------------------
_simple("kpi_mom", lambda lh: R.kpi_mom(lh.gold.agg_sales_monthly))
_simple("kpi_mom_exact", lambda lh: R.kpi_mom_exact(lh.gold.wide_sales))
_simple("trend_by_segment", lambda lh: R.trend_by_segment(lh.gold.agg_sales_monthly))
_simple("top_states", lambda lh: R.top_states(lh.gold.agg_sales_monthly))
_simple("all_states", lambda lh: R.top_states(lh.gold.agg_sales_monthly, limit=None))
_simple("top_products", lambda lh: R.top_products(lh.gold.wide_sales))
_simple("category_segment", lambda lh: R.category_segment(lh.gold.agg_sales_monthly))
_simple("top_customers", lambda lh: R.top_customers(lh.gold.wide_sales))
_simple("weekday_split", lambda lh: R.weekday_split(lh.gold.wide_sales))
_simple("headline_kpis", lambda lh: R.headline_kpis(lh.gold.wide_sales))
_simple("top_states_exact", lambda lh: R.top_states_exact(lh.gold.wide_sales))


def _cube(lh: Lakehouse) -> tuple[DataFrame, DataFrame]:
    """The monthly cube and the bitmaps beside it."""
    wide = wide_from_tables(lh.gold.tables(), products_first=True)
    return cube_with_distinct(wide, customer_numbers(lh.gold.dim_customer, lh.gold.dim_loyalty_segment))


_simple("kpi_mom_rolled_up", lambda lh: R.kpi_mom_rolled_up(*_cube(lh)))
_simple("top_states_rolled_up", lambda lh: R.top_states_rolled_up(*_cube(lh)))
_simple("revenue_by_segment", lambda lh: R.revenue_by_segment(lh.gold.wide_sales))
_simple("loyalty_performance", lambda lh: R.loyalty_performance(
    lh.gold.fact_sales, lh.gold.dim_customer, lh.gold.dim_loyalty_segment))

# the selection the checked dashboards use
DASH_YEARS, DASH_MONTHS = (1997, 1999), (1, 2, 3, 4, 5, 6)


def _params(values) -> F.Column:
    """A selection as an array column, as a dashboard binds its parameters."""
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


# --- dashboard datasets -------------------------------------------------------
_simple("dash_kpi", lambda lh: R.dash_kpi(lh.gold.agg_sales_monthly, DASH_YEARS, DASH_MONTHS))
_simple("dash_kpi_all", lambda lh: R.dash_kpi(lh.gold.agg_sales_monthly))
_simple("dash_trend", lambda lh: R.dash_trend(lh.gold.agg_sales_monthly, DASH_YEARS, DASH_MONTHS))
_simple("dash_trend_all", lambda lh: R.dash_trend(lh.gold.agg_sales_monthly))
_simple("dash_heatmap",
        lambda lh: R.dash_heatmap(lh.gold.agg_sales_monthly, DASH_YEARS, DASH_MONTHS))
_simple("dash_heatmap_all", lambda lh: R.dash_heatmap(lh.gold.agg_sales_monthly))
_simple("dash_years", lambda lh: R.dash_years(lh.gold.agg_sales_monthly))
_simple("dash_months", lambda lh: R.dash_months(lh.gold.agg_sales_monthly))
_simple("dash_trend_by_segment_total", lambda lh: R.widget_total(
    R.dash_trend(lh.gold.agg_sales_monthly, DASH_YEARS, DASH_MONTHS), ["loyalty_segment"]))

# the widgets' own re-aggregations: trend by (month, tier), heatmap by (state, category)
_simple("dash_trend_widget", lambda lh: R.widget_total(
    R.dash_trend(lh.gold.agg_sales_monthly), ["year_month", "loyalty_segment"]))
_simple("dash_heatmap_widget", lambda lh: R.widget_total(
    R.dash_heatmap(lh.gold.agg_sales_monthly), ["state", "product_category"]))
# selections bound as array parameters; an empty array means no filter
_simple("dash_kpi_params", lambda lh: R.dash_kpi(
    lh.gold.agg_sales_monthly, _params(DASH_YEARS), _params(DASH_MONTHS)))
_simple("dash_trend_params", lambda lh: R.dash_trend(
    lh.gold.agg_sales_monthly, _params(DASH_YEARS), _params(())))
_simple("dash_heatmap_params", lambda lh: R.dash_heatmap(
    lh.gold.agg_sales_monthly, _params(()), _params(())))


# one selection fanned out to every dataset, as one table
_simple("dashboard_page", lambda lh: R.dashboard_page(lh.gold.agg_sales_monthly, DASH_YEARS, DASH_MONTHS))


# --- metric layer -------------------------------------------------------------

METRIC_STATE = "BC"   # the state asked about in the "top customers in a state" question

_simple("metric_top_products_last_quarter", lambda lh: M.top_products_last_quarter(
    lh.gold.wide_sales, lh.gold.dim_date))
_simple("metric_trend_12m", lambda lh: M.trend_last_months(
    lh.gold.wide_sales, lh.gold.agg_sales_monthly, 12))
_simple("metric_state_aov", lambda lh: M.states_by_aov(lh.gold.wide_sales))
_simple("metric_platinum_mom", lambda lh: M.tier_month_over_month(
    lh.gold.wide_sales, "Platinum", M.Cube(lh.gold.agg_sales_monthly)))
_simple("metric_weekday_share", lambda lh: M.weekday_share(lh.gold.wide_sales))
_simple("metric_top_customers_state",
        lambda lh: M.top_customers_in_state(lh.gold.wide_sales, METRIC_STATE))
_simple("metric_month_compare", lambda lh: M.latest_month_vs_previous(
    lh.gold.wide_sales, lh.gold.dim_date))
_simple("metric_platinum_state_category",
        lambda lh: M.best_state_then_category(lh.gold.wide_sales, "Platinum", M.Cube(lh.gold.agg_sales_monthly)))
# orders, customers and ratios of them from the cube and its bitmaps
_simple("metric_state_aov_rolled_up", lambda lh: M.states_by_aov(
    lh.gold.wide_sales, cube=M.Cube(*_cube(lh))))
_simple("metric_tier_counts_rolled_up", lambda lh: M.metric_query(
    lh.gold.wide_sales, ["revenue", "orders", "customers", "aov"], ["loyalty_segment", "product_category"],
    {"year": list(DASH_YEARS)}, cube=M.Cube(*_cube(lh))))
# the customer asked about by name (first, last as split in silver)
METRIC_CUSTOMER = ("customer#000000001", "machinery")


@query("metric_customer_by_name")
def _customer_by_name(lh: Lakehouse) -> DataFrame:
    """Customers of the name are dealt on their own, so that their number is
    known before the lines are joined: few of them are broadcast, and lines are
    neither dealt by customer nor joined to the products of other customers."""
    g = lh.gold
    # by customer_id alone they lie already, and nothing would be dealt
    chosen = g.dim_customer.filter(M.named(*METRIC_CUSTOMER)).repartition("customer_id", "customer_name")
    return M.customer_by_name(wide_from_tables(g.tables() | {"dim_customer": chosen}), *METRIC_CUSTOMER)



# instruction texts of the checked prompts; a caller passes its own
MONTHLY, STATE, LOYALTY = "Describe these months: ", "Describe this state: ", "Compare these tiers: "

# --- prompts and enrichment -----------------------

_simple("prompt_data_monthly", lambda lh: E.recent_months(lh.gold.agg_sales_monthly))
_simple("prompts_monthly", lambda lh: E.monthly_prompt(lh.gold.agg_sales_monthly, MONTHLY))
_simple("prompts_states", lambda lh: E.state_prompts(lh.gold.agg_sales_monthly, STATE))
_simple("prompts_loyalty", lambda lh: E.loyalty_prompt(
    lh.gold.fact_sales, lh.gold.dim_customer, lh.gold.dim_loyalty_segment, LOYALTY))
_simple("enriched_states", lambda lh: E.enrich(
    E.state_prompts(lh.gold.agg_sales_monthly, STATE), "prompt", "insight", E.word_count_stub))

# --- items the reference names without code ------------------------------------

_simple("sales_by_product", lambda lh: R.sales_by_product(lh.gold.wide_sales))
_simple("heatmap_pivot", lambda lh: R.heatmap_pivot(lh.gold.agg_sales_monthly))
_simple("customers_tax", lambda lh: customers_tax(lh.bronze["customers"]))
_simple("customer_history", lambda lh: scd2_history(
    lh.bronze["customers"], "customer_id", ["customer_name", "state", "city"], "_ingest_ts"))


@query("orders_point_in_time")
def _point_in_time(lh: Lakehouse) -> DataFrame:
    """The customer version valid at a time around the two landings, for each order."""
    history = scd2_history(lh.bronze["customers"].filter(F.col("customer_id").isNotNull()),
                           "customer_id", ["city"], "_ingest_ts")
    shift = (F.length("order_number") + F.col("customer_id").cast("long")) % 4 * 43200 - 129600
    orders = lh.silver.orders.clean.filter(F.col("customer_id").isNotNull()).select(
        "order_number", "customer_id",
        F.timestamp_seconds(F.unix_seconds(F.lit(lh.ctx.run_ts)) + shift).alias("at"))
    return point_in_time_join(orders, history, "customer_id", "at").select(
        "order_number", "customer_id", "at", "city", "version")


@query("order_documents_parsed")
def _documents(lh: Lakehouse) -> DataFrame:
    """Lines of the order documents read from their JSON text in the plan."""
    docs = parse_orders(order_documents(lh.spark, lh.sf_dir, lh.ctx))
    return _lines(prepare_orders(docs))


# --- the dashboard's named filters (date range, state, tier) on reports ----------

FILTER_RANGE = R.Between(_dt.date(1997, 1, 1), _dt.date(1998, 12, 31))
FILTER_TIERS = ["Gold", "Platinum"]
FILTER_STATES = ["AB", "BC", "CD", "DE"]

_simple("top_products_filtered", lambda lh: R.top_products(
    lh.gold.wide_sales, filters={"order_date": FILTER_RANGE, "loyalty_segment": FILTER_TIERS}))
_simple("top_customers_filtered", lambda lh: R.top_customers(
    lh.gold.wide_sales, filters={"order_date": FILTER_RANGE, "state": FILTER_STATES}))
_simple("kpi_mom_filtered", lambda lh: R.kpi_mom(
    lh.gold.agg_sales_monthly,
    filters={"year_month": R.Between("1997-01", "1998-12"), "state": FILTER_STATES,
             "loyalty_segment": FILTER_TIERS}))
