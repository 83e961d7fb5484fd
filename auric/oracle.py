"""Independent SQL rebuild of the checked queries, for DuckDB.

Each query is one SQL statement over the driver's parquet tables (views
``customer``, ``part``, ``orders``, ``lineitem`` ...). The raw-source dirt of
``auric.sources.fixtures`` and every pipeline step are re-expressed here as
CTEs, written from the rules, not generated from the Spark code. Lines are
joined flat from ``lineitem`` instead of nesting and exploding, which checks
that the nested round trip loses nothing.

Nothing is imported from the code under test: names, labels and constants are
written out here again.

Number conventions: money is summed as DECIMAL(28,10); rounding goes through
DECIMAL(30,10) (half-up); integer sums are cast to BIGINT.
"""

from __future__ import annotations

# --- Fixed values of the raw sources and of the tiers ---------------------------
SEGMENT_TIER = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3, "MACHINERY": 4}
TIER_LABELS = {0: "Prospect", 1: "Bronze", 2: "Silver", 3: "Gold", 4: "Platinum"}
UNKNOWN_TIER = "Unknown"
VALID_FROM_BASE = 1483228800
VALID_TO_EARLY, VALID_TO_LATE, VALID_TO_MILLIS = "1.4E9", "1.648137353E9", "1648137353000"
LOYALTY_VALID_FROM = "2017-01-01"
CURRENCY = "USD"
MONEY_LIMIT = "1e17"
# -------------------------------------------------------------------------------

AS_OF = "DATE '2026-01-01'"
BATCH = "'fixture-batch'"


def msum(expr: str) -> str:
    # a double's text is its shortest decimal; the direct cast loses digits of large amounts
    return f"CAST(SUM(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(28,10))) AS DOUBLE)"


def rnd(expr: str, digits: int = 2) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS DOUBLE) AS DECIMAL(30,10)), {digits}) AS DOUBLE)"


def div(num: str, den: str) -> str:
    return f"(({num}) / NULLIF(({den}), 0))"


def pct(cur: str, prev: str) -> str:
    return rnd(f"100.0 * (CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE)) / "
               f"NULLIF(CAST({prev} AS DOUBLE), 0.0)", 1)


def blank(c: str) -> str:
    return f"({c} IS NULL OR length({c}) = 0)"


_TIER = "CASE c_mktsegment " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in SEGMENT_TIER.items()) + " END"
_LABEL = "CASE loyalty_segment_id " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in TIER_LABELS.items()) + f" ELSE '{UNKNOWN_TIER}' END"


def _unix_date(c: str) -> str:
    secs = f"TRY_CAST(TRY_CAST({c} AS DOUBLE) AS BIGINT)"
    return (f"CASE WHEN {secs} BETWEEN -62135596800 AND 253402300799 "
            f"THEN CAST(make_timestamp({secs} * 1000000) AS DATE) END")


def not_money(c: str) -> str:
    return f"({c} IS NULL OR isnan({c}) OR {c} <= 0 OR {c} >= {MONEY_LIMIT})"


CTES: dict[str, str] = {}

# --- bronze (fixture dirt) ----------------------------------------------------
CTES["b_customers"] = f"""
  SELECT CASE WHEN k = 88 THEN NULL ELSE CAST(k AS VARCHAR) END AS customer_id,
    CASE WHEN k % 97 = 5 THEN NULL WHEN k % 20 = 7 THEN c_name
         ELSE ' ' || c_mktsegment || ',  ' || c_name || ' ' END AS customer_name,
    CASE WHEN k % 50 = 11 THEN 'XXX'
         ELSE ' ' || substr('abcde', CAST(floor(n / 5) AS BIGINT) + 1, 1)
                  || substr('abcde', n % 5 + 1, 1) END AS state,
    CASE WHEN older = 1 THEN 'Old City' ELSE 'City ' || CAST(n AS VARCHAR) END AS city,
    CASE WHEN k % 13 = 0 THEN '' ELSE lpad(CAST(k AS VARCHAR), 5, '0') END AS postcode,
    CASE WHEN k % 17 = 0 THEN ' ' ELSE 'Main St' END AS street,
    CAST(k % 900 AS VARCHAR) AS number,
    CASE WHEN k % 6 = 0 THEN NULL ELSE 'Apt ' || CAST(k % 9 AS VARCHAR) END AS unit,
    CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 = 1 THEN '' ELSE 'R' || CAST(n AS VARCHAR) END AS region,
    CASE WHEN k % 5 = 0 THEN NULL ELSE 'D1' END AS district,
    CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(n AS VARCHAR) END AS lat,
    CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(-n AS VARCHAR) END AS lon,
    'Dock ' || CAST(k % 11 AS VARCHAR) AS ship_to_address,
    CASE WHEN k % 61 = 3 THEN NULL ELSE CAST({VALID_FROM_BASE} + k * 3600 AS VARCHAR) END AS valid_from,
    CASE WHEN k % 70 = 1 THEN '{VALID_TO_MILLIS}' WHEN k % 90 = 0 THEN '{VALID_TO_EARLY}' WHEN k % 3 = 0 THEN '{VALID_TO_LATE}' END AS valid_to,
    CAST(k % 200 AS VARCHAR) AS units_purchased,
    CAST({_TIER} AS VARCHAR) AS loyalty_segment,
    'T' || CAST(k AS VARCHAR) AS tax_id, CAST(k % 7 AS VARCHAR) AS tax_code,
    older
  FROM (SELECT c_custkey AS k, c_nationkey AS n, c_mktsegment, c_name, 0 AS older FROM customer
        UNION ALL
        SELECT c_custkey, c_nationkey, c_mktsegment, c_name, 1 FROM customer
        WHERE c_custkey % 25 = 0)"""

CTES["b_products"] = """
  SELECT CASE WHEN k = 71 THEN NULL ELSE CAST(k AS VARCHAR) END AS product_id,
    CASE WHEN k % 70 = 1 THEN NULL ELSE p_type END AS product_category,
    CASE WHEN k % 73 = 3 THEN ' ' ELSE nm END AS product_name,
    CASE WHEN k % 40 = 9 THEN -1.0 WHEN k % 41 = 9 THEN NULL WHEN k % 53 = 9 THEN CAST('NaN' AS DOUBLE)
         WHEN k % 59 = 9 THEN CAST('Infinity' AS DOUBLE) ELSE p_retailprice END AS price,
    CASE WHEN k % 71 = 2 THEN NULL WHEN k % 30 = 0 THEN lpad(CAST(k AS VARCHAR), 12, '4')
         ELSE lpad(CAST(k AS VARCHAR), 13, '4') END AS ean13,
    lpad(CAST(k % 100000 AS VARCHAR), 5, '0') AS ean5,
    CASE WHEN k % 79 = 4 THEN '' ELSE p_brand END AS product_unit, older
  FROM (SELECT p_partkey AS k, p_name AS nm, p_type, p_retailprice, p_brand, 0 AS older FROM part
        UNION ALL
        SELECT p_partkey, p_name || ' (old)', p_type, p_retailprice, p_brand, 1 FROM part
        WHERE p_partkey % 33 = 0)"""

CTES["b_orders"] = """
  SELECT o.k, o.o_custkey, o.o_orderdate, o.older, n.n_lines
  FROM (SELECT o_orderkey AS k, o_custkey, o_orderdate, 0 AS older FROM orders
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderdate, 1 FROM orders WHERE o_orderkey % 29 = 0) o
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey) n
    ON n.l_orderkey = o.k"""

# --- silver -------------------------------------------------------------------
CTES["s_customers_all"] = f"""
  SELECT customer_id, nm AS customer_name,
    CASE WHEN strpos(nm, ',') > 0 THEN trim(regexp_replace(substr(nm, strpos(nm, ',') + 1), '^\\s+', ''))
         ELSE nm END AS first_name,
    CASE WHEN strpos(nm, ',') > 0 THEN trim(regexp_replace(substr(nm, 1, strpos(nm, ',') - 1), '\\s+$', ''))
         END AS last_name,
    upper(trim(state)) AS state, trim(city) AS city, trim(postcode) AS postcode,
    trim(region) AS region, trim(district) AS district, trim(street) AS street,
    trim(number) AS number, trim(unit) AS unit,
    concat_ws(' ', NULLIF(trim(number), ''), NULLIF(trim(street), ''), NULLIF(trim(unit), ''))
      AS street_address,
    trim(ship_to_address) AS ship_to_address,
    TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lon AS DOUBLE) AS lon,
    TRY_CAST(units_purchased AS BIGINT) AS units_purchased,
    TRY_CAST(loyalty_segment AS INTEGER) AS loyalty_segment,
    {_unix_date('valid_from')} AS valid_from,
    {_unix_date('valid_to')} AS valid_to, valid_to AS valid_to_text
  FROM (SELECT *, trim(customer_name) AS nm,
               row_number() OVER (PARTITION BY customer_id ORDER BY older) AS rn
        FROM b_customers) WHERE rn = 1"""

CTES["s_customers_tagged"] = f"""
  SELECT *, CASE
    WHEN {blank('customer_id')} THEN 'null_customer_id'
    WHEN {blank('customer_name')} THEN 'missing_name'
    WHEN state IS NULL OR length(state) <> 2 THEN 'invalid_state'
    WHEN valid_from IS NULL THEN 'null_valid_from'
    WHEN valid_to IS NOT NULL AND valid_to < valid_from THEN 'valid_to_before_from'
  END AS reason FROM s_customers_all"""

CTES["s_customers"] = "SELECT * EXCLUDE (reason, valid_to_text) FROM s_customers_tagged WHERE reason IS NULL"

CTES["s_products_all"] = """
  SELECT product_id, trim(product_category) AS product_category,
         trim(product_name) AS product_name, price AS unit_price,
         trim(ean13) AS ean13, trim(ean5) AS ean5, trim(product_unit) AS product_unit
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY older) AS rn
        FROM b_products) WHERE rn = 1"""

CTES["s_products_tagged"] = f"""
  SELECT *, CASE
    WHEN {blank('product_id')} THEN 'null_product_id'
    WHEN {not_money('unit_price')} THEN 'bad_price'
  END AS reason FROM s_products_all"""

CTES["s_products"] = "SELECT * EXCLUDE (reason) FROM s_products_tagged WHERE reason IS NULL"

CTES["s_loyalty_all"] = f"""
  SELECT *, {_LABEL} AS loyalty_segment_label FROM (
    SELECT loyalty_segment_id, 'level_' || CAST(loyalty_segment_id AS VARCHAR) AS loyalty_segment_description,
           CAST(pow(2, loyalty_segment_id) - 1 AS BIGINT) * 10 AS unit_threshold,
           DATE '{LOYALTY_VALID_FROM}' AS valid_from, CAST(NULL AS DATE) AS valid_to
    FROM (SELECT DISTINCT {_TIER} AS loyalty_segment_id FROM customer)
    UNION ALL
    SELECT CAST(CASE WHEN r_regionkey <> 0 THEN r_regionkey + 10 END AS INTEGER),
           CASE WHEN r_regionkey = 1 THEN '' ELSE 'odd' END,
           CASE WHEN r_regionkey = 2 THEN -5 ELSE 5 END,
           CASE WHEN r_regionkey <> 3 THEN DATE '{LOYALTY_VALID_FROM}' END,
           CASE WHEN r_regionkey = 4 THEN DATE '2016-01-01' END
    FROM region)"""

CTES["s_loyalty_tagged"] = f"""
  SELECT *, CASE
    WHEN loyalty_segment_id IS NULL THEN 'null_segment_id'
    WHEN {blank('loyalty_segment_description')} THEN 'null_description'
    WHEN unit_threshold < 0 THEN 'negative_threshold'
    WHEN valid_from IS NULL THEN 'null_valid_from'
    WHEN valid_to IS NOT NULL AND valid_to < valid_from THEN 'valid_to_before_from'
  END AS reason FROM s_loyalty_all"""

CTES["s_loyalty"] = "SELECT * EXCLUDE (reason) FROM s_loyalty_tagged WHERE reason IS NULL"

CTES["s_orders_dedup"] = """
  SELECT k, order_number, customer_id, customer_name, order_ts, CAST(order_ts AS DATE) AS order_date,
         number_of_line_items
  FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY order_ts DESC NULLS LAST, older) AS rn
    FROM (SELECT k, CASE WHEN k <> 5 THEN CAST(k AS VARCHAR) END AS order_number,
                 CASE WHEN k % 101 = 3 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
                 trim(' Customer ' || CAST(o_custkey AS VARCHAR) || ' ') AS customer_name,
                 CASE WHEN k % 103 = 4 THEN NULL
                      ELSE make_timestamp((CAST(epoch(o_orderdate) AS BIGINT) - older * 86400) * 1000000)
                 END AS order_ts,
                 CAST(n_lines AS INTEGER) AS number_of_line_items, older
          FROM b_orders))
  WHERE rn = 1
  UNION ALL
  SELECT NULL, 'F' || CAST(n_nationkey AS VARCHAR), '1', 'Customer 1',
         make_timestamp(4102444800 * 1000000), DATE '2100-01-01', 0 FROM nation"""

CTES["s_orders_tagged"] = f"""
  SELECT order_number, customer_id, customer_name, order_ts, order_date, number_of_line_items,
    CASE
      WHEN {blank('order_number')} THEN 'null_order_number'
      WHEN customer_id IS NULL THEN 'null_customer_id'
      WHEN order_ts IS NULL THEN 'bad_ts'
      WHEN order_date > {AS_OF} THEN 'future_date'
    END AS reason FROM s_orders_dedup
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'bad_document' FROM nation WHERE n_nationkey < 2"""

CTES["s_orders"] = "SELECT * EXCLUDE (reason) FROM s_orders_tagged WHERE reason IS NULL"

CTES["s_lines_exploded"] = f"""
  SELECT o.order_number, o.customer_id, o.order_date, o.order_ts,
         CASE WHEN l.l_linenumber <> 6 OR l.l_partkey % 43 <> 7 THEN CAST(l.l_partkey AS VARCHAR) END AS product_id,
         p.p_name AS product_name_snapshot,
         CASE WHEN l.l_linenumber = 5 AND l.l_partkey % 47 = 8 THEN -1.0
              WHEN l.l_linenumber = 5 AND l.l_partkey % 47 = 9 THEN CAST('NaN' AS DOUBLE)
              WHEN l.l_linenumber = 4 THEN CAST(l.l_extendedprice AS DOUBLE) + 0.004
              ELSE l.l_extendedprice END AS unit_price,
         CASE WHEN l.l_suppkey % 37 = 0 AND l.l_linenumber = 7 THEN 0
              ELSE CAST(l.l_quantity AS INTEGER) END AS quantity,
         '{CURRENCY}' AS currency
  FROM s_orders_dedup o
  JOIN lineitem l ON l.l_orderkey = o.k
  LEFT JOIN part p ON p.p_partkey = l.l_partkey"""

CTES["s_lines_all"] = """
  SELECT order_number, customer_id, order_date, order_ts, product_id, product_name_snapshot,
         unit_price, quantity, currency, unit_price * quantity AS line_revenue
  FROM (SELECT *, row_number() OVER (
          PARTITION BY order_number, product_id
          ORDER BY order_ts DESC NULLS LAST, unit_price DESC NULLS LAST, quantity DESC NULLS LAST,
                   product_name_snapshot DESC NULLS LAST, currency DESC NULLS LAST,
                   customer_id DESC NULLS LAST, order_date DESC NULLS LAST) AS rn
        FROM s_lines_exploded) WHERE rn = 1"""

CTES["s_lines_tagged"] = f"""
  SELECT *, CASE
    WHEN {blank('product_id')} THEN 'null_product_id'
    WHEN {not_money('unit_price')} THEN 'bad_price'
    WHEN quantity IS NULL OR quantity <= 0 OR line_revenue >= {MONEY_LIMIT} THEN 'bad_quantity'
    WHEN order_number IS NULL THEN 'null_order'
    WHEN order_date IS NULL THEN 'null_date'
  END AS reason FROM s_lines_all"""

CTES["s_lines"] = "SELECT * EXCLUDE (reason) FROM s_lines_tagged WHERE reason IS NULL"

CTES["dq_tagged"] = """
  SELECT 'customers' AS entity, reason FROM s_customers_tagged
  UNION ALL SELECT 'products', reason FROM s_products_tagged
  UNION ALL SELECT 'loyalty_segments', reason FROM s_loyalty_tagged
  UNION ALL SELECT 'orders', reason FROM s_orders_tagged
  UNION ALL SELECT 'order_line_items', reason FROM s_lines_tagged"""

CTES["dq_warn"] = f"""
  SELECT 'customers' AS entity, rule, CAST(SUM(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS rows
  FROM (SELECT unnest([
          {{'rule': 'null_region', 'hit': {blank('region')}}},
          {{'rule': 'null_district', 'hit': {blank('district')}}},
          {{'rule': 'null_postcode', 'hit': {blank('postcode')}}},
          {{'rule': 'null_street', 'hit': {blank('street')}}},
          {{'rule': 'missing_geocode', 'hit': lat IS NULL OR lon IS NULL}},
          {{'rule': 'unreadable_valid_to', 'hit': valid_to_text IS NOT NULL AND valid_to IS NULL}}],
          recursive := true)
        FROM s_customers_all)
  GROUP BY rule
  UNION ALL
  SELECT 'products', rule, CAST(SUM(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT)
  FROM (SELECT unnest([
          {{'rule': 'null_category', 'hit': {blank('product_category')}}},
          {{'rule': 'null_name', 'hit': {blank('product_name')}}},
          {{'rule': 'null_ean13', 'hit': {blank('ean13')}}},
          {{'rule': 'null_unit', 'hit': {blank('product_unit')}}},
          {{'rule': 'bad_ean13_length', 'hit': ean13 IS NOT NULL AND length(ean13) <> 13}}],
          recursive := true)
        FROM s_products_all)
  GROUP BY rule"""

# --- gold ---------------------------------------------------------------------
CTES["g_dim_customer"] = """
  SELECT customer_id, customer_name, first_name, last_name, state, city, postcode, region,
         district, street_address, ship_to_address, lat, lon, loyalty_segment,
         valid_from AS source_valid_from, valid_to AS source_valid_to
  FROM s_customers"""

CTES["g_dim_product"] = """
  SELECT product_id, product_name, product_category, unit_price AS list_price, ean13, ean5,
         product_unit FROM s_products"""

CTES["g_dim_loyalty"] = """
  SELECT loyalty_segment_id, loyalty_segment_label, loyalty_segment_description, unit_threshold,
         valid_from AS source_valid_from, valid_to AS source_valid_to FROM s_loyalty"""

CTES["g_dim_date"] = """
  SELECT date_key, CAST(year(date_key) AS INTEGER) AS year,
         CAST(quarter(date_key) AS INTEGER) AS quarter, CAST(month(date_key) AS INTEGER) AS month,
         strftime(date_key, '%B') AS month_name, strftime(date_key, '%Y-%m') AS year_month,
         CAST(day(date_key) AS INTEGER) AS day,
         CAST(dayofweek(date_key) + 1 AS INTEGER) AS day_of_week,
         strftime(date_key, '%A') AS day_name, dayofweek(date_key) IN (0, 6) AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                           INTERVAL 1 DAY)) AS DATE) AS date_key
        FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM s_lines)
        WHERE lo IS NOT NULL)"""

CTES["g_fact"] = """
  SELECT sha256(length(order_number) || ':' || order_number || length(product_id) || ':' || product_id) AS sale_id,
         order_number, order_ts, order_date AS date_key, customer_id, product_id, quantity,
         unit_price, line_revenue, currency FROM s_lines"""

CTES["g_joined"] = """
  SELECT f.order_number, f.order_ts, f.quantity, f.unit_price, f.line_revenue, f.currency,
         f.customer_id AS f_customer_id,
         d.date_key AS order_date, d.year, d.quarter, d.month, d.year_month, d.day_name,
         d.is_weekend,
         c.customer_id, c.customer_name, c.first_name, c.last_name, c.state, c.city, c.region,
         c.district, l.loyalty_segment_label AS loyalty_segment, l.unit_threshold,
         p.product_id, p.product_name, p.product_category, p.list_price, p.product_unit
  FROM g_fact f
  LEFT JOIN g_dim_customer c ON f.customer_id = c.customer_id
  LEFT JOIN g_dim_product p ON f.product_id = p.product_id
  LEFT JOIN g_dim_loyalty l ON c.loyalty_segment = l.loyalty_segment_id
  LEFT JOIN g_dim_date d ON f.date_key = d.date_key"""

CTES["g_agg"] = f"""
  SELECT *, CASE WHEN orders > 0 THEN total_revenue / orders ELSE 0.0 END AS aov FROM (
    SELECT year_month, year, month, state, product_category, loyalty_segment,
           {msum('line_revenue')} AS total_revenue,
           CAST(SUM(quantity) AS BIGINT) AS total_units,
           count(DISTINCT order_number) AS orders,
           count(DISTINCT customer_id) AS unique_customers,
           count(*) AS line_count
    FROM g_joined
    GROUP BY year_month, year, month, state, product_category, loyalty_segment)"""

CTES["g_wide"] = """
  SELECT order_number, order_ts, order_date, year, quarter, month, year_month, day_name,
         is_weekend, customer_id, customer_name, first_name, last_name, state, city, region,
         district, loyalty_segment, product_id, product_name, product_category, list_price,
         product_unit, quantity, unit_price, line_revenue, currency
  FROM g_joined"""

CTES["g_monthly"] = f"""
  SELECT year_month, {msum('total_revenue')} AS revenue,
         CAST(SUM(orders) AS BIGINT) AS orders,
         CAST(SUM(unique_customers) AS BIGINT) AS unique_customers
  FROM g_agg GROUP BY year_month"""


def with_ctes(select: str) -> str:
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in CTES.items())
    return f"WITH {body}\n{select}"


def _dash_filter(years, months) -> str:
    conds = []
    if years:
        conds.append(f"year IN ({', '.join(str(y) for y in years)})")
    if months:
        conds.append(f"month IN ({', '.join(str(m) for m in months)})")
    return " AND ".join(conds) if conds else "TRUE"


SELECTS: dict[str, str] = {}

SELECTS["silver_customers"] = "SELECT * FROM s_customers"
SELECTS["silver_products"] = "SELECT * FROM s_products"
SELECTS["silver_loyalty"] = "SELECT * FROM s_loyalty"
SELECTS["silver_orders"] = "SELECT * FROM s_orders"
SELECTS["silver_line_items"] = "SELECT * FROM s_lines"

SELECTS["dq_summary"] = f"""
  SELECT entity, {BATCH} AS batch_id, count(*) AS rows_in,
         count(*) FILTER (WHERE reason IS NULL) AS rows_clean,
         count(*) FILTER (WHERE reason IS NOT NULL) AS rows_quarantine
  FROM dq_tagged GROUP BY entity"""

SELECTS["dq_batch_report"] = f"""
  SELECT entity, rows_in, rows_clean, rows_quarantine,
         {rnd(div('100.0 * rows_quarantine', 'rows_in'), 2)} AS pct_fail
  FROM ({SELECTS['dq_summary']})"""

SELECTS["dq_blocking_counts"] = """
  SELECT entity, reason, count(*) AS rows FROM dq_tagged WHERE reason IS NOT NULL
  GROUP BY entity, reason"""

SELECTS["dq_quarantine_counts"] = SELECTS["dq_blocking_counts"]

SELECTS["dq_warn_counts"] = "SELECT entity, rule, rows FROM dq_warn"

SELECTS["dim_customer"] = "SELECT * FROM g_dim_customer"
SELECTS["dim_product"] = "SELECT * FROM g_dim_product"
SELECTS["dim_loyalty_segment"] = "SELECT * FROM g_dim_loyalty"
SELECTS["dim_date"] = "SELECT * FROM g_dim_date"
SELECTS["fact_sales"] = "SELECT * FROM g_fact"
SELECTS["agg_sales_monthly"] = "SELECT * FROM g_agg"
SELECTS["wide_sales"] = "SELECT * FROM g_wide"

SELECTS["explode_orders"] = """
  SELECT order_number, product_id, CASE WHEN NOT isnan(unit_price) THEN unit_price END AS unit_price, quantity
  FROM s_lines_exploded"""

SELECTS["kpi_mom"] = f"""
  SELECT year_month, {rnd('revenue')} AS revenue, {pct('revenue', 'prev_revenue')} AS revenue_mom_pct,
         orders, {pct('orders', 'prev_orders')} AS orders_mom_pct,
         {rnd('aov')} AS aov, {pct('aov', 'prev_aov')} AS aov_mom_pct,
         unique_customers, {pct('unique_customers', 'prev_customers')} AS customers_mom_pct
  FROM (SELECT *, lag(revenue) OVER w AS prev_revenue, lag(orders) OVER w AS prev_orders,
               lag(aov) OVER w AS prev_aov, lag(unique_customers) OVER w AS prev_customers
        FROM (SELECT *, {div('revenue', 'orders')} AS aov FROM g_monthly)
        WINDOW w AS (ORDER BY year_month ASC NULLS FIRST))"""

SELECTS["trend_by_segment"] = f"""
  SELECT year_month, loyalty_segment, {rnd(msum('total_revenue'))} AS revenue,
         CAST(SUM(orders) AS BIGINT) AS orders
  FROM g_agg
  WHERE year_month IS NOT NULL AND loyalty_segment IS NOT NULL AND loyalty_segment <> 'Prospect'
  GROUP BY year_month, loyalty_segment"""


def _states(limit: str) -> str:
    return f"""
  SELECT state, {rnd('rev')} AS revenue, orders, unique_customers, {rnd(div('rev', 'orders'))} AS aov
  FROM (SELECT state, {msum('total_revenue')} AS rev, CAST(SUM(orders) AS BIGINT) AS orders,
               CAST(SUM(unique_customers) AS BIGINT) AS unique_customers
        FROM g_agg WHERE state IS NOT NULL GROUP BY state)
  ORDER BY revenue DESC, state {limit}"""


SELECTS["top_states"] = _states("LIMIT 10")
SELECTS["all_states"] = _states("")

SELECTS["top_products"] = f"""
  SELECT product_name, product_category, {rnd(msum('line_revenue'))} AS revenue,
         CAST(SUM(quantity) AS BIGINT) AS units_sold, count(DISTINCT order_number) AS orders
  FROM g_wide WHERE product_name IS NOT NULL
  GROUP BY product_name, product_category
  ORDER BY revenue DESC, product_name, product_category NULLS FIRST LIMIT 10"""

SELECTS["category_segment"] = f"""
  SELECT product_category, loyalty_segment, {rnd(msum('total_revenue'))} AS revenue,
         CAST(SUM(orders) AS BIGINT) AS orders
  FROM g_agg WHERE product_category IS NOT NULL AND loyalty_segment IS NOT NULL
  GROUP BY product_category, loyalty_segment"""

SELECTS["top_customers"] = f"""
  SELECT customer_id, first_name, last_name, state, city, loyalty_segment,
         {rnd('rev')} AS revenue, orders, {rnd(div('rev', 'orders'))} AS aov, last_order_date
  FROM (SELECT customer_id, first_name, last_name, state, city, loyalty_segment,
               {msum('line_revenue')} AS rev, count(DISTINCT order_number) AS orders,
               max(order_date) AS last_order_date
        FROM g_wide WHERE customer_id IS NOT NULL
        GROUP BY customer_id, first_name, last_name, state, city, loyalty_segment)
  ORDER BY revenue DESC, customer_id LIMIT 25"""

SELECTS["weekday_split"] = f"""
  SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
         {rnd('rev')} AS revenue, orders, {rnd(div('rev', 'orders'))} AS aov
  FROM (SELECT is_weekend, {msum('line_revenue')} AS rev, count(DISTINCT order_number) AS orders
        FROM g_wide GROUP BY is_weekend)"""

SELECTS["headline_kpis"] = f"""
  SELECT {rnd('rev')} AS total_revenue, total_orders, unique_customers,
         {rnd(div('rev', 'total_orders'))} AS aov, first_order, last_order
  FROM (SELECT {msum('line_revenue')} AS rev, count(DISTINCT order_number) AS total_orders,
               count(DISTINCT customer_id) AS unique_customers,
               min(order_date) AS first_order, max(order_date) AS last_order FROM g_wide)"""

SELECTS["top_states_exact"] = f"""
  SELECT state, {rnd(msum('line_revenue'))} AS revenue, count(DISTINCT order_number) AS orders
  FROM g_wide WHERE state IS NOT NULL GROUP BY state
  ORDER BY revenue DESC, state LIMIT 10"""

SELECTS["revenue_by_segment"] = f"""
  SELECT loyalty_segment, {rnd(msum('line_revenue'))} AS revenue,
         count(DISTINCT customer_id) AS customers,
         {rnd(msum('line_revenue') + ' / count(line_revenue)')} AS avg_line_revenue
  FROM g_wide WHERE loyalty_segment IS NOT NULL GROUP BY loyalty_segment"""

SELECTS["kpi_mom_exact"] = f"""
  SELECT year_month, {rnd('revenue')} AS revenue, {pct('revenue', 'prev_revenue')} AS revenue_mom_pct,
         orders, {pct('orders', 'prev_orders')} AS orders_mom_pct, {rnd('aov')} AS aov,
         unique_customers
  FROM (SELECT *, lag(revenue) OVER w AS prev_revenue, lag(orders) OVER w AS prev_orders
        FROM (SELECT year_month, {msum('line_revenue')} AS revenue,
                     count(DISTINCT order_number) AS orders,
                     count(DISTINCT customer_id) AS unique_customers,
                     {div(msum('line_revenue'), 'count(DISTINCT order_number)')} AS aov
              FROM g_wide GROUP BY year_month)
        WINDOW w AS (ORDER BY year_month ASC NULLS FIRST))"""

DASH_YEARS = (1997, 1999)
DASH_MONTHS = (1, 2, 3, 4, 5, 6)


def _dash_kpi(years, months) -> str:
    return f"""
  SELECT {rnd('rev')} AS total_revenue, total_orders, {rnd(div('rev', 'total_orders'))} AS aov,
         unique_customers
  FROM (SELECT {msum('revenue')} AS rev, CAST(SUM(orders) AS BIGINT) AS total_orders,
               CAST(SUM(unique_customers) AS BIGINT) AS unique_customers
        FROM (SELECT year_month, {msum('total_revenue')} AS revenue,
                     CAST(SUM(orders) AS BIGINT) AS orders,
                     CAST(SUM(unique_customers) AS BIGINT) AS unique_customers
              FROM g_agg WHERE {_dash_filter(years, months)} GROUP BY year_month))"""


def _dash_trend(years, months) -> str:
    return f"""
  SELECT year_month, loyalty_segment, {rnd(msum('total_revenue'))} AS revenue
  FROM g_agg WHERE loyalty_segment IS NOT NULL AND {_dash_filter(years, months)}
  GROUP BY year_month, loyalty_segment"""


def _dash_heatmap(years, months) -> str:
    return f"""
  SELECT product_category, state, {rnd(msum('total_revenue'))} AS revenue
  FROM g_agg WHERE product_category IS NOT NULL AND state IS NOT NULL
    AND {_dash_filter(years, months)}
  GROUP BY product_category, state"""


SELECTS["dash_kpi"] = _dash_kpi(DASH_YEARS, DASH_MONTHS)
SELECTS["dash_kpi_all"] = _dash_kpi((), ())
SELECTS["dash_trend"] = _dash_trend(DASH_YEARS, DASH_MONTHS)
SELECTS["dash_trend_all"] = _dash_trend((), ())
SELECTS["dash_heatmap"] = _dash_heatmap(DASH_YEARS, DASH_MONTHS)
SELECTS["dash_heatmap_all"] = _dash_heatmap((), ())
SELECTS["dash_years"] = "SELECT DISTINCT year FROM g_agg WHERE year IS NOT NULL"
SELECTS["dash_months"] = "SELECT DISTINCT month FROM g_agg WHERE month IS NOT NULL"
SELECTS["dash_trend_widget"] = f"""
  SELECT year_month, loyalty_segment, {rnd(msum('revenue'))} AS revenue
  FROM ({_dash_trend((), ())}) GROUP BY year_month, loyalty_segment"""
SELECTS["dash_heatmap_widget"] = f"""
  SELECT state, product_category, {rnd(msum('revenue'))} AS revenue
  FROM ({_dash_heatmap((), ())}) GROUP BY state, product_category"""
SELECTS["dash_kpi_params"] = _dash_kpi(DASH_YEARS, DASH_MONTHS)
SELECTS["dash_trend_params"] = _dash_trend(DASH_YEARS, ())
SELECTS["dash_heatmap_params"] = _dash_heatmap((), ())
SELECTS["dashboard_page"] = f"""
  SELECT 'dash_kpi' AS dataset, CAST(NULL AS VARCHAR) AS a, CAST(NULL AS VARCHAR) AS b,
         total_revenue AS revenue, total_orders AS orders FROM ({SELECTS['dash_kpi']})
  UNION ALL SELECT 'dash_trend', year_month, loyalty_segment, revenue, NULL FROM ({SELECTS['dash_trend']})
  UNION ALL SELECT 'dash_heatmap', product_category, state, revenue, NULL FROM ({SELECTS['dash_heatmap']})
  UNION ALL SELECT 'dash_years', CAST(year AS VARCHAR), NULL, NULL, NULL FROM ({SELECTS['dash_years']})
  UNION ALL SELECT 'dash_months', CAST(month AS VARCHAR), NULL, NULL, NULL FROM ({SELECTS['dash_months']})"""
SELECTS["dash_trend_by_segment_total"] = f"""
  SELECT loyalty_segment, {rnd(msum('revenue'))} AS revenue
  FROM ({_dash_trend(DASH_YEARS, DASH_MONTHS)}) GROUP BY loyalty_segment"""

SELECTS["loyalty_performance"] = f"""
  SELECT loyalty_segment_label, unit_threshold, {rnd('rev')} AS revenue, customers,
         {rnd(div('rev', 'customers'))} AS revenue_per_customer
  FROM (SELECT l.loyalty_segment_label, l.unit_threshold, {msum('f.line_revenue')} AS rev,
               count(DISTINCT f.customer_id) AS customers
        FROM g_fact f
        JOIN g_dim_customer c ON f.customer_id = c.customer_id
        JOIN g_dim_loyalty l ON c.loyalty_segment = l.loyalty_segment_id
        GROUP BY l.loyalty_segment_label, l.unit_threshold)"""

SELECTS["layer_row_counts"] = """
  SELECT 'bronze' AS layer, 'customers_raw' AS table_name, count(*) AS row_count FROM b_customers
  UNION ALL SELECT 'bronze', 'products_raw', count(*) FROM b_products
  UNION ALL SELECT 'bronze', 'loyalty_segments_raw', count(*) FROM s_loyalty_all
  UNION ALL SELECT 'bronze', 'sales_orders_raw', (SELECT count(*) FROM b_orders)
    + (SELECT count(*) + count(*) FILTER (WHERE n_nationkey < 2) FROM nation)
  UNION ALL SELECT 'silver', 'customers', count(*) FROM s_customers
  UNION ALL SELECT 'silver', 'products', count(*) FROM s_products
  UNION ALL SELECT 'silver', 'loyalty_segments', count(*) FROM s_loyalty
  UNION ALL SELECT 'silver', 'orders', count(*) FROM s_orders
  UNION ALL SELECT 'silver', 'order_line_items', count(*) FROM s_lines
  UNION ALL SELECT 'silver', 'dq_quarantine', count(*) FROM dq_tagged WHERE reason IS NOT NULL
  UNION ALL SELECT 'silver', 'dq_results', count(DISTINCT entity) FROM dq_tagged
  UNION ALL SELECT 'gold', 'dim_customer', count(*) FROM g_dim_customer
  UNION ALL SELECT 'gold', 'dim_product', count(*) FROM g_dim_product
  UNION ALL SELECT 'gold', 'dim_loyalty_segment', count(*) FROM g_dim_loyalty
  UNION ALL SELECT 'gold', 'dim_date', count(*) FROM g_dim_date
  UNION ALL SELECT 'gold', 'fact_sales', count(*) FROM g_fact
  UNION ALL SELECT 'gold', 'agg_sales_monthly', count(*) FROM g_agg
  UNION ALL SELECT 'gold', 'wide_sales', count(*) FROM g_wide"""


# --- metric layer -------------------------------------------------------------
_MAXD = "(SELECT max(order_date) FROM g_wide)"

SELECTS["metric_top_products_last_quarter"] = f"""
  SELECT product_id, product_name, {rnd(msum('line_revenue'))} AS revenue
  FROM g_wide
  WHERE product_id IS NOT NULL AND product_name IS NOT NULL
    AND order_date >= CAST(date_trunc('quarter', {_MAXD}) - INTERVAL 3 MONTH AS DATE)
    AND order_date < CAST(date_trunc('quarter', {_MAXD}) AS DATE)
  GROUP BY product_id, product_name
  ORDER BY revenue DESC, product_id LIMIT 10"""

SELECTS["metric_trend_12m"] = f"""
  SELECT year_month, loyalty_segment, {rnd(msum('line_revenue'))} AS revenue
  FROM g_wide
  WHERE year_month IS NOT NULL AND loyalty_segment IS NOT NULL
    AND year_month >= (SELECT min(year_month) FROM (
          SELECT DISTINCT year_month FROM g_wide WHERE year_month IS NOT NULL
          ORDER BY year_month DESC LIMIT 12))
  GROUP BY year_month, loyalty_segment"""

SELECTS["metric_state_aov"] = f"""
  SELECT state, {rnd(div('rev', 'orders'))} AS aov, {rnd('rev')} AS revenue, orders
  FROM (SELECT state, {msum('line_revenue')} AS rev, count(DISTINCT order_number) AS orders
        FROM g_wide WHERE state IS NOT NULL GROUP BY state)
  ORDER BY aov DESC, state LIMIT 10"""

SELECTS["metric_platinum_mom"] = f"""
  SELECT year_month, revenue, prev_revenue, {pct('revenue', 'prev_revenue')} AS revenue_mom_pct
  FROM (SELECT *, lag(revenue) OVER (ORDER BY year_month) AS prev_revenue
        FROM (SELECT year_month, {rnd(msum('line_revenue'))} AS revenue FROM g_wide
              WHERE loyalty_segment = 'Platinum' AND year_month IS NOT NULL
              GROUP BY year_month))"""

SELECTS["metric_weekday_share"] = f"""
  SELECT day_type, {rnd('rev')} AS revenue, orders, {rnd(div('rev', 'orders'))} AS aov,
         {rnd(div('100.0 * rev', 'sum(rev) OVER ()'))} AS revenue_share_pct
  FROM (SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
               {msum('line_revenue')} AS rev, count(DISTINCT order_number) AS orders
        FROM g_wide GROUP BY 1)"""

SELECTS["metric_top_customers_state"] = f"""
  SELECT customer_id, first_name, last_name, {rnd(msum('line_revenue'))} AS revenue
  FROM g_wide WHERE state = 'BC'
  GROUP BY customer_id, first_name, last_name
  ORDER BY revenue DESC, customer_id NULLS FIRST LIMIT 5"""

_M = f"CAST(date_trunc('month', {_MAXD}) - INTERVAL 1 MONTH AS DATE)"
SELECTS["metric_month_compare"] = f"""
  SELECT product_id, product_name, {rnd('cur')} AS revenue, {rnd('prev')} AS prev_month_revenue,
         {pct('cur', 'prev')} AS change_pct
  FROM (SELECT product_id, product_name,
               {msum(f"CASE WHEN year_month = strftime({_M}, '%Y-%m') THEN line_revenue END")} AS cur,
               {msum(f"CASE WHEN year_month = strftime({_M} - INTERVAL 1 MONTH, '%Y-%m') THEN line_revenue END")} AS prev
        FROM g_wide
        WHERE product_id IS NOT NULL
          AND year_month IN (strftime({_M}, '%Y-%m'), strftime({_M} - INTERVAL 1 MONTH, '%Y-%m'))
        GROUP BY product_id, product_name)
  WHERE cur IS NOT NULL
  ORDER BY revenue DESC, product_id LIMIT 5"""

CTES["m_plat"] = "SELECT * FROM g_wide WHERE loyalty_segment = 'Platinum' AND state IS NOT NULL"

SELECTS["metric_platinum_state_category"] = f"""
  SELECT p.state, {rnd('s.rev')} AS state_revenue, p.product_category,
         {rnd(msum('p.line_revenue'))} AS category_revenue
  FROM m_plat p
  JOIN (SELECT state FROM m_plat GROUP BY state
        ORDER BY {msum('line_revenue')} DESC, state LIMIT 1) b ON p.state = b.state
  JOIN (SELECT state, {msum('line_revenue')} AS rev FROM m_plat GROUP BY state) s
    ON s.state = p.state
  WHERE p.product_category IS NOT NULL
  GROUP BY p.state, s.rev, p.product_category
  ORDER BY category_revenue DESC, p.product_category LIMIT 1"""

SELECTS["prompt_data_monthly"] = f"""
  SELECT year_month, {rnd('revenue')} AS revenue, orders, unique_customers AS customers,
         {rnd(div('revenue', 'orders'))} AS aov
  FROM g_monthly ORDER BY year_month DESC NULLS LAST LIMIT 6"""

# --- items named without code ----------------------------------------------------
SELECTS["sales_by_product"] = f"""
  SELECT year_month, product_id, product_name, product_category,
         {msum('line_revenue')} AS total_revenue, CAST(SUM(quantity) AS BIGINT) AS total_units,
         count(DISTINCT order_number) AS orders, count(*) AS line_count
  FROM g_wide GROUP BY year_month, product_id, product_name, product_category"""

SELECTS["heatmap_pivot"] = "SELECT product_category, " + ", ".join(
    f"{rnd(msum(f'CASE WHEN loyalty_segment = {chr(39)}{t}{chr(39)} THEN total_revenue END'))} AS {t}"
    for t in [*TIER_LABELS.values(), UNKNOWN_TIER]) + """
  FROM g_agg WHERE product_category IS NOT NULL GROUP BY product_category"""

SELECTS["customers_tax"] = """
  SELECT customer_id, tax_id, tax_code FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY older) AS rn FROM b_customers)
  WHERE rn = 1"""

SELECTS["customer_history"] = """
  SELECT customer_id, customer_name, state, city, valid_from,
         lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current,
         CAST(row_number() OVER w AS INTEGER) AS version
  FROM (SELECT *, lag({'n': customer_name, 's': state, 'c': city}) OVER w0 AS prev
        FROM (SELECT customer_id, customer_name, state, city,
                     CASE WHEN older = 1 THEN TIMESTAMP '2025-12-31 00:00:00'
                          ELSE TIMESTAMP '2026-01-01 00:00:00' END AS valid_from
              FROM b_customers)
        WINDOW w0 AS (PARTITION BY customer_id ORDER BY valid_from))
  WHERE prev IS NULL OR prev IS DISTINCT FROM {'n': customer_name, 's': state, 'c': city}
  WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from)"""


# --- prompts (text built from decimals and compact JSON) ------------------------
MONTHLY_INSTRUCTION, STATE_INSTRUCTION = "Describe these months: ", "Describe this state: "
LOYALTY_INSTRUCTION = "Compare these tiers: "


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _money_text(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(38,2)) AS VARCHAR)"


SELECTS["prompts_monthly"] = f"""
  SELECT {_lit(MONTHLY_INSTRUCTION)} || to_json(list({{
           'year_month': year_month, 'revenue': {_money_text('revenue')}, 'orders': orders,
           'customers': customers, 'aov': {_money_text('aov')}}} ORDER BY year_month)) AS prompt,
         count(*) AS months
  FROM ({SELECTS['prompt_data_monthly']})"""

_STATE_ROWS = f"""
  SELECT state, revenue, orders, aov, unique_customers AS customers,
         {_lit(STATE_INSTRUCTION)} || to_json({{'state': state, 'revenue': {_money_text('revenue')},
           'orders': orders, 'customers': unique_customers, 'aov': {_money_text('aov')}}}) AS prompt
  FROM ({_states('LIMIT 5')})"""
SELECTS["prompts_states"] = _STATE_ROWS

SELECTS["enriched_states"] = f"""
  SELECT *, CAST(len(string_split(prompt, ' ')) AS VARCHAR) || ' words, '
            || CAST(length(prompt) AS VARCHAR) || ' chars' AS insight,
         CAST(NULL AS VARCHAR) AS insight_error
  FROM ({_STATE_ROWS})"""

SELECTS["prompts_loyalty"] = f"""
  SELECT {_lit(LOYALTY_INSTRUCTION)} || to_json(list({{
           'loyalty_segment_label': loyalty_segment_label, 'unit_threshold': unit_threshold,
           'revenue': {_money_text('revenue')}, 'customers': customers,
           'revenue_per_customer': {_money_text('revenue_per_customer')}}}
           ORDER BY loyalty_segment_label)) AS prompt,
         count(*) AS tiers
  FROM ({SELECTS['loyalty_performance']})"""

SELECTS["dq_quarantine_keys"] = f"""
  SELECT 'customers' AS entity, reason, {BATCH} AS batch_id, customer_id AS record_key
  FROM s_customers_tagged WHERE reason IS NOT NULL
  UNION ALL SELECT 'products', reason, {BATCH}, product_id FROM s_products_tagged
  WHERE reason IS NOT NULL
  UNION ALL SELECT 'loyalty_segments', reason, {BATCH}, CAST(loyalty_segment_id AS VARCHAR)
  FROM s_loyalty_tagged WHERE reason IS NOT NULL
  UNION ALL SELECT 'orders', reason, {BATCH}, order_number FROM s_orders_tagged
  WHERE reason IS NOT NULL
  UNION ALL SELECT 'order_line_items', reason, {BATCH},
         concat_ws('|', order_number, product_id) FROM s_lines_tagged WHERE reason IS NOT NULL"""


# --- reports under the dashboard's named filters ---------------------------------
_RANGE = "order_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"
_TIERS = "loyalty_segment IN ('Gold', 'Platinum')"
_STATES = "state IN ('AB', 'BC', 'CD', 'DE')"

SELECTS["top_products_filtered"] = f"""
  SELECT product_name, product_category, {rnd(msum('line_revenue'))} AS revenue,
         CAST(SUM(quantity) AS BIGINT) AS units_sold, count(DISTINCT order_number) AS orders
  FROM g_wide WHERE product_name IS NOT NULL AND {_RANGE} AND {_TIERS}
  GROUP BY product_name, product_category
  ORDER BY revenue DESC, product_name, product_category NULLS FIRST LIMIT 10"""

SELECTS["top_customers_filtered"] = f"""
  SELECT customer_id, first_name, last_name, state, city, loyalty_segment,
         {rnd('rev')} AS revenue, orders, {rnd(div('rev', 'orders'))} AS aov, last_order_date
  FROM (SELECT customer_id, first_name, last_name, state, city, loyalty_segment,
               {msum('line_revenue')} AS rev, count(DISTINCT order_number) AS orders,
               max(order_date) AS last_order_date
        FROM g_wide WHERE customer_id IS NOT NULL AND {_RANGE} AND {_STATES}
        GROUP BY customer_id, first_name, last_name, state, city, loyalty_segment)
  ORDER BY revenue DESC, customer_id LIMIT 25"""

SELECTS["kpi_mom_filtered"] = f"""
  SELECT year_month, {rnd('revenue')} AS revenue, {pct('revenue', 'prev_revenue')} AS revenue_mom_pct,
         orders, {pct('orders', 'prev_orders')} AS orders_mom_pct,
         {rnd('aov')} AS aov, {pct('aov', 'prev_aov')} AS aov_mom_pct,
         unique_customers, {pct('unique_customers', 'prev_customers')} AS customers_mom_pct
  FROM (SELECT *, lag(revenue) OVER w AS prev_revenue, lag(orders) OVER w AS prev_orders,
               lag(aov) OVER w AS prev_aov, lag(unique_customers) OVER w AS prev_customers
        FROM (SELECT *, {div('revenue', 'orders')} AS aov FROM (
                SELECT year_month, {msum('total_revenue')} AS revenue,
                       CAST(SUM(orders) AS BIGINT) AS orders,
                       CAST(SUM(unique_customers) AS BIGINT) AS unique_customers
                FROM g_agg
                WHERE year_month BETWEEN '1997-01' AND '1998-12' AND {_STATES} AND {_TIERS}
                GROUP BY year_month))
        WINDOW w AS (ORDER BY year_month ASC NULLS FIRST))"""


# --- single operators before the DQ gate -------------------------------------------
SELECTS["customers_name_split"] = """
  SELECT customer_id, customer_name, first_name, last_name FROM s_customers_all"""
SELECTS["customers_address"] = """
  SELECT customer_id, number, street, unit, street_address FROM s_customers_all"""
SELECTS["customers_validity_dates"] = """
  SELECT customer_id, valid_from, valid_to FROM s_customers_all"""
SELECTS["dedup_latest_order"] = """
  SELECT order_number, customer_id, customer_name, order_ts, order_date, number_of_line_items
  FROM s_orders_dedup"""
SELECTS["dedup_order_product"] = """
  SELECT * REPLACE (CASE WHEN NOT isnan(unit_price) THEN unit_price END AS unit_price,
                    CASE WHEN NOT isnan(line_revenue) THEN line_revenue END AS line_revenue)
  FROM s_lines_all"""


SELECTS["metric_customer_by_name"] = f"""
  SELECT customer_id, first_name, last_name, {rnd('rev')} AS revenue, orders,
         {rnd(div('rev', 'orders'))} AS aov
  FROM (SELECT customer_id, first_name, last_name, {msum('line_revenue')} AS rev,
               count(DISTINCT order_number) AS orders
        FROM g_wide
        WHERE lower(trim(first_name)) = 'customer#000000001' AND lower(trim(last_name)) = 'machinery'
          AND customer_id IS NOT NULL AND first_name IS NOT NULL AND last_name IS NOT NULL
        GROUP BY customer_id, first_name, last_name)"""


SELECTS["sample_customers"] = """
  SELECT customer_id, customer_name, first_name, last_name, state, valid_from, valid_to
  FROM s_customers ORDER BY customer_id LIMIT 10"""


SELECTS["order_documents_parsed"] = SELECTS["explode_orders"]

SELECTS["orders_point_in_time"] = f"""
  SELECT o.order_number, o.customer_id, o.at, h.city, h.version
  FROM (SELECT order_number, customer_id, TIMESTAMP '2026-01-01 00:00:00'
               + to_seconds((length(order_number) + CAST(customer_id AS BIGINT)) % 4 * 43200 - 129600) AS at
        FROM s_orders WHERE customer_id IS NOT NULL) o
  LEFT JOIN (SELECT customer_id, city, valid_from, lead(valid_from) OVER w AS valid_to,
                    CAST(row_number() OVER w AS INTEGER) AS version
             FROM (SELECT customer_id, city, CASE WHEN older = 1 THEN TIMESTAMP '2025-12-31 00:00:00'
                                                  ELSE TIMESTAMP '2026-01-01 00:00:00' END AS valid_from
                   FROM b_customers WHERE customer_id IS NOT NULL)
             WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from)) h
    ON h.customer_id = o.customer_id AND o.at >= h.valid_from AND (h.valid_to IS NULL OR o.at < h.valid_to)"""


# --- the quarantine with its payloads ------------------------------------------------
def _payload(**columns: str) -> str:
    """Compact JSON object without the NULL members."""
    parts = ", ".join(f"'{name}', {expr}" for name, expr in columns.items())
    return f"CAST(json_merge_patch('{{}}', json_object({parts})) AS VARCHAR)"


def _plain(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _day(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d')"


def _number(name: str) -> str:
    return (f"CASE WHEN isnan({name}) THEN 'NaN' WHEN isinf({name}) THEN 'Infinity' "
            f"ELSE CAST(CAST(CAST({name} AS VARCHAR) AS DECIMAL(38,10)) AS VARCHAR) END")


_ENTITIES = {
    "customers": ("s_customers_tagged", {
        **_plain("customer_id", "customer_name", "first_name", "last_name", "state", "city", "postcode", "region",
                 "district", "street", "number", "unit", "street_address", "ship_to_address"),
        "lat": _number("lat"), "lon": _number("lon"), **_plain("units_purchased", "loyalty_segment"),
        "valid_from": _day("valid_from"), "valid_to": _day("valid_to")}),
    "products": ("s_products_tagged", {
        **_plain("product_id", "product_category", "product_name"), "unit_price": _number("unit_price"),
        **_plain("ean13", "ean5", "product_unit")}),
    "loyalty_segments": ("s_loyalty_tagged", {
        **_plain("loyalty_segment_id", "loyalty_segment_description", "unit_threshold"),
        "valid_from": _day("valid_from"), "valid_to": _day("valid_to"), **_plain("loyalty_segment_label")}),
    "orders": ("(SELECT *, NULL AS corrupt_document FROM s_orders_tagged WHERE reason <> 'bad_document' UNION ALL "
               "SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'bad_document', '{\"order_number\": \"B' || n_nationkey || "
               "'\", \"customer_id\": ' FROM nation WHERE n_nationkey < 2)", {
        **_plain("order_number", "customer_id", "customer_name"),
        "order_ts": "strftime(order_ts, '%Y-%m-%d %H:%M:%S')", "order_date": _day("order_date"),
        **_plain("number_of_line_items", "corrupt_document")}),
    "order_line_items": ("s_lines_tagged", {
        **_plain("order_number", "customer_id"), "order_date": _day("order_date"),
        "order_ts": "strftime(order_ts, '%Y-%m-%d %H:%M:%S')",
        **_plain("product_id", "product_name_snapshot"), "unit_price": _number("unit_price"),
        **_plain("quantity", "currency"), "line_revenue": _number("line_revenue")}),
}
SELECTS["dq_quarantine"] = " UNION ALL ".join(f"""
  SELECT '{entity}' AS entity, reason, {_payload(**columns)} AS payload, {BATCH} AS batch_id,
         TIMESTAMP '2026-01-01 00:00:00' AS run_ts
  FROM {source} WHERE reason IS NOT NULL""" for entity, (source, columns) in _ENTITIES.items())


# --- the same figures from the cube and its bitmaps: counted in the lines here ----
SELECTS["kpi_mom_rolled_up"] = SELECTS["kpi_mom_exact"]
SELECTS["top_states_rolled_up"] = SELECTS["top_states_exact"]
SELECTS["metric_state_aov_rolled_up"] = SELECTS["metric_state_aov"]
SELECTS["metric_tier_counts_rolled_up"] = f"""
  SELECT loyalty_segment, product_category, {rnd('rev')} AS revenue, orders, customers,
         {rnd(div('rev', 'orders'))} AS aov
  FROM (SELECT loyalty_segment, product_category, {msum('line_revenue')} AS rev,
               count(DISTINCT order_number) AS orders, count(DISTINCT customer_id) AS customers
        FROM g_wide WHERE year IN ({', '.join(map(str, DASH_YEARS))})
          AND loyalty_segment IS NOT NULL AND product_category IS NOT NULL
        GROUP BY loyalty_segment, product_category)"""


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sel) for name, sel in SELECTS.items()}
