"""Spark results against the DuckDB oracle (a representative subset at
sf0.001; tools/check_oracle.py runs every query), plus the operators whose
output is text or history."""

import datetime as dt
import json

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from auric.operators.enrich import enrich, word_count_stub
from auric.operators.history import point_in_time_join, scd2_history

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SUBSET = ["silver_line_items", "dq_summary", "dq_warn_counts", "agg_sales_monthly", "kpi_mom",
          "top_products", "dash_kpi", "metric_month_compare", "heatmap_pivot",
          "customer_history", "dq_quarantine", "fact_sales", "order_documents_parsed", "dashboard_page",
          "orders_point_in_time"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(cur.fetchall(), dcols)


def test_every_oracle_has_a_query_and_entry_runs(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    out = entry.entry(spark)
    assert out.count() == 10 and "revenue" in out.columns


def test_prompts_are_single_rows_with_json(spark):
    q = entry.queries()
    row = q["prompts_monthly"](spark, SF).first()
    data = json.loads(row.prompt.split(": ", 1)[1])
    assert row.months == len(data) == 6
    assert [d["year_month"] for d in data] == sorted(d["year_month"] for d in data)
    assert "E" not in data[0]["revenue"]          # plain decimal text, no exponent
    states = q["prompts_states"](spark, SF).collect()
    assert len(states) == 5 and all(json.loads(r.prompt.split(": ", 1)[1])["state"] == r.state
                                    for r in states)


def test_enrich_keeps_rows_and_reports_errors(spark):
    df = spark.createDataFrame([(i, None if i == 3 else f"p {i}") for i in range(10)],
                               "id int, prompt string").repartition(3)

    def flaky(prompts):
        if any(p == "p 7" for p in prompts):
            raise RuntimeError("endpoint down")
        return [p.upper() for p in prompts]

    out = {r.id: r for r in enrich(df, "prompt", "answer", flaky, batch_size=1).collect()}
    assert len(out) == 10
    assert out[1].answer == "P 1" and out[1].answer_error is None
    assert out[3].answer is None and out[3].answer_error is None
    assert out[7].answer is None and "endpoint down" in out[7].answer_error
    stub = enrich(df, "prompt", "a", word_count_stub).filter(F.col("a").isNotNull()).count()
    assert stub == 9


def test_scd2_history_and_point_in_time(spark):
    t = lambda d: dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc)
    changes = spark.createDataFrame([
        ("c1", "Zagreb", t(1)), ("c1", "Zagreb", t(2)), ("c1", "Split", t(5)),
        ("c1", "Split", t(5)), ("c2", "Rijeka", t(3)), ("c2", None, t(4)), ("c2", None, t(6)),
    ], "id string, city string, ts timestamp")
    h = scd2_history(changes, "id", ["city"], "ts")
    rows = sorted(((r.id, r.city, r.valid_from.day, r.valid_to.day if r.valid_to else None,
                    r.is_current, r.version) for r in h.collect()), key=lambda x: (x[0], x[5]))
    assert rows == [("c1", "Zagreb", 1, 5, False, 1), ("c1", "Split", 5, None, True, 2),
                    ("c2", "Rijeka", 3, 4, False, 1), ("c2", None, 4, None, True, 2)]
    facts = spark.createDataFrame([("c1", t(3)), ("c1", t(9)), ("c2", t(2)), ("c3", t(3))],
                                  "id string, at timestamp")
    got = sorted(((r.id, r.at.day, r.city) for r in point_in_time_join(facts, h, "id", "at")
                  .collect()), key=lambda x: (x[0], x[1]))
    assert got == [("c1", 3, "Zagreb"), ("c1", 9, "Split"), ("c2", 2, None), ("c3", 3, None)]


def test_metric_query_aov_is_ratio_of_sums(lakehouse):
    from auric.plans.metrics import metric_query
    w = lakehouse.gold.wide_sales
    r = metric_query(w, ["revenue", "orders", "aov"], []).first()
    assert abs(r.aov - r.revenue / r.orders) < 0.01
    with pytest.raises(ValueError):
        metric_query(w, ["margin"])


def test_array_parameters_equal_lists(lakehouse):
    from auric.plans import reports as R
    agg = lakehouse.gold.agg_sales_monthly
    array = lambda v: F.array(*[F.lit(x) for x in v]).cast("array<int>")
    for years, months in (((), ()), ((1997, 1999), (1, 2, 3)), ((1996,), ())):
        for build in (R.dash_kpi, R.dash_trend, R.dash_heatmap):
            a, b = build(agg, years, months), build(agg, array(years), array(months))
            assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_every_rule_fires(spark):
    """The fixture's dirt reaches every blocking and every warn rule."""
    from auric.operators import silver as S
    from auric.sources.fixtures import FIXTURE_CTX
    q = entry.queries()
    fired = {(r.entity, r.reason) for r in q["dq_blocking_counts"](spark, SF).collect()}
    rules = {"customers": S.customer_rules(), "products": S.product_rules(), "loyalty_segments": S.loyalty_rules(),
             "orders": S.order_rules(FIXTURE_CTX), "order_line_items": S.line_rules()}
    # bad_row needs a CSV file: test_rows_that_do_not_fit_their_header_are_quarantined
    assert fired == {(e, r) for e, own in rules.items() for r in own if r != "bad_row"}
    assert all(r.rows > 0 for r in q["dq_warn_counts"](spark, SF).collect())


def test_enrich_changes_no_other_value(spark):
    df = spark.createDataFrame([(9007199254740993, "a"), (None, "b"), (3, None)], "id bigint, prompt string")
    out = enrich(df, "prompt", "answer", word_count_stub)
    assert sorted(map(str, (r.id for r in out.collect()))) == ["3", "9007199254740993", "None"]


def test_write_counts_are_observed(spark, scratch):
    from auric.sinks.tables import WRITE_COUNTS, overwrite_table, sample_rows
    overwrite_table(spark.range(123), "default.observed_t")
    assert WRITE_COUNTS["default.observed_t"] == 123
    assert sample_rows(spark, "default.observed_t", 5, ["id"]).count() == 5
