"""Bitmaps beside the cube, aggregate navigation, the page in one pass, stored
enrichment."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from auric.operators.distinct import agg_sales_distinct, count_distinct, customer_numbers
from auric.operators.enrich import enrich_stored
from auric.operators.gold import AGG_KEYS
from auric.plans import metrics as M
from auric.plans import reports as R


@pytest.fixture(scope="module")
def stored(spark, lakehouse, scratch):
    g = lakehouse.gold
    frames = {"wide": g.wide_sales, "agg": g.agg_sales_monthly,
              "distinct": agg_sales_distinct(g.wide_sales, customer_numbers(g.dim_customer, g.dim_loyalty_segment))}
    out = {}
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{scratch}/rollup/{name}")
        out[name] = spark.read.parquet(f"{scratch}/rollup/{name}")
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bitmaps_count_exactly_for_every_grouping(stored):
    columns = {"orders": "order_number", "customers": "customer_id"}
    for dims in [(), *itertools.combinations(AGG_KEYS, 1), ("year_month", "product_category"), ("state", "loyalty_segment"),
                 ("year", "state", "product_category"), AGG_KEYS]:
        for entity, column in columns.items():
            want = stored["wide"].groupBy(*dims).agg(F.count_distinct(column).alias("n")).filter("n > 0")
            assert rows(count_distinct(stored["distinct"], entity, dims)) == rows(want), (dims, entity)


def test_bitmaps_count_exactly_under_filters(stored):
    for where in ("product_category is not null and year = 1997", "state in ('AB', 'BC')", "month < 4 or loyalty_segment = 'Gold'"):
        for entity, column in (("orders", "order_number"), ("customers", "customer_id")):
            want = stored["wide"].filter(where).groupBy("year").agg(F.count_distinct(column).alias("n")).filter("n > 0")
            assert rows(count_distinct(stored["distinct"].filter(where), entity, ["year"])) == rows(want)


def test_questions_that_the_cube_answers_read_no_line(spark, stored, scratch):
    cube = M.Cube(stored["agg"], stored["distinct"])
    lines = f"{scratch}/rollup/wide"
    for build in (lambda c: M.trend_last_months(stored["wide"], stored["agg"], 12),
                  lambda c: M.tier_month_over_month(stored["wide"], "Platinum", c),
                  lambda c: M.best_state_then_category(stored["wide"], "Platinum", c),
                  lambda c: M.states_by_aov(stored["wide"], cube=c),
                  lambda c: M.metric_query(stored["wide"], ["revenue", "orders", "customers", "aov"], ["state"],
                                           {"year": [1997], "loyalty_segment": ["Gold", "Silver"]}, cube=c)):
        df = build(cube)
        assert lines not in df._jdf.queryExecution().optimizedPlan().toString() and not any(
            "/rollup/wide" in f for f in df.inputFiles())
        if build is not None:
            assert rows(df) == rows(build(None)) or df.inputFiles() == build(None).inputFiles()


def test_other_questions_read_the_lines(stored):
    cube = M.Cube(stored["agg"])
    for kwargs in ({"dims": ["product_name"]}, {"filters": {"city": ["x"]}}, {"measures": ["orders"]},
                   {"where": F.col("quantity") > 2}, {"where": F.col("order_date") > "1997-01-01"}):
        kwargs = {"measures": ["revenue"], "dims": ["state"]} | kwargs
        df = M.metric_query(stored["wide"], cube=cube, **kwargs)
        assert any("/rollup/wide" in f for f in df.inputFiles()), kwargs
    counted = M.metric_query(stored["wide"], ["orders"], ["state"], cube=M.Cube(stored["agg"], stored["distinct"]))
    assert not any("/rollup/wide" in f for f in counted.inputFiles())


def test_the_page_is_one_scan_and_equals_its_datasets(stored):
    agg = stored["agg"]
    for years, months in (((1997, 1999), (1, 2, 3)), ((), ()), ((1800,), ())):
        page = R.dashboard_page(agg, years, months)
        assert page._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
        d = R.dashboard(agg, years, months)
        none = F.lit(None).cast("string")
        want = [("dash_kpi", none, none, F.col("total_revenue"), F.col("total_orders")),
                ("dash_trend", F.col("year_month"), F.col("loyalty_segment"), F.col("revenue"), F.lit(None)),
                ("dash_heatmap", F.col("product_category"), F.col("state"), F.col("revenue"), F.lit(None)),
                ("dash_years", F.col("year"), none, F.lit(None), F.lit(None)),
                ("dash_months", F.col("month"), none, F.lit(None), F.lit(None))]
        found = []
        for name, a, b, revenue, orders in want:
            found += rows(d[name].select(F.lit(name), a.cast("string"), b.cast("string"), revenue.cast("double"),
                                         orders.cast("long")))
        assert rows(page) == sorted(found, key=repr)
    array = lambda v: F.array(*[F.lit(x) for x in v]).cast("array<int>")
    assert rows(R.dashboard_page(agg, array((1997,)), array(()))) == rows(R.dashboard_page(agg, (1997,), ()))


def test_stored_answers_are_not_asked_again(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def model(fails):
        def fn(prompts):
            with open(calls, "a") as f:
                f.write("".join(f"{p}\n" for p in prompts))
            if any(p in fails for p in prompts):
                raise RuntimeError("endpoint down")
            return [p.upper() for p in prompts]
        return fn

    def asked():
        if not os.path.exists(calls):
            return []
        with open(calls) as f:
            found = f.read().split("\n")[:-1]
        os.remove(calls)
        return found
    df = spark.createDataFrame([(i, None if i == 3 else f"p{i % 20}") for i in range(60)], "id int, prompt string").repartition(4)
    run = lambda fn, **k: enrich_stored(df, "prompt", "answer", fn, "default.answers_t", batch_size=1, **k)
    first = {r.id: r for r in run(model({"p7"}), retries=2, round_prompts=6).collect()}
    sent = asked()
    assert sorted(set(sent)) == sorted({f"p{i}" for i in range(20)}) and sent.count("p7") == 3 and len(sent) == 22
    assert len(first) == 60 and first[3].answer is None and first[3].answer_error is None
    assert first[27].answer is None and "endpoint down" in first[27].answer_error and first[1].answer == "P1"
    second = {r.id: r.answer for r in run(model(set())).collect()}
    assert asked() == ["p7"] and second[7] == second[27] == "P7"
    assert {r.id: r.answer for r in run(model(set())).collect()} == second and asked() == []


def test_a_run_that_ends_loses_one_round(spark, tmp_path, monkeypatch):
    import auric.sinks.tables as T
    calls = str(tmp_path / "calls")

    def fn(prompts):
        with open(calls, "a") as f:
            f.write("".join(f"{p}\n" for p in prompts))
        return [p.upper() for p in prompts]
    df = spark.createDataFrame([(i, f"q{i}") for i in range(40)], "id int, prompt string")
    real, seen = T.append_batch, []

    def ending(frame, table, batch, **kwargs):
        seen.append(batch)
        if len(seen) == 5:
            raise RuntimeError("ended")
        return real(frame, table, batch, **kwargs)
    monkeypatch.setattr(T, "append_batch", ending)
    with pytest.raises(RuntimeError, match="ended"):
        enrich_stored(df, "prompt", "a", fn, "default.ended_t", round_prompts=10)
    monkeypatch.undo()
    kept = spark.table("default.ended_t").filter("answer is not null").count()
    assert 10 < kept < 35
    os.remove(calls)
    assert enrich_stored(df, "prompt", "a", fn, "default.ended_t").filter("a is null").count() == 0
    with open(calls) as f:
        assert len(f.read().split("\n")) - 1 == 40 - kept


def test_refreshed_months_equal_a_full_rebuild(spark):
    """Late, corrected and withdrawn orders, a customer who moves, new and
    renamed dimension rows."""
    from auric.plans import pipeline as P
    from auric.sinks.tables import overwrite_table, written_rows
    from auric.sources.fixtures import FIXTURE_CTX, bronze_from_testdata
    sf = "/root/testdata/sf0.001"
    layout, full = P.Layout("r_bronze", "r_silver", "r_gold"), P.Layout("r_bronze", "r_silver", "r_full")
    P.run_all(spark, bronze_from_testdata(spark, sf), FIXTURE_CTX, layout)
    names = ("dim_customer", "dim_product", "dim_loyalty_segment", "dim_date", "fact_sales", "wide_sales", "agg_sales_monthly")
    counts = {r.table_name: r.row_count for r in written_rows(spark, [f"r_gold.{n}" for n in names]).collect()}
    assert counts == {f"r_gold.{n}": spark.table(f"r_gold.{n}").count() for n in names}
    assert P.refresh_gold(spark, layout) == []                         # nothing changed
    before = spark.table("r_gold.wide_sales").inputFiles()
    lines = spark.table("r_silver.order_line_items")
    some = [r.order_number for r in lines.select("order_number").distinct().orderBy("order_number").limit(6).collect()]
    late = lines.filter(F.col("order_number") == some[0]).withColumns(
        {"order_number": F.lit("late-1"), "order_date": F.lit("1996-02-03").cast("date")})
    undated = lines.filter(F.col("order_number") == some[1]).withColumn("order_number", F.lit("new-1"))
    corrected = F.when(F.col("order_number") == some[2], F.col("line_revenue") + 1).otherwise(F.col("line_revenue"))
    overwrite_table(lines.filter(~F.col("order_number").isin(some[3], some[4])).withColumn("line_revenue", corrected)
                    .unionByName(late).unionByName(undated), "r_silver.order_line_items")
    months = P.refresh_gold(spark, layout)
    assert 0 < len(months) < spark.table("r_gold.dim_date").select("year_month").distinct().count() / 2
    P.run_gold(spark, full)

    def same(kinds):
        for name in kinds:
            a, b = spark.table(f"r_gold.{name}"), spark.table(f"r_full.{name}")
            assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name

    def same_counts():
        for dims in ([], ["year_month"], ["state"], ["product_category", "loyalty_segment"]):
            for entity in ("orders", "customers"):
                a, b = (rows(count_distinct(spark.table(f"{g}.agg_sales_distinct"), entity, dims)) for g in ("r_gold", "r_full"))
                assert a == b, (dims, entity)
    same(names)
    same_counts()
    kept = [f for f in before if not any(f"year_month={m}/" in f for m in months)]
    assert kept and set(kept) <= set(spark.table("r_gold.wide_sales").inputFiles())
    assert spark.table("r_gold.wide_sales").schema["line_revenue"].metadata.get("comment")

    customers = spark.table("r_silver.customers")
    first = customers.orderBy("customer_id").first().customer_id
    moved = customers.withColumn("state", F.when(F.col("customer_id") == first, "ZZ").otherwise(F.col("state")))
    new = moved.limit(1).withColumn("customer_id", F.lit("0000-new"))
    overwrite_table(moved.unionByName(new), "r_silver.customers")
    products = spark.table("r_silver.products")
    overwrite_table(products.withColumn("product_category", F.when(
        F.col("product_id") == products.first().product_id, "renamed").otherwise(F.col("product_category"))), "r_silver.products")
    P.refresh_gold(spark, layout)
    P.run_gold(spark, full)
    same(names)
    same_counts()
