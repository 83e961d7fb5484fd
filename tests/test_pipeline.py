import os

import pytest
from pyspark.sql import functions as F

from auric.context import RunContext
from auric.plans import pipeline as P
from auric.sinks.tables import published_versions
from auric.sources import readers
from auric.sources.fixtures import FIXTURE_CTX, bronze_from_testdata, source_files
from auric.sources.schemas import AUDIT_COLUMNS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written(spark):
    layout = P.Layout(bronze="t_bronze", silver="t_silver", gold="t_gold")
    names = P.run_all(spark, bronze_from_testdata(spark, SF), FIXTURE_CTX, layout)
    return layout, names


def test_tables_equal_lazy_plans(spark, written, lakehouse):
    layout, names = written
    assert len(names) == 4 + 7 + 9
    for name, df in lakehouse.gold.tables().items():
        stored = spark.table(f"{layout.gold}.{name}")
        assert stored.count() == df.count(), name
    wide = spark.table(f"{layout.gold}.wide_sales")
    assert wide.select(*lakehouse.gold.wide_sales.columns).exceptAll(
        lakehouse.gold.wide_sales).count() == 0
    lines = spark.table(f"{layout.silver}.order_line_items")
    assert lines.exceptAll(lakehouse.silver.order_line_items.clean).count() == 0


def test_dq_results_append_is_idempotent_per_batch(spark, written):
    layout, _ = written
    res = f"{layout.silver}.dq_results"
    assert spark.table(res).filter(F.col("batch_id") == FIXTURE_CTX.batch_id).count() == 5
    P.run_silver(spark, FIXTURE_CTX, layout)            # same batch again
    assert spark.table(res).count() == 5
    other = RunContext("second-batch", FIXTURE_CTX.run_ts, FIXTURE_CTX.as_of)
    P.run_silver(spark, other, layout)
    t = spark.table(res)
    assert t.count() == 10
    assert {r.batch_id for r in t.select("batch_id").distinct().collect()} == {
        FIXTURE_CTX.batch_id, "second-batch"}
    P.run_silver(spark, FIXTURE_CTX, layout)            # earlier batch re-run: others untouched
    assert spark.table(res).count() == 10


def test_comments_survive_overwrite(spark, written):
    layout, _ = written
    P.run_gold(spark, layout)                           # overwrite every gold table again
    wide = spark.table(f"{layout.gold}.wide_sales")
    assert wide.schema["line_revenue"].metadata.get("comment") == P.WIDE_COLUMN_COMMENTS["line_revenue"]
    desc = {r.col_name: r.data_type for r in
            spark.sql(f"DESCRIBE TABLE EXTENDED {layout.gold}.fact_sales").collect()}
    assert desc.get("Comment") == P.TABLE_COMMENTS["fact_sales"]


def test_wide_is_partitioned_by_month(spark, written):
    layout, _ = written
    parts = spark.sql(f"SHOW PARTITIONS {published_versions(spark, f'{layout.gold}.wide_sales')[0]}").count()
    months = spark.table(f"{layout.gold}.dim_date").select("year_month").distinct().count()
    assert 0 < parts <= months


def test_land_files_matches_direct_bronze(spark, scratch, lakehouse):
    """Write the fixture as the real source files (CSV, ';' CSV, JSON folder),
    land them through the readers, and get the same silver rows."""
    root = os.path.join(scratch, "sources")
    paths = source_files(spark, SF, root)
    layout = P.Layout(bronze="f_bronze", silver="f_silver", gold="f_gold")
    P.land_files(spark, paths, FIXTURE_CTX, layout)
    raw = spark.table(f"{layout.bronze}.customers_raw")
    assert set(AUDIT_COLUMNS) <= set(raw.columns)
    assert raw.filter(~F.col("_source_file").contains("customers")).count() == 0
    P.run_silver(spark, FIXTURE_CTX, layout)
    got = spark.table(f"{layout.silver}.order_line_items")
    assert got.exceptAll(lakehouse.silver.order_line_items.clean).count() == 0
    assert lakehouse.silver.order_line_items.clean.exceptAll(got).count() == 0
    prods = spark.table(f"{layout.silver}.products")
    assert prods.count() > 0 and prods.filter(F.length("ean5") != 5).count() == 0


def test_csv_is_read_by_header_and_keeps_every_column(spark, scratch):
    from auric.sources.schemas import CUSTOMER_COLUMNS
    root = os.path.join(scratch, "by_header")
    row = {c: f"<{c}>" for c in CUSTOMER_COLUMNS} | {"extra": "kept", "postcode": "00123"}
    order = sorted(row, reverse=True)
    spark.createDataFrame([tuple(row[c] for c in order)], order).coalesce(1).write.csv(root, header=True)
    got = readers.read_source(spark, "customers", root)
    assert got.columns == [*order, "corrupt_row"] and got.first().asDict() == row | {"corrupt_row": None}
    lacking = os.path.join(scratch, "lacking")
    got.drop("state", "corrupt_row").coalesce(1).write.csv(lacking, header=True)
    with pytest.raises(readers.MissingColumnsError, match="state"):
        readers.read_source(spark, "customers", lacking)


def test_files_that_order_columns_differently_are_not_mixed(spark, scratch):
    root = os.path.join(scratch, "mixed")
    os.makedirs(root)
    for i, text in enumerate(("loyalty_segment_id,valid_from\n1,2017-01-01\n", "valid_from,loyalty_segment_id\n2017-01-01,1\n")):
        with open(os.path.join(root, f"{i}.csv"), "w") as f:
            f.write(text)
    with pytest.raises(Exception):
        readers.read_loyalty_segments(spark, root).collect()


def test_json_documents_are_kept_whole_and_bad_ones_counted(spark, scratch):
    from auric.operators import silver
    from auric.sources.schemas import CORRUPT, RAW
    root = os.path.join(scratch, "documents")
    os.makedirs(root)
    lines = ['{"order_number": 1, "customer_id": "7", "order_datetime": 946684800, "note": {"a": 1}, '
             '"ordered_products": [{"id": "p", "price": 2.25, "qty": 3.0, "promo": "x"}]}',
             '{"order_number": 2, "customer', "not json at all"]
    with open(os.path.join(root, "a.json"), "w") as f:
        f.write("\n".join(lines))
    docs = readers.read_source(spark, "sales_orders", root)
    rows = {r[RAW]: r for r in docs.collect()}
    assert set(rows) == set(lines) and [rows[x][CORRUPT] for x in lines] == [None, *lines[1:]]
    assert rows[lines[0]].ordered_products[0].price == "2.25"
    orders = silver.prepare_orders(docs.withColumn("_ingest_ts", F.lit(FIXTURE_CTX.run_ts)))
    bad = silver.tag(orders, silver.order_rules(FIXTURE_CTX)).filter("_dq_reason = 'bad_document'")
    assert orders.count() == 3 and bad.count() == 2
    line = silver.explode_line_items(orders).first()
    assert (line.unit_price, line.quantity, line.line_revenue) == (2.25, 3, 6.75)


def test_failed_overwrite_leaves_the_old_table(spark):
    from auric.sinks.tables import overwrite_table
    overwrite_table(spark.range(5), "default.kept_t", "five", partition_by=())
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        overwrite_table(broken, "default.kept_t")
    assert spark.table("default.kept_t").count() == 5
    overwrite_table(spark.table("default.kept_t").filter("id > 2"), "default.kept_t")    # from itself
    assert sorted(r.id for r in spark.table("default.kept_t").collect()) == [3, 4]


def test_staging_tables_are_dropped_and_fact_is_stored_by_month(spark, written):
    layout, _ = written
    assert not [t.name for t in spark.catalog.listTables(layout.silver) if t.name.startswith("stage_")]
    assert spark.sql(f"SHOW PARTITIONS {published_versions(spark, f'{layout.gold}.fact_sales')[0]}").count() > 12
    wide = spark.table(f"{layout.gold}.wide_sales")
    assert all(f.metadata.get("comment") for f in wide.schema.fields)


def test_source_gate_names_every_missing_path(spark, scratch):
    with pytest.raises(readers.MissingSourcesError) as e:
        readers.check_sources(spark, {"a": os.path.join(scratch, "nope1"),
                                      "b": os.path.join(scratch, "nope2")})
    assert "a (" in str(e.value) and "b (" in str(e.value)


def test_required_columns_contract(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(readers.MissingColumnsError, match="customer_id"):
        readers.require_columns(df, ["customer_id"], "customers_raw")


def test_rerunning_a_stage_gives_equal_tables(spark, written):
    layout, _ = written
    before = {t: spark.table(f"{layout.silver}.{t}").collect()
              for t in ("customers", "orders", "order_line_items", "dq_quarantine")}
    P.run_silver(spark, FIXTURE_CTX, layout)
    for t, rows in before.items():
        again = spark.table(f"{layout.silver}.{t}")
        assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, rows), key=repr), t


def test_comments_must_name_existing_columns(spark):
    from auric.sinks.tables import overwrite_table
    with pytest.raises(ValueError, match="unknown columns"):
        overwrite_table(spark.range(3), "default.bad_comments", column_comments={"nope": "x"})


def test_inventory_lists_tables_counts_and_audit_columns(spark, written):
    from auric.sinks.tables import table_inventory
    layout, _ = written
    inv = {r.table_name: r for r in table_inventory(spark, layout.bronze).collect()}
    assert set(inv) == {"customers_raw", "products_raw", "loyalty_segments_raw",
                        "sales_orders_raw"}
    assert inv["customers_raw"].audit_columns == "_ingest_ts,_source_file,_batch_id"
    assert inv["customers_raw"].row_count == spark.table(f"{layout.bronze}.customers_raw").count()


def test_reports_over_stored_tables_equal_lazy_plans(spark, written, lakehouse):
    from auric.plans import metrics as M
    from auric.plans import reports as R
    from auric.plans.lakehouse import Lakehouse
    layout, _ = written
    stored = Lakehouse.from_tables(spark, layout)
    for build in (lambda g: R.kpi_mom(g.agg_sales_monthly), lambda g: R.top_products(g.wide_sales),
                  lambda g: M.latest_month_vs_previous(g.wide_sales, g.dim_date)):
        a = sorted(map(tuple, build(stored.gold).collect()), key=repr)
        b = sorted(map(tuple, build(lakehouse.gold).collect()), key=repr)
        assert a == b


def test_rows_that_do_not_fit_their_header_are_quarantined(spark, scratch):
    """Short, long and badly quoted rows of every CSV source reach the
    quarantine whole; none is cut to size, and good rows stay."""
    root = os.path.join(scratch, "bad_rows")
    paths = source_files(spark, SF, root)
    bad = {"customers": ["1,2,3", ",".join(str(i) for i in range(25)), '9,"open quote' + "," * 17],
           "products": ["7;only", "1;2;3;4;5;6;7;8;9", 'p9;"cat"x;n;1.5;e;f;u'],
           "loyalty_segments": ["5", "5,a,b,2017-01-01,2018-01-01,more", '6,"x,1,2017-01-01,']}
    clean = {}
    for name, lines in bad.items():
        clean[name] = readers.read_source(spark, name, paths[name]).filter("corrupt_row is null").count()
        folder = paths[name]
        header = readers.read_source(spark, name, folder).drop("corrupt_row").columns
        target = folder if os.path.isdir(folder) else os.path.dirname(folder)
        with open(os.path.join(target, "zz-bad.csv"), "w") as f:
            f.write((";" if name == "products" else ",").join(header) + "\n" + "\n".join(lines) + "\n")
    layout = P.Layout(bronze="bad_bronze", silver="bad_silver", gold="bad_gold")
    P.land_files(spark, paths, FIXTURE_CTX, layout)
    P.run_silver(spark, FIXTURE_CTX, layout)
    q = spark.table(f"{layout.silver}.dq_quarantine").filter("reason = 'bad_row'")
    assert {r.entity: r["count"] for r in q.groupBy("entity").count().collect()} == {n: 3 for n in bad}
    for name, lines in bad.items():
        payloads = " ".join(r.payload for r in q.filter(F.col("entity") == name).collect())
        for line in lines[:2]:
            assert line in payloads, (name, line)
        landed = spark.table(f"{layout.bronze}.{name}_raw")
        assert landed.filter("corrupt_row is null").count() == clean[name]
