"""What a task or a cell holds does not grow with the whole input."""

from pyspark.sql import functions as F

from auric.context import configure_session
from auric.operators.distinct import WORD, agg_sales_distinct, count_distinct, cube_with_distinct
from auric.operators.gold import AGG_KEYS, agg_sales_monthly
from auric.plans import reports as R

WIDE = ("year_month string, year int, month int, state string, product_category string, loyalty_segment string, "
        "order_number string, customer_id string")


def test_a_cell_has_words_for_its_own_orders_only(spark):
    cell = ("1997-01", 1997, 1, "AB")
    orders = [(*cell, "thing", "Gold", f"o{i}", f"c{i % 700}") for i in range(3000)]
    few = [(*cell, "rare", "Gold", f"o{i}", f"c{i}") for i in (0, 1, 1)]                   # a line twice
    odd = [(*cell, None, "Gold", None, "c1"), (*cell, None, "Gold", "o5", None), (*cell, None, None, "x", None)]
    wide = spark.createDataFrame(orders + few + odd, WIDE).repartition(7)
    numbers = spark.range(1, 701).select(F.concat(F.lit("c"), (F.col("id") - 1).cast("string")).alias("customer_id"),
                                         (F.col("id") % 4).cast("int").alias("part"), F.ceil(F.col("id") / 4).cast("int").alias("number"))
    bits = agg_sales_distinct(wide, numbers)
    assert dict(bits.dtypes)["bits"] == "bigint"                        # a bitmap of one word, not of 4 KB
    rows = bits.collect()
    assert sum(r.product_category == "rare" and r.entity == "orders" for r in rows) <= 2
    assert max(r.bucket for r in rows) >= 2                             # 3,000 orders fill more than two words of a part
    assert sum(bin(r.bits & (1 << WORD) - 1).count("1") for r in rows if r.entity == "orders") == 3000 + 2 + 1 + 1
    got = lambda entity, *dims: sorted(map(tuple, count_distinct(bits, entity, dims).collect()), key=repr)
    assert got("orders") == [(3001,)] and got("customers") == [(700,)]
    assert got("orders", "product_category") == sorted([("thing", 3000), ("rare", 2), (None, 2)], key=repr)
    assert got("customers", "product_category") == sorted([("thing", 700), ("rare", 2), (None, 1)], key=repr)


def test_orders_are_dealt_once_for_their_bitmaps(spark):
    wide = spark.createDataFrame([("1997-01", 1997, 1, "AB", "thing", "Gold", "o1", "c1")], WIDE)
    numbers = spark.createDataFrame([("c1", 0, 1)], "customer_id string, part int, number int")
    plan = count_distinct(agg_sales_distinct(wide, numbers), "orders", ["year_month"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2                 # by home and part, then by month


def test_a_task_reads_a_bounded_part_of_a_shuffle(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        configure_session(spark)
        assert spark.conf.get(key) == str(16 << 20)
        spark.conf.set(key, "8m")                                       # a session's own value stays
        configure_session(spark)
        assert spark.conf.get(key) == "8m"
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def test_customers_of_a_name_are_counted_before_the_lines_are_joined(spark):
    from auric.plans.catalog import QUERIES
    plan = QUERIES["metric_customer_by_name"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.split("\n") if "REPARTITION_BY_COL" in line]
    assert len(dealt) == 1 and "customer_id" in dealt[0] and "customer_name" in dealt[0]


def test_the_cube_and_its_bitmaps_deal_the_lines_once(spark):
    """Joined and dealt by product, by customer, then by home and part: once each,
    whatever the cube, the orders and the customers each read of them."""
    from auric.plans.catalog import QUERIES
    own = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for name, uses in (("kpi_mom_rolled_up", 3), ("top_states_rolled_up", 2), ("metric_state_aov_rolled_up", 2),
                           ("metric_tier_counts_rolled_up", 3)):
            df = QUERIES[name](spark, "/root/testdata/sf0.001")
            for k, v in own.items():                                    # the query's session settings come before
                spark.conf.set(k, v)
            plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
            found = lambda *texts: [line for line in plan if all(t in line for t in texts)]
            assert len(found("SortMergeJoin [product_id")) == 1, name
            assert len([line for line in found("SortMergeJoin [customer_id") if "numbered_id" not in line]) == 1, name
            dealt = found("Exchange hashpartitioning(year_month", "year#", "part#", "REPARTITION_BY_COL")
            assert [("ReusedExchange" in line) for line in dealt] == [False] + [True] * (uses - 1), name
            # order lines are dealt as the numbers they are read as, not as lists of text
            below = [plan[i + 1] for i, line in enumerate(plan) if "Exchange hashpartitioning(l_orderkey" in line]
            assert len(below) == 1 and "Aggregate" not in below[0], name
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_dealt_lines_give_the_same_cube_and_counts(spark):
    cell = ("1997-01", 1997, 1, "AB")
    wide = spark.createDataFrame(
        [(*cell, f"k{i % 5}", "Gold", f"o{i // 4}", f"c{i // 4 % 9}", i / 7, i % 3) for i in range(400)]
        + [("1997-02", 1997, 2, "AB", f"k{i % 2}", "Gold", f"p{i // 4}", f"c{i // 4 % 9}", 1.5, 1) for i in range(40)]
        + [(*cell, "k1", "Gold", "o1", "c1", 2.0, 4)] * 2                                    # a line twice
        + [(*cell, None, "Gold", "o1", "c1", 1.0, 1), (*cell, None, None, "x", None, 1.0, None),
           (*cell, "k1", "Gold", None, "c1", 1.0, 1), (*cell, "k1", "Gold", "o2", "c2", None, 1),
           (None, None, None, None, None, None, "y", None, float("nan"), 1)],
        WIDE + ", line_revenue double, quantity int").repartition(5)
    numbers = spark.range(9).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_id"),
                                    (F.col("id") % 2).cast("int").alias("part"), (F.floor(F.col("id") / 2) + 1).cast("int").alias("number"))
    agg, bits = cube_with_distinct(wide, numbers)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(agg) == rows(agg_sales_monthly(wide))
    for dims in ((), ("year_month",), ("state", "product_category"), AGG_KEYS):
        for entity, column in (("orders", "order_number"), ("customers", "customer_id")):
            want = wide.groupBy(*dims).agg(F.count_distinct(column).alias("n")).filter("n > 0")
            assert rows(count_distinct(bits, entity, dims)) == rows(want), (dims, entity)
    assert rows(R.kpi_mom_rolled_up(agg, bits)) == rows(R.kpi_mom_exact(wide.withColumn("order_date", F.lit(None).cast("date"))))
