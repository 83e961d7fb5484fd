import datetime as dt

from pyspark.sql import functions as F

from auric.functions import scalars as S


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_blank_to_null_and_is_blank(spark):
    df = spark.createDataFrame([("  x ",), ("   ",), ("",), (None,)], "v string")
    got = [r[0] for r in df.select(S.blank_to_null("v")).collect()]
    assert got == ["x", None, None, None]
    blanks = [r[0] for r in df.select(S.is_blank("v")).collect()]
    assert blanks == [False, False, True, True]   # no trimming: ' ' is not blank


def test_unix_to_date_accepts_scientific_notation_and_garbage(spark):
    df = spark.createDataFrame([("1.548137353E9",), ("1483228800",), ("",), ("abc",),
                                (None,), ("1e30",)], "v string")
    got = [r[0] for r in df.select(S.unix_to_date("v")).collect()]
    assert got == [dt.date(2019, 1, 22), dt.date(2017, 1, 1), None, None, None, None]


def test_split_last_first(spark):
    df = spark.createDataFrame([("SMITH,  SHIRLEY",), ("STEPHENS,GERALDINE M",),
                                ("NOCOMMA NAME",), ("A, B, C",), (None,)], "n string")
    last, first = S.split_last_first("n")
    got = [tuple(r) for r in df.select(last, first).collect()]
    assert got == [("SMITH", "SHIRLEY"), ("STEPHENS", "GERALDINE M"), (None, "NOCOMMA NAME"),
                   ("A", "B, C"), (None, None)]


def test_join_non_blank_all_blank_gives_empty_string(spark):
    r = one(spark, S.join_non_blank(" ", F.lit(" "), F.lit(None).cast("string"), F.lit("")),
            S.join_non_blank(" ", F.lit(" 12 "), F.lit("Main St"), F.lit(None).cast("string")))
    assert r[0] == "" and r[1] == "12 Main St"


def test_safe_div_and_pct_change(spark):
    r = one(spark, S.safe_div(F.lit(1.0), F.lit(0)), S.safe_div(F.lit(3.0), F.lit(2)),
            S.pct_change(F.lit(110), F.lit(100)), S.pct_change(F.lit(5), F.lit(0)),
            S.pct_change(F.lit(5), F.lit(None).cast("int")))
    assert r[0] is None and r[1] == 1.5 and r[2] == 10.0 and r[3] is None and r[4] is None


def test_round_half_up_on_decimal_looking_ties(spark):
    r = one(spark, S.round_half_up(F.lit(12.345), 2), S.round_half_up(F.lit(2.675), 2),
            S.round_half_up(F.lit(-1.005), 2), S.round_half_up(F.lit(None).cast("double"), 2))
    assert (r[0], r[1], r[2], r[3]) == (12.35, 2.68, -1.01, None)


def test_money_sum_is_exact_and_order_independent(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 1000
    df = spark.createDataFrame(vals, "x double")
    a = df.repartition(1).agg(S.money_sum("x")).first()[0]
    b = df.repartition(7).agg(S.money_sum("x")).first()[0]
    assert a == b == 600.0


def test_in_values_empty_means_no_filter_and_null_never_matches(spark):
    from auric.plans.reports import apply_filters
    df = spark.createDataFrame([(1,), (2,), (None,)], "y int")
    assert apply_filters(df, {"y": []}).count() == 3
    assert apply_filters(df, {"y": [1, 2]}).count() == 2
    assert apply_filters(df, None).count() == 3


def test_between_filter_and_multiselect_combine(spark):
    import datetime as dt
    from auric.plans.reports import Between, apply_filters
    df = spark.createDataFrame([(dt.date(2000, 1, d), s) for d in (1, 15, 31) for s in ("AB", "CD")],
                               "d date, state string")
    assert apply_filters(df, {"d": Between(dt.date(2000, 1, 10), None)}).count() == 4
    assert apply_filters(df, {"d": Between(None, dt.date(2000, 1, 15)),
                              "state": ["AB"]}).count() == 2
    assert apply_filters(df, {"d": Between(), "state": []}).count() == 6


def test_sizing_settings_scale_with_input():
    from auric.context import sizing_settings
    big = sizing_settings(100 * 1024 ** 4)            # 100 TiB
    assert int(big["spark.sql.shuffle.partitions"]) == 102400
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    assert int(sizing_settings(10 * 1024 ** 2)["spark.sql.shuffle.partitions"]) == 200


def test_configure_session_keeps_sizing_set_before(spark):
    from auric.context import configure_session
    before = spark.conf.get("spark.sql.shuffle.partitions")
    configure_session(spark, 10 * 1024 ** 4)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "10240"
    configure_session(spark)                      # base settings only
    assert spark.conf.get("spark.sql.shuffle.partitions") == "10240"
    for k in ("spark.sql.shuffle.partitions",
              "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes",
              "spark.sql.adaptive.coalescePartitions.parallelismFirst",
              "spark.sql.files.maxPartitionBytes"):
        spark.conf.unset(k)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sub_cent_amounts_decimal_integers_and_odd_prices(spark):
    from auric.functions.scalars import money_sum, not_money, unreadable_seconds, whole
    assert spark.range(1000).select(F.lit(0.004).alias("x")).agg(money_sum("x")).first()[0] == 4.0
    got = spark.createDataFrame([("34.0",), ("3",), ("x",), ("NaN",)], "v string").select(whole("v", "int").alias("w")).collect()
    assert [r.w for r in got] == [34, 3, None, None]
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1e18,), (0.0,), (-1.0,), (None,), (2.0,)], "p double")
    assert [r[0] for r in odd.select(not_money("p")).collect()] == [True] * 6 + [False]
    dates = spark.createDataFrame([("1.4E9",), ("",), (None,), ("1648137353000",), ("soon",)], "v string")
    assert [r[0] for r in dates.select(unreadable_seconds("v")).collect()] == [False, False, False, True, True]
