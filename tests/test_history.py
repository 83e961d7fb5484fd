"""As-of join and incremental type-2 history, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from auric.operators.history import load_snapshot, point_in_time_join, scd2_history, scd2_merge

DAY0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(n):
    return DAY0 + dt.timedelta(minutes=n)


def sorted_rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("split_rows", [1_000_000, 50, 7])
def test_as_of_join_is_the_range_join(spark, split_rows):
    rng = random.Random(split_rows)
    changes = spark.createDataFrame(
        [(f"k{rng.randint(0, 20)}", rng.choice(["a", "b", "c", None]), at(rng.randint(0, 300))) for _ in range(400)],
        "k string, city string, ts timestamp")
    history = scd2_history(changes, "k", ["city"], "ts")
    # gaps: some versions end before the next begins
    history = history.withColumn("valid_to", F.when(F.col("version") % 3 == 0, F.expr("valid_from + interval 1 minute"))
                                 .otherwise(F.col("valid_to"))).cache()
    facts = spark.createDataFrame(
        [(i, "k0" if i % 3 == 0 else rng.choice([None, "nobody", *(f"k{j}" for j in range(21))]),
          rng.choice([None, at(rng.randint(-5, 320)), at(rng.randint(-5, 320))])) for i in range(900)],
        "version int, k string, at timestamp")
    f, h = facts.alias("f"), history.alias("h")
    want = f.join(h, (F.col("f.k") == F.col("h.k")) & (F.col("f.at") >= F.col("h.valid_from"))
                  & (F.col("h.valid_to").isNull() | (F.col("f.at") < F.col("h.valid_to"))), "left").select(
        "f.*", "h.city", "h.valid_from", "h.valid_to", "h.is_current", F.col("h.version").alias("h_version"))
    got = point_in_time_join(facts, history, "k", "at", split_rows=split_rows)
    assert got.columns == want.columns
    assert sorted_rows(got, got.columns) == sorted_rows(want, want.columns)
    inner = point_in_time_join(facts, history, "k", F.col("at"), how="inner", split_rows=split_rows)
    assert sorted_rows(inner, got.columns) == sorted_rows(want.filter("valid_from is not null"), got.columns)


def test_a_hot_key_with_many_versions_is_linear(spark):
    """One key with a third of the facts and 10,000 versions: as many rows come
    out as facts went in, and no join pairs facts with versions."""
    versions = spark.range(10_000).select((F.col("id") % 1 + 1).alias("k"), (F.col("id") * 10).alias("valid_from"),
                                          (F.col("id") * 10 + 10).alias("valid_to"), F.col("id").alias("v"))
    facts = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("long").alias("k"),
                                       (F.col("id") * 7 % 100_000).alias("at"))
    got = point_in_time_join(facts, versions, "k", "at", split_rows=1000)
    assert got.count() == 90_000
    assert got.filter("k = 1 and (v is null or v <> floor(at / 10))").count() == 0
    assert got.filter("k <> 1 and v is not null").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "valid_from" not in "".join(
        line for line in plan.split("\n") if "Join" in line)


def feed(spark, rng, late):
    rows, loads = [], []
    for load in range(5):
        start = load * 100
        own = [(f"k{rng.randint(0, 15)}" if rng.random() < .95 else None, rng.choice(["a", "b", None]), rng.randint(0, 2),
                at(start + rng.randint(0, 90) - (rng.randint(50, 350) if late and rng.random() < .3 else 0)))
               for _ in range(25)]
        rows += own
        loads.append(spark.createDataFrame(own, "k string, city string, n int, ts timestamp"))
    return rows, loads


COLUMNS = ["k", "city", "n", "valid_from", "valid_to", "is_current", "version"]


@pytest.mark.parametrize("late", [False, True])
def test_merges_of_snapshots_equal_the_history_of_all(spark, late):
    rows, loads = feed(spark, random.Random(4 + late), late)
    every = spark.createDataFrame(rows, "k string, city string, n int, ts timestamp")
    want = sorted_rows(scd2_history(every, "k", ["city", "n"], "ts"), COLUMNS)
    history, seen = scd2_history(loads[0], "k", ["city", "n"], "ts"), loads[0]
    for snapshot in loads[1:]:
        history = spark.createDataFrame(scd2_merge(history, snapshot, "k", ["city", "n"], "ts", seen).collect(),
                                        history.schema)
        seen = seen.unionByName(snapshot)
    assert sorted_rows(history, COLUMNS) == want


@pytest.mark.parametrize("late", [False, True])
def test_stored_loads_equal_the_history_of_all_and_can_be_repeated(spark, late, monkeypatch):
    import auric.operators.history as H
    rows, loads = feed(spark, random.Random(8 + late), late)
    table, kept = f"default.scd_{late}", f"default.scd_feed_{late}"
    run = lambda n: load_snapshot(spark, table, kept, loads[n], "k", ["city", "n"], "ts", f"load{n}")
    for n in range(5):
        if n == 3:                      # ended after the first write to the history
            real, calls = H.append_batch, []

            def ending(df, to, *args, **kwargs):
                calls.append(to)
                if calls.count(table) == 2:
                    raise RuntimeError("ended")
                return real(df, to, *args, **kwargs)
            monkeypatch.setattr(H, "append_batch", ending)
            with pytest.raises(RuntimeError, match="ended"):
                run(n)
            monkeypatch.undo()
        run(n)
        if n in (1, 4):
            run(n)                      # again
        so_far = loads[0]
        for other in loads[1:n + 1]:
            so_far = so_far.unionByName(other)
        assert sorted_rows(spark.table(table), COLUMNS) == sorted_rows(scd2_history(so_far, "k", ["city", "n"], "ts"), COLUMNS)


def test_closed_partitions_are_left_alone_without_late_rows(spark):
    from auric.sinks.tables import _location
    _, loads = feed(spark, random.Random(20), False)
    for n, snapshot in enumerate(loads[:4]):
        load_snapshot(spark, "default.scd_still", "default.scd_still_feed", snapshot, "k", ["city", "n"], "ts", f"load{n}")
        if n == 2:
            before = _location(spark, "default.scd_still", "PARTITION (load = 'load1')")
    assert _location(spark, "default.scd_still", "PARTITION (load = 'load1')") == before
