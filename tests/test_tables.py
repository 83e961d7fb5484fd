"""Overwrites and batch appends: what readers see, also when a step fails."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from auric.sinks import tables as T


def ids(df):
    return sorted(r.id for r in df.collect())


class Ended(RuntimeError):
    pass


@pytest.mark.parametrize("step", ["save", "SHOW TBLPROPERTIES", "CREATE OR REPLACE VIEW", "SHOW TABLES", "DROP TABLE"])
def test_an_end_between_any_two_steps_leaves_a_readable_table(spark, monkeypatch, step):
    name = f"default.ends_at_{step.split()[0].lower()}_{len(step)}"
    for n in (2, 3, 5):
        T.overwrite_table(spark.range(n).withColumn("m", F.lit("x")), name, partition_by=["m"])
    real = SparkSession.sql

    def sql(self, text, *args, **kwargs):
        if text.startswith(step):
            raise Ended(step)
        return real(self, text, *args, **kwargs)
    monkeypatch.setattr(SparkSession, "sql", sql)
    if step == "save":
        monkeypatch.setattr(T, "_publish", lambda *a: (_ for _ in ()).throw(Ended(step)))
    with pytest.raises(Ended):
        T.overwrite_table(spark.range(9).withColumn("m", F.lit("y")), name, partition_by=["m"])
    monkeypatch.undo()
    swapped = step in ("SHOW TABLES", "DROP TABLE")
    assert ids(spark.table(name)) == list(range(9 if swapped else 5))
    T.overwrite_table(spark.range(4), name)                         # another schema, no partitions
    assert ids(spark.table(name)) == [0, 1, 2, 3] and spark.table(name).columns == ["id"]


def test_a_reader_from_before_the_swap_finishes(spark):
    name = "default.swapped_t"
    T.overwrite_table(spark.range(5), name, "five")
    before = spark.table(name)
    T.overwrite_table(spark.table(name).filter("id < 2"), name, "two", {"id": "kept"})
    assert ids(before) == [0, 1, 2, 3, 4] and ids(spark.table(name)) == [0, 1]
    assert spark.table(name).schema["id"].metadata["comment"] == "kept"
    for n in range(3):
        T.overwrite_table(spark.range(n), name)
    assert len(T.published_versions(spark, name)) == 2 == len(T._versions(spark, name))


def test_old_orphans_go_and_new_ones_stay(spark, monkeypatch):
    name = "default.orphaned_t"
    T.overwrite_table(spark.range(5), name)
    spark.range(1).write.saveAsTable(f"{name}__v{0:020d}_00000000")      # never published, long ago
    new = f"{name}__v{T.time.time_ns():020d}_00000000"                   # another writer, a moment ago
    spark.range(1).write.saveAsTable(new)
    T.overwrite_table(spark.range(6), name)
    left = T._versions(spark, name)
    assert new in left and not any("__v0000000000" in v for v in left) and len(left) == 3
    T.drop_table(spark, name)
    assert not spark.catalog.tableExists(name) and not T._versions(spark, name)


def test_a_plain_table_of_before_is_taken_over(spark):
    spark.range(7).write.saveAsTable("default.plain_t")
    T.overwrite_table(spark.table("default.plain_t").filter("id > 3"), "default.plain_t")
    assert ids(spark.table("default.plain_t")) == [4, 5, 6]


def test_a_batch_is_replaced_by_nothing_too(spark):
    name = "default.batches_t"
    rows = spark.range(3).withColumn("x", F.lit("a"))
    T.append_batch(rows, name, "b:1")
    T.append_batch(rows.withColumn("id", F.col("id") + 10), name, "b/2 '%")
    assert ids(spark.table(name)) == [0, 1, 2, 10, 11, 12]
    before = spark.table(name).filter("batch_id = 'b:1'")
    before._jdf.queryExecution().executedPlan()             # a reader that has planned
    T.append_batch(rows.limit(0), name, "b:1")
    assert ids(spark.table(name)) == [10, 11, 12] and ids(before) == [0, 1, 2]
    T.append_batch(rows, name, "b:1", column="batch_id")
    assert T.vacuum_batches(spark, name, older_than_seconds=3600) == 0
    assert T.vacuum_batches(spark, name, older_than_seconds=0) == 2
    assert ids(spark.table(name)) == [0, 1, 2, 10, 11, 12]


def test_a_batch_that_fails_changes_nothing(spark):
    name = "default.failing_batches_t"
    T.append_batch(spark.range(3), name, "1")
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        T.append_batch(broken, name, "1")
    assert ids(spark.table(name)) == [0, 1, 2]
    assert ids(T.append_batch(spark.table(name).filter("id > 0").drop("batch_id"), name, "1")) == [1, 2]   # from itself


def test_columns_are_added_and_missing_ones_null(spark):
    name = "default.widened_t"
    T.append_batch(spark.range(1), name, "1")
    T.append_batch(spark.range(1).withColumn("more", F.lit(5)), name, "2")
    T.append_batch(spark.range(2, 3), name, "3")
    assert sorted((r.batch_id, r.more) for r in spark.table(name).collect() if r.more) == [("2", 5)]
    assert spark.table(name).count() == 3


def test_threads_append_to_tables_at_once(spark):
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")

    def work(k):
        name = f"default.threads_{k % 2}"
        T.append_batch(spark.range(k, k + 3), name, f"b{k}")
        T.append_batch(spark.range(k, k + 2), name, f"b{k}")
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(work, range(12)))
    for t in (0, 1):
        assert spark.table(f"default.threads_{t}").count() == 12
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
