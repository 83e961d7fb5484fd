"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Separators of words: space, \t, \n, \v, \f, \r. The same set that bytes.split() uses.
SPACES = " \t\n\x0b\x0c\r"
SPACES_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; null or blank text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACES_RE, -1))


def n_words(text: Column) -> Column:
    """Number of words, as long; null text has 0."""
    return F.size(words(text)).cast("long")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value``, which is evaluated once.

    A column that a lambda refers to is evaluated again for every element; a
    lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def give_back() -> None:
    """Memory that this process has freed, back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):      # glibc
        trim(0)


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task`` (batches to batches) that gives its memory back when it ends: the
    process is kept for later tasks, and would hold the most it ever used beside
    the JVM of a stage without Python."""
    def each(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            give_back()
    return each


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a session in one process (tests) gets a scratch folder;
    on a cluster that is an error, because one machine's folder is not shared.
    """
    at = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="auric-llm-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


class Scratch:
    """Tables that operators write on the way, while this is open in a thread.

    ``delete`` removes exactly those: the caller says when nothing reads them
    any more, which is after it has written the result. Tables written outside
    any open one, or in another, stay.
    """

    _open: ContextVar[tuple["Scratch", ...]] = ContextVar("auric-llm-scratch", default=())

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tables = spark, [], []

    def __enter__(self) -> "Scratch":
        self._before = self._open.set((*self._open.get(), self))
        return self

    def __exit__(self, *_) -> None:
        self._open.reset(self._before)

    @classmethod
    def note(cls, path: str, table_name: str | None = None) -> None:
        for scratch in cls._open.get()[-1:]:
            scratch.paths.append(path)
            scratch.tables += [table_name] if table_name else []

    def delete(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in self.paths:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
        self.paths, self.tables = [], []


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage
    with files that outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    Scratch.note(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``saved``, bucketed by ``key``: grouping by it needs no shuffle of what
    is read again."""
    spark = df.sparkSession
    run = uuid.uuid4().hex
    path, table_name = f"{shared_dir(spark)}/{name}-{run}", f"auric_{name}_{run}"
    Scratch.note(path, table_name)
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(table_name)
    return spark.table(table_name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a long, b long).

    Returns (node, component): every node that has an edge, with the smallest
    node it reaches. Alternating large-star and small-star rounds until the
    edges no longer change; each round is written to the shared folder, the
    driver sees a count and a checksum. A node with very many neighbours is
    pre-aggregated for its minimum, and the join back is one that adaptive
    execution can split. Self loops and repeated edges do no harm.
    """
    e = (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
              .filter("a <> b").distinct())
    e = saved(e, "cc-edges")
    before = None
    for _ in range(max_rounds):
        e = saved(_star(e, large=True), "cc-large")
        e = saved(_star(e, large=False), "cc-small")
        now = e.agg(F.count(F.lit(1)),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    found = e.groupBy("a").agg(F.min("b").alias("component"))
    roots = e.select(F.col("b").alias("a"), F.col("b").alias("component")).distinct()
    return found.unionByName(roots).select(F.col("a").alias("node"), "component")


def _star(e: DataFrame, large: bool) -> DataFrame:
    """One star step. large: every larger neighbour of a node moves to the
    node's smallest neighbour; small: every smaller one does."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
    least = saved(both.groupBy("a").agg(F.min("b").alias("m"))
                  .select("a", F.least("a", "m").alias("m")), "cc-least")
    joined = both.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select("b", "m").union(least).toDF("a", "b")
    return out.filter("a <> b").distinct()
