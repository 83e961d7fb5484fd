"""Type-2 history of a dimension from a change feed, and point-in-time lookup.

The reference keeps its dimensions as type 1 (latest values only); these
operators are for when a change feed (repeated snapshots or CDC rows with a
change timestamp) is available.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auric.operators.dedup import keep_latest
from auric.sinks.tables import append_batch

# Facts of one key beyond which its time line is cut into ranges of their own.
SPLIT_ROWS = 1_000_000


def scd2_history(changes: DataFrame, key: str, tracked: Sequence[str], ts: str) -> DataFrame:
    """One row per version: key, tracked columns, valid_from, valid_to, is_current, version.

    A snapshot whose tracked values equal the previous version's (NULL-safe)
    adds no version. Several rows for one key at one timestamp are reduced
    to one first. The per-key windows see at most one row per snapshot of
    that key (the number of loads), not one per fact row, so a key's
    window stays small whatever the data volume.
    """
    tracked = list(tracked)
    one_per_ts = keep_latest(changes.select(key, ts, *tracked), [key, ts], [], tracked)
    w = Window.partitionBy(key).orderBy(F.col(ts).asc())
    values = F.struct(*tracked)
    changed = (one_per_ts
               .withColumn("_prev", F.lag(values).over(w))
               .filter(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(values))
               .drop("_prev"))
    return (changed
            .withColumn("valid_to", F.lead(ts).over(w))
            .withColumn("version", F.row_number().over(w))
            .select(key, *tracked, F.col(ts).alias("valid_from"), "valid_to",
                    F.col("valid_to").isNull().alias("is_current"), "version"))


# --- one more snapshot into a stored history ------------------------------------
def _same_key(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """``df`` semi- or anti-joined to ``keys`` (one column ``_k``), NULL-safe."""
    return df.join(keys, F.col(key).eqNullSafe(F.col("_k")), how)


def _merge_parts(history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], ts: str,
                 feed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(late keys, untouched closed rows, untouched current rows, new rows)."""
    tracked = list(tracked)
    columns = [key, *tracked, "valid_from", "valid_to", "is_current", "version"]
    history = history.select(*columns)
    current = history.filter("is_current")
    seen = snapshot.groupBy(F.col(key).alias("_k")).agg(F.min(ts).alias("_first"))
    keys = seen.select("_k")
    # The current row counts as a sighting too: the load may be one that ran before.
    seen_before = feed.select(key, ts).unionByName(current.select(key, F.col("valid_from").alias(ts)))
    sighted = _same_key(seen_before, keys, key, "left_semi").groupBy(F.col(key).alias("_key")).agg(
        F.max(ts).alias("_last"))
    # A row not after the last sighting of its key may change the key's past.
    late = seen.join(sighted, F.col("_k").eqNullSafe(F.col("_key")) & (F.col("_first") <= F.col("_last")),
                     "left_semi").select("_k")
    on_time = _same_key(snapshot.select(key, ts, *tracked), late, key, "left_anti")
    open_rows = _same_key(_same_key(current, keys, key, "left_semi"), late, key, "left_anti")
    base = open_rows.select(F.col(key).alias("_key"), (F.col("version") - 1).alias("_before"))
    again = scd2_history(open_rows.select(key, F.col("valid_from").alias(ts), *tracked).unionByName(on_time),
                         key, tracked, ts)
    touched = (again.join(base, F.col(key).eqNullSafe(F.col("_key")), "left")
                    .withColumn("version", (F.col("version") + F.coalesce("_before", F.lit(0))).cast("int"))
                    .select(*columns))
    past = feed.select(key, ts, *tracked).unionByName(snapshot.select(key, ts, *tracked))
    rebuilt = scd2_history(_same_key(past, late, key, "left_semi"), key, tracked, ts).select(*columns)
    return (late, _same_key(history.filter("not is_current"), late, key, "left_anti"),
            _same_key(current, keys, key, "left_anti"), touched.unionByName(rebuilt))


def scd2_merge(history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], ts: str,
               feed: DataFrame) -> DataFrame:
    """``history`` (as ``scd2_history`` returns it) after one more snapshot.

    Keys whose rows come after their last sighting meet their current row only;
    closed rows of theirs are passed on as they are. Keys with a late row (at or
    before a sighting in ``feed``, all snapshots loaded before) are rebuilt from
    ``feed``, because a late value may lie between two sightings of one version
    that the history no longer tells apart. Keys absent from the snapshot stay
    as they are. The result equals ``scd2_history`` over
    ``feed`` and ``snapshot`` together.
    """
    _, closed, still, new = _merge_parts(history, snapshot, key, tracked, ts, feed)
    return closed.unionByName(still).unionByName(new)


CURRENT = "current"


def load_snapshot(spark: SparkSession, table: str, feed_table: str, snapshot: DataFrame, key: str,
                  tracked: Sequence[str], ts: str, load_id: str, fmt: str = "parquet") -> DataFrame:
    """Load one snapshot into a stored history and return it.

    ``table`` is partitioned by ``load``: the open versions are the partition
    ``current``, and the versions that a load closed are a partition named by it.
    So a load writes its own partition and the current one; earlier partitions
    are rewritten only where they hold a key with a late row. ``feed_table``
    keeps every snapshot, partitioned by load. Running a load again, also after
    it was ended half way, gives the same history.
    """
    if load_id == CURRENT:
        raise ValueError(f"a load cannot be named {CURRENT!r}")
    tracked = list(tracked)
    snapshot = snapshot.select(key, ts, *tracked)
    feed = append_batch(snapshot, feed_table, load_id, fmt=fmt, column="load").filter(F.col("load") != load_id)
    if not spark.catalog.tableExists(table):
        first = scd2_history(feed.unionByName(snapshot.withColumn("load", F.lit(load_id))), key, tracked, ts)
        append_batch(first.filter("not is_current"), table, load_id, fmt=fmt, column="load")
        return append_batch(first.filter("is_current"), table, CURRENT, fmt=fmt, column="load")
    stored = spark.table(table).filter(F.col("load") != load_id)
    mine = spark.table(feed_table).filter(F.col("load") == load_id)
    late, _, still, new = _merge_parts(stored, mine, key, tracked, ts, feed)
    append_batch(new.filter("not is_current"), table, load_id, fmt=fmt, column="load")
    touched = [r["load"] for r in _same_key(stored.filter("not is_current"), late, key, "left_semi")
               .select("load").distinct().collect()]                    # names of loads
    rewrites = {name: _same_key(stored.filter(F.col("load") == name), late, key, "left_anti") for name in touched}
    for name, rows in rewrites.items():
        append_batch(rows, table, name, fmt=fmt, column="load")
    # The current partition comes last: until then a rerun starts from the same open versions.
    return append_batch(still.unionByName(new.filter("is_current")), table, CURRENT, fmt=fmt, column="load")


# --- the version in force at a time ---------------------------------------------
def _as_number(c: Column, kind: str) -> Column:
    """A time as a double, for cutting a time line into ranges."""
    if kind == "date":
        c = F.unix_date(c)
    elif kind.startswith("timestamp"):
        c = F.unix_micros(c.cast("timestamp"))
    return c.cast("double")


def point_in_time_join(facts: DataFrame, history: DataFrame, key: str, at: str | Column,
                       how: str = "left", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Attach to each fact the version of ``history`` valid at ``at``:
    ``valid_from <= at < valid_to`` (open-ended when valid_to is NULL).

    An as-of join: versions and facts are one stream, sorted by key and time,
    and the last version met is carried forward. Work and output grow with
    facts plus versions, however many versions a key has. A key with more than
    ``split_rows`` facts is cut into ranges of time that are sorted on their own;
    each range starts with the version in force there, handed over from the
    ranges before. Facts without a key or a time match nothing. Versions of one
    key are expected not to overlap (as ``scd2_history`` gives them); of those
    that start at one time, one is taken.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    own = [c for c in history.columns if c != key]
    names = [c if c not in facts.columns else f"h_{c}" for c in own]
    f = facts.select(F.col(key).alias("k"), (F.col(at) if isinstance(at, str) else at).alias("t"),
                     F.struct(*facts.columns).alias("fact"))
    v = history.filter(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col(key).alias("k"), F.col("valid_from").alias("t"),
        F.struct(*(F.col(c).alias(f"v{i}") for i, c in enumerate(own)), F.col("valid_to").alias("until")).alias("version"))
    kind = dict(f.dtypes)["t"]
    whole = f.filter(F.col("k").isNotNull() & F.col("t").isNotNull())

    # Hot keys (at most one for every split_rows facts) and their ranges of time.
    hot = (whole.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min(_as_number(F.col("t"), kind)).alias("lo"),
                                  F.max(_as_number(F.col("t"), kind)).alias("hi"))
                .filter(F.col("n") > split_rows)
                .select(F.col("k").alias("hot_k"), "lo", F.ceil(F.col("n") / split_rows).cast("int").alias("ranges"),
                        F.greatest((F.col("hi") - F.col("lo")) / F.ceil(F.col("n") / split_rows), F.lit(1e-9)).alias("width")))

    def ranged(rows: DataFrame) -> DataFrame:
        number = _as_number(F.col("t"), dict(rows.dtypes)["t"])
        place = F.least(F.greatest(F.floor((number - F.col("lo")) / F.col("width")), F.lit(0)),
                        F.col("ranges") - 1).cast("int")
        return rows.join(hot, F.col("k") == F.col("hot_k"), "left").withColumn("part", F.coalesce(place, F.lit(0)))

    versions = ranged(v)
    # The last version of each range of a hot key, carried to the ranges after it.
    every = hot.select(F.col("hot_k").alias("k"), F.explode(F.sequence(F.lit(0), F.col("ranges") - 1)).alias("part"))
    lasts = (versions.filter(F.col("hot_k").isNotNull()).groupBy("k", "part")
                     .agg(F.max_by("version", "t").alias("last")))
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (every.join(lasts, ["k", "part"], "left")
                    .withColumn("version", F.last("last", ignorenulls=True).over(before))
                    .filter(F.col("version").isNotNull()))
    time, fact, version = (dict(whole.unionByName(v, allowMissingColumns=True).dtypes)[c] for c in ("t", "fact", "version"))
    none = lambda kind: F.lit(None).cast(kind)
    stream = (carried.select("k", "part", none(time).alias("t"), F.lit(0).alias("kind"), "version", none(fact).alias("fact"))
              .unionByName(versions.select("k", "part", F.col("t").cast(time).alias("t"), F.lit(1).alias("kind"), "version",
                                           none(fact).alias("fact")))
              .unionByName(ranged(whole).select("k", "part", F.col("t").cast(time).alias("t"), F.lit(2).alias("kind"),
                                                none(version).alias("version"), "fact")))
    upto = (Window.partitionBy("k", "part").orderBy(F.col("t").asc_nulls_first(), "kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = stream.withColumn("met", F.last("version", ignorenulls=True).over(upto)).filter("kind = 2")
    valid = F.col("met").isNotNull() & (F.col("met.until").isNull() | (F.col("t") < F.col("met.until")))
    met = met.select("fact", F.when(valid, F.col("met")).alias("met"))
    if how == "inner":
        met = met.filter(F.col("met").isNotNull())
    else:
        met = met.unionByName(f.filter(F.col("k").isNull() | F.col("t").isNull()).select(
            "fact", none(version).alias("met")))
    return met.select(*(F.col("fact").getField(c).alias(c) for c in facts.columns),
                      *(F.col("met").getField(f"v{i}").alias(name) for i, name in enumerate(names)))
