"""Mixing sources to target weights by subset-sum budget fitting.

Sizes are exact token (word) counts. Each source has a target: its weighted
share of all sizes, at most ``cap`` times its own size. A source is taken
whole as often as the target allows; the rest of its budget is filled with a
subset of its documents whose sizes sum to it as exactly as possible:

1. count documents by (source, exact size);
2. per source, take the same share of every size, then single documents, until
   the remaining budget is small, then solve the remainder exactly by bounded
   knapsack dynamic programming over the sizes and their remaining counts;
3. the plan says how many documents of each size to take; which ones is
   decided by a seeded hash, so reruns agree. Rows that are equal are a lot:
   they are counted, and of the lot that the plan cuts through a number is
   taken.

One task plans one source from its size counts. Their number is the number of
distinct sizes, at most the square root of twice the source's words, not its
documents; documents themselves are never gathered by source or size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auric.llm.common import n_words, saved

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 20240601
# Budget (in words) that is left to the exact dynamic program.
EXACT_BUDGET = 1 << 17
# Top bits of the seeded hash that split the documents of one size.
BUCKET_BITS = 12
LOT_PART = 10_000       # equal rows that one task writes out


def _drawn(values: list[Column], seed: int) -> Column:
    """The seeded place of a row in the order in which rows are taken. Rows that
    agree in all ``values`` and in doc_id are one lot, of which any part may be
    taken: they cannot be told apart."""
    return F.xxhash64(*values, F.lit(seed))


def source_targets(sources: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """Targets of (source, source_size): ``target`` double.

    Sources by code point, null last, get the weights in turn. All sizes are
    shared by weight; a target stops at ``cap`` times the source's size and
    the excess is shared again among the others. That repeated sharing ends in
    one water level: in order of cap per weight, a source is capped as long as
    the level of those left would exceed its cap. One row per source, so the
    windows are over a small table.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    s = (sources.withColumn("w", w.cast("decimal(19,0)"))
                .withColumn("total", F.sum("source_size").over(whole))
                .withColumn("most", (F.col("source_size") * cap).cast("decimal(19,0)")))
    by_level = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    s = (s.withColumn("before", F.coalesce(F.sum("most").over(
                by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("decimal(24,0)"))
          .withColumn("w_left", F.sum("w").over(
                by_level.rowsBetween(0, Window.unboundedFollowing)).cast("decimal(12,0)")))
    left = (F.col("total") - F.col("before")).cast("decimal(20,0)")
    capped = left * F.col("w").cast("decimal(6,0)") > F.col("most") * F.col("w_left").cast("decimal(12,0)")
    s = s.withColumn("left", left).withColumn("capped", capped)
    # budget and weight of the sources that stay below their cap: those of the first such source
    first = lambda c: F.max(F.when(~F.col("capped"), F.col(c))).over(whole).cast("double")
    return s.select(
        "source", "source_size",
        F.when(F.col("capped"), F.col("most").cast("double"))
         .otherwise(first("left") * F.col("w").cast("double") / first("w_left")).alias("target"))


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take so that they sum to ``budget``
    or as little below it as the counts allow; at most ``counts`` of each.

    ``sizes`` ascending and positive. The budget is below the sum of all.
    """
    total = int((sizes * counts).sum())
    take = np.array([c * budget // total for c in map(int, counts)], dtype=np.int64)
    left = budget - int((take * sizes).sum())
    # one more of each size, those rounded off most first, then the longest, until
    # the exact part is small; short documents are left for that part
    order = np.argsort(-((counts * (budget / total)) % 1.0), kind="stable")
    for i, most in [*((i, 1) for i in order), *((i, total) for i in range(len(sizes))[::-1])]:
        if left <= EXACT_BUDGET:
            break
        size = int(sizes[i])
        k = min(most, int(counts[i] - take[i]), left // size, -(-(left - EXACT_BUDGET) // size))
        take[i] += k
        left -= k * size
    if left <= 0:
        return take
    # the exact part may also use what the longest documents give back
    for i in range(len(sizes))[::-1]:
        k = min(int(take[i]), (EXACT_BUDGET - left) // int(sizes[i]) if left < EXACT_BUDGET else 0)
        take[i] -= k
        left += k * int(sizes[i])
    # Bounded knapsack: each size at most its remaining count, split into
    # powers of two; first[s] is the item that first reached the sum s. A
    # smaller sum was reached by an earlier item, so walking back is safe.
    room = min(left, EXACT_BUDGET)
    first = np.full(room + 1, -1, dtype=np.int64)
    reach = np.zeros(room + 1, dtype=bool)
    reach[0] = True
    items: list[tuple[int, int]] = []
    for i in order:
        size, most = int(sizes[i]), min(int(counts[i] - take[i]), room // int(sizes[i]))
        step = 1
        while most > 0 and not reach[room]:
            k = min(step, most)
            gain = np.zeros_like(reach)
            gain[k * size:] = reach[:room + 1 - k * size]
            gain &= ~reach
            first[gain] = len(items)
            reach |= gain
            items.append((int(i), k))
            most -= k
            step *= 2
        if reach[room]:
            break
    at = int(np.flatnonzero(reach)[-1])
    while at > 0:
        i, k = items[first[at]]
        take[i] += k
        at -= k * int(sizes[i])
    return take


def _plan_source(rows: pa.Table) -> pa.Table:
    """Plan of one source: per size, whole passes and documents on top."""
    rows = rows.sort_by("size")
    sizes = rows["size"].to_numpy().astype(np.int64)
    counts = rows["n"].to_numpy().astype(np.int64)
    target, whole = int(rows["target"][0].as_py()), int(rows["source_size"][0].as_py())
    passes = target // whole if whole else 0
    take, filled = np.zeros(len(sizes), dtype=np.int64), sizes > 0
    if whole and target > passes * whole:
        take[filled] = fit_budget(sizes[filled], counts[filled], target - passes * whole)
    return pa.table({
        "source": rows["source"], "size": rows["size"], "n": rows["n"],
        "target": rows["target"], "source_size": rows["source_size"],
        "passes": pa.array(np.full(len(sizes), passes)), "extra": pa.array(take)})


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", weights=WEIGHTS, cap: int = CAP,
             seed: int = SEED, values: list[Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(sized documents, plan): the plan has one row per (source, size) with
    the whole ``passes`` and the lot at which the rest ends (``until_draw``,
    ``until_id``): lots drawn before it are taken once more, and of its own
    ``until_rows`` rows ``until_part``. ``values`` tell rows apart beside their
    doc_id; by default the text."""
    doc_id = F.col(id_col).cast("long")
    sized = saved(docs.select(
        doc_id.alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        n_words(F.col(text_col)).alias("size"), _drawn(values or [doc_id, F.col(text_col).cast("string")], seed).alias("draw")),
        "mix-sized")
    sized = sized.withColumn("bucket", F.shiftrightunsigned("draw", 64 - BUCKET_BITS))
    fine = saved(sized.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    hist = saved(fine.groupBy("source", "size").agg(F.sum("n").alias("n")), "mix-sizes")
    sources = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sources, weights, cap).withColumnRenamed("source", "s1")
    by_source = hist.join(targets, F.col("source").eqNullSafe(F.col("s1"))).drop("s1")
    plan = saved(by_source.groupBy("source").applyInArrow(
        _plan_source, "source string, size long, n long, target double, source_size long, "
                      "passes long, extra long"), "mix-plan")

    # The bucket that the last row to take falls into, and its place there.
    part = plan.filter((F.col("extra") > 0) & (F.col("extra") < F.col("n")))
    upto = Window.partitionBy("source", "size").orderBy("bucket")
    edge = (fine.withColumnRenamed("n", "here").join(part.withColumnRenamed("source", "s2")
                .withColumnRenamed("size", "z2"), F.col("source").eqNullSafe(F.col("s2"))
                & (F.col("size") == F.col("z2")))
            .withColumn("through", F.sum("here").over(upto))
            .filter((F.col("through") >= F.col("extra")) & (F.col("through") - F.col("here") < F.col("extra")))
            .select("source", "size", "bucket",
                    (F.col("extra") - F.col("through") + F.col("here")).alias("place")))
    e = edge.toDF("s2", "z2", "b2", "place")
    # The lots of that bucket, counted before they are ordered.
    lots = (sized.join(e, F.col("source").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2"))
                       & (F.col("bucket") == F.col("b2")))
            .groupBy("source", "size", "draw", "doc_id", "place").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("through", F.sum("rows").over(
                Window.partitionBy("source", "size").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, 0)))
            .filter((F.col("through") >= F.col("place")) & (F.col("through") - F.col("rows") < F.col("place")))
            .select(F.col("source").alias("s3"), F.col("size").alias("z3"),
                    F.col("draw").alias("until_draw"), F.col("doc_id").alias("until_id"),
                    F.col("rows").alias("until_rows"),
                    (F.col("place") - F.col("through") + F.col("rows")).alias("until_part")))
    plan = saved(plan.join(lots, F.col("source").eqNullSafe(F.col("s3")) & (F.col("size") == F.col("z3")),
                           "left").drop("s3", "z3"), "mix-until")
    return sized.drop("bucket"), plan


def _order() -> tuple[Column, ...]:
    """The order of draws: as unsigned numbers, whose top bits are the bucket."""
    return (F.shiftrightunsigned(F.col("draw"), 1), F.col("draw").bitwiseAND(F.lit(1)),
            F.col("doc_id").asc_nulls_first())


def _before(draw: Column, until: Column) -> Column:
    high = F.shiftrightunsigned(draw, 1), F.shiftrightunsigned(until, 1)
    return (high[0] < high[1]) | ((high[0] == high[1]) & (draw.bitwiseAND(F.lit(1)) < until.bitwiseAND(F.lit(1))))


def _repeats(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``sized`` (source, size, draw, doc_id, ...) with the plan's columns and
    ``repeats``. Joined on (source, size); a size that very many documents
    share is one that adaptive execution can split.

    Of a lot that is taken in part, the rows are counted and given out again:
    first those taken once more, then the others.
    """
    p = plan.withColumnRenamed("source", "plan_source").withColumnRenamed("size", "plan_size") \
            .withColumnRenamed("n", "plan_n")
    draw, until = F.col("draw"), F.col("until_draw")
    at = (draw == until) & F.col("doc_id").eqNullSafe(F.col("until_id"))
    upto = _before(draw, until) | ((draw == until) & (
        F.col("until_id").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") < F.col("until_id"))))) | at
    extra = F.when(F.col("extra") == 0, False).when(F.col("extra") >= F.col("plan_n"), True).otherwise(upto)
    joined = (sized.join(p, F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("size") == F.col("plan_size")))
                   .withColumn("repeats", F.col("passes") + extra.cast("long")))
    if plan.filter("until_part < until_rows").isEmpty():
        return joined
    split = F.coalesce(at & (F.col("until_part") < F.col("until_rows")), F.lit(False))
    own = [c for c in joined.columns if c != "repeats"]
    lot = (joined.filter(split).groupBy("plan_source", "plan_size")
                 .agg(*(F.first(c).alias(c) for c in own if c not in ("plan_source", "plan_size")),
                      F.count(F.lit(1)).alias("rows")))
    given = F.inline(F.array(F.struct(F.col("until_part").alias("many"), (F.col("passes") + 1).alias("repeats")),
                             F.struct((F.col("rows") - F.col("until_part")).alias("many"), F.col("passes").alias("repeats"))))
    return joined.filter(~split).unionByName(_many(lot.select(*own, given)).select(*joined.columns))


def _many(rows: DataFrame) -> DataFrame:
    """Each row ``many`` times, written out by several tasks."""
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("many") - 1) / LOT_PART)))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(LOT_PART), F.col("many") - F.col("lot_part") * LOT_PART)))
    return (rows.filter("many > 0").withColumn("lot_part", parts).repartition("plan_source", "plan_size", "lot_part")
                .withColumn("lot_row", each).drop("many", "lot_part", "lot_row"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target,
    repeats (how often the mix takes it) and taken = size * repeats.

    Null text has size 0 and counts with no words; a null source is a source
    of its own, last in order. An empty table gives no rows. Rows that repeat
    a doc_id are documents of their own, equal rows too: as many of them are
    taken as the plan needs. Other columns are dropped.
    """
    sized, plan = mix_plan(docs, **options)
    return _repeats(sized, plan).select(
        "doc_id", "source", "size", "source_size", "target", "repeats",
        (F.col("size") * F.col("repeats")).alias("taken"))


def mixed(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` (all columns), each as often as the
    mix takes it; rows taken 0 times are left out. Rows that agree in every
    column are equal here."""
    columns = docs.columns
    values = [F.map_entries(c) if kind.startswith("map") else F.col(f"`{c}`") for c, kind in docs.dtypes]
    _, plan = mix_plan(docs, seed=seed, values=values, **options)
    own = docs.select(_drawn(values, seed).alias("draw"), F.struct(*(f"`{c}`" for c in columns)).alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("doc_id"),
        F.col("row.source").cast("string").alias("source"),
        n_words(F.col("row.text")).alias("size"), "draw")
    return (_repeats(own, plan).filter("repeats > 0")
            .withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
            .select(*[F.col("row").getField(c).alias(c) for c in columns]))
