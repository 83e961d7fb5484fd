"""Two-tier data quality: blocking rules quarantine a row, warn rules count it.

A rule is ``name -> Column`` that is TRUE when the row FAILS. Dict order is
priority: a row failing several blocking rules is named after the first.

Everything here is lazy. The per-entity summary is a single aggregate over
the tagged rows (rows in, clean, quarantined, one count per blocking reason
and per warn rule) instead of one job per number.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.context import RunContext
from auric.sources.schemas import CORRUPT, CORRUPT_ROW

Rules = Mapping[str, Column]

REASON = "_dq_reason"
# Columns that only rules read; no output has them.
HELPER = "_dq_"
_HELPERS = ("_entity", "_batch_id", "_run_ts")


def _own(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith(HELPER) and c not in _HELPERS]


@dataclass
class DqResult:
    entity: str
    tagged: DataFrame       # input rows plus _dq_reason (NULL = clean)
    clean: DataFrame        # rows that failed no blocking rule, input columns only
    quarantine: DataFrame   # failed rows + _dq_reason, _entity, _batch_id, _run_ts
    summary: DataFrame      # one row: entity, batch_id, rows_in, rows_clean, ...


def _fails(cond: Column) -> Column:
    # A rule that evaluates to NULL does not fail the row; without this the
    # row would be neither clean nor quarantined.
    return F.coalesce(cond, F.lit(False))


def first_failure(rules: Rules) -> Column:
    """Name of the first failing rule, NULL when all pass."""
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(_fails(c), F.lit(n)) for n, c in rules.items()])


def tag(df: DataFrame, rules: Rules) -> DataFrame:
    return df.withColumn(REASON, first_failure(rules))


def split_tagged(tagged: DataFrame, rules: Rules, entity: str, ctx: RunContext,
                 warn_rules: Rules | None = None) -> DqResult:
    """Clean / quarantine / summary from an already tagged frame."""
    warn_rules = dict(warn_rules or {})
    failed = F.col(REASON).isNotNull()
    clean = tagged.filter(~failed).select(*[c for c in _own(tagged) if c not in (CORRUPT, CORRUPT_ROW)])
    quarantine = (tagged.filter(failed)
                  .withColumn("_entity", F.lit(entity))
                  .withColumn("_batch_id", F.lit(ctx.batch_id))
                  .withColumn("_run_ts", F.lit(ctx.run_ts)))

    counts = [F.count(F.lit(1)).alias("rows_in"),
              F.count_if(~failed).alias("rows_clean"),
              F.count_if(failed).alias("rows_quarantine")]
    counts += [F.count_if(F.col(REASON) == F.lit(n)).alias(f"_b{i}")
               for i, n in enumerate(rules)]
    counts += [F.count_if(_fails(c)).alias(f"_w{i}")
               for i, c in enumerate(warn_rules.values())]
    agg = tagged.agg(*counts)

    # Blocking reasons that occurred; every warn rule, even at zero.
    blocking = (F.map_filter(F.create_map(*[x for i, n in enumerate(rules)
                                             for x in (F.lit(n), F.col(f"_b{i}"))]),
                             lambda k, v: v > 0)
                if rules else F.create_map())
    warn = (F.create_map(*[x for i, n in enumerate(warn_rules)
                           for x in (F.lit(n), F.col(f"_w{i}"))])
            if warn_rules else F.create_map())
    summary = agg.select(
        F.lit(entity).alias("entity"),
        F.lit(ctx.batch_id).alias("batch_id"),
        "rows_in", "rows_clean", "rows_quarantine",
        F.lit(ctx.run_ts).alias("run_ts"),
        F.to_json(F.struct(blocking.alias("blocking"), warn.alias("warn"))).alias("reasons_json"),
    )
    return DqResult(entity, tagged, clean, quarantine, summary)


def apply_dq(df: DataFrame, rules: Rules, entity: str, ctx: RunContext,
             warn_rules: Rules | None = None) -> DqResult:
    """Split ``df`` by ``rules`` (blocking) and count ``warn_rules``.

    Warn counts are over all input rows, quarantined ones included.
    """
    return split_tagged(tag(df, rules), rules, entity, ctx, warn_rules)


def to_quarantine_rows(quarantine: DataFrame, ignore_null_fields: bool = True) -> DataFrame:
    """Any entity's failed rows as (entity, reason, payload JSON, batch_id, run_ts)."""
    # dates, times and doubles as plain text, so that the payload reads the same everywhere
    def plain(c: str, kind: str) -> Column:
        if kind == "timestamp":
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
        if kind == "date":
            return F.col(c).cast("string").alias(c)
        if kind == "double":
            return F.coalesce(F.col(c).try_cast("decimal(38,10)").cast("string"),
                              F.col(c).cast("string")).alias(c)
        return F.col(c)

    payload_cols = [plain(c, t) for c, t in quarantine.dtypes if c in _own(quarantine)]
    opts = {} if ignore_null_fields else {"ignoreNullFields": "false"}
    return quarantine.select(
        F.col("_entity").alias("entity"),
        F.col(REASON).alias("reason"),
        F.to_json(F.struct(*payload_cols), opts).alias("payload"),
        F.col("_batch_id").alias("batch_id"),
        F.col("_run_ts").alias("run_ts"),
    )


def unified_quarantine(results: list[DqResult], ignore_null_fields: bool = True) -> DataFrame:
    frames = [to_quarantine_rows(r.quarantine, ignore_null_fields) for r in results]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def batch_summary(results: list[DqResult]) -> DataFrame:
    out = results[0].summary
    for r in results[1:]:
        out = out.unionByName(r.summary)
    return out


def batch_report(dq_results: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Per-entity fail percentage for one batch (all batches when None)."""
    from auric.functions.scalars import round_half_up, safe_div

    rows = dq_results if batch_id is None else dq_results.filter(F.col("batch_id") == batch_id)
    return rows.select(
        "entity", "rows_in", "rows_clean", "rows_quarantine",
        round_half_up(safe_div(F.lit(100.0) * F.col("rows_quarantine"), F.col("rows_in")), 2)
        .alias("pct_fail"),
        "reasons_json", "run_ts",
    )
