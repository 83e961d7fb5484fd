"""Keep the newest row per key (the window dedup every entity uses)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def _orderable(kind: DataType) -> bool:
    """Arrays and structs can be ordered, maps cannot."""
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, MapType)


def default_tiebreak(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """All remaining columns that can be ordered, in schema order.

    Ordering on them makes the choice among rows with equal recency
    independent of partitioning and input order, so re-runs and different
    cluster sizes keep the same row. Only columns that hold maps are skipped.
    """
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in skip and _orderable(f.dataType)]


def keep_latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str],
                tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: largest ``newest_first`` values first, NULLs last.

    Rows with a NULL key form one group (as in a window partition). Ties are
    broken by ``tiebreak`` (default: every other column, descending).

    Plan: ``row_number() = 1`` lets Catalyst insert a partial
    ``WindowGroupLimit`` before the exchange, so each map task forwards at
    most one row per key; a hot key costs one row per task in the shuffle,
    not all of its rows.
    """
    keys, newest_first = list(keys), list(newest_first)
    if tiebreak is None:
        tiebreak = default_tiebreak(df, keys + newest_first)
    order: list[Column] = [F.col(c).desc_nulls_last() for c in newest_first]
    order += [F.col(c).desc_nulls_last() for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))
