"""Column expressions used by the cleaning and reporting layers.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen. Casts use ``try_cast``: under ANSI mode a plain cast of a blank or
garbage string raises and would fail the whole job, while the data-quality
layer wants such values as NULL so a rule can quarantine the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Range of unix seconds that maps to a valid date (0001-01-01 .. 9999-12-31);
# anything outside is treated as unparseable instead of overflowing.
_MIN_UNIX = -62135596800
_MAX_UNIX = 253402300799


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: str | Column) -> Column:
    """TRUE for NULL or the empty string (no trimming, as the rules expect)."""
    c = col(c)
    return c.isNull() | (F.length(c) == 0)


def blank_to_null(c: str | Column) -> Column:
    """Trimmed value, or NULL when nothing is left after trimming."""
    t = F.trim(col(c).cast("string"))
    return F.when(F.length(t) > 0, t)


def unix_seconds(c: str | Column) -> Column:
    """Unix seconds from a string or number; accepts ``1.548137353E9``.

    The value goes through double so scientific notation parses, then to a
    whole number of seconds. Blank, garbage and out-of-range values give NULL;
    ``unreadable_seconds`` tells these from a missing value.
    """
    secs = col(c).try_cast("double").try_cast("long")
    return F.when(secs.between(_MIN_UNIX, _MAX_UNIX), secs)


def unreadable_seconds(c: str | Column) -> Column:
    """TRUE for a value that is there but no valid date (garbage, or out of
    range, e.g. milliseconds)."""
    return blank_to_null(c).isNotNull() & unix_seconds(c).isNull()


def unix_to_timestamp(c: str | Column) -> Column:
    return F.timestamp_seconds(unix_seconds(c))


def unix_to_date(c: str | Column) -> Column:
    return F.to_date(unix_to_timestamp(c))


def split_last_first(name: str | Column) -> tuple[Column, Column]:
    """Split ``LAST, FIRST M`` into (last, first).

    Only the first comma splits; spaces around it are dropped. Without a
    comma there is no last name and the whole value is the first name.
    """
    name = col(name)
    parts = F.split(name, r"\s*,\s*", 2)
    has_comma = name.contains(",")
    last = F.when(has_comma, F.trim(F.get(parts, 0)))
    first = F.when(has_comma, F.trim(F.get(parts, 1))).otherwise(name)
    return last, first


def join_non_blank(sep: str, *parts: str | Column) -> Column:
    """``concat_ws`` that also skips blank parts; all blank gives ''."""
    return F.concat_ws(sep, *[blank_to_null(p) for p in parts])


def safe_div(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI division by zero raises)."""
    return col(num) / F.nullif(col(den), F.lit(0))


def round_half_up(c: str | Column, digits: int) -> Column:
    """Round a double half-up at ``digits`` decimals, returned as double.

    Rounding the binary double directly makes ties depend on the last bit
    (12.345 is stored as 12.34499...); going through a decimal with ten
    places first gives the decimal-looking result every reader expects.
    """
    return F.round(col(c).cast("double").cast("decimal(30,10)"), digits).cast("double")


# Money is summed as decimal(28,10): ten places, and amounts below this limit.
MONEY = "decimal(28,10)"
MONEY_LIMIT = 1e17


def whole(c: str | Column, kind: str = "long") -> Column:
    """A whole number from text or a number; ``34.0`` is 34, fractions are cut
    off, anything unreadable is NULL."""
    return col(c).try_cast("decimal(38,10)").try_cast(kind)


def money(c: str | Column) -> Column:
    """An amount with ten places; NULL if it is not finite or too large."""
    return col(c).try_cast(MONEY)


def not_money(c: str | Column) -> Column:
    """TRUE for an amount that is NULL, NaN, infinite, zero, negative or out of
    range. NaN compares greater than every number, so it is asked for by name."""
    c = col(c)
    return c.isNull() | F.isnan(c) | (c <= 0) | (c >= MONEY_LIMIT)


def money_sum(c: str | Column) -> Column:
    """Exact sum of money amounts, as double.

    Amounts are summed as decimals, so the result does not depend on
    partitioning or summation order, unlike a double sum.
    """
    return F.sum(money(c)).cast("double")


def money_avg(c: str | Column) -> Column:
    return money_sum(c) / F.count(col(c))


def pct_change(cur: str | Column, prev: str | Column, digits: int = 1) -> Column:
    """100 * (cur - prev) / prev rounded, NULL when prev is 0 or NULL."""
    cur_d, prev_d = col(cur).cast("double"), col(prev).cast("double")
    return round_half_up(F.lit(100.0) * (cur_d - prev_d) / F.nullif(prev_d, F.lit(0.0)), digits)


def in_values(c: str | Column, values: Sequence | None) -> Column | None:
    """Optional multi-select filter: no values means no filter.

    A NULL column value never matches a non-empty selection.
    """
    if not values:
        return None
    return col(c).isin(list(values))


def in_array(c: str | Column, values: Column) -> Column:
    """The same filter with the selection as an array column: an empty array
    means no filter."""
    return (F.size(values) == 0) | F.array_contains(values, col(c))


def all_of(*conds: Column | None) -> Column:
    """AND of the given conditions, skipping the absent ones."""
    present = [c for c in conds if c is not None]
    out = F.lit(True)
    for c in present:
        out = out & c
    return out
