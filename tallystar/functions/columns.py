"""Column expressions and small join helpers used across the views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def number(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def rounded(value: Column, digits: int) -> Column:
    """Half away from zero; the added zero turns -0.0 into 0.0."""
    return F.round(value, digits) + F.lit(0.0)


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Null where the denominator is zero."""
    return F.try_divide(number(top), number(bottom))


def percent(top: Column | str, bottom: Column | str, digits: int = 2) -> Column:
    return rounded(100 * ratio(top, bottom), digits)


def mean(total: Column | str, count: Column | str) -> Column:
    """Mean from an exact decimal sum, so it does not depend on the order of the rows."""
    return ratio(total, count)


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of all keys."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Attach per-group columns to the rows of each group, null keys included."""
    if not keys:
        scalars = [groups.select(c).scalar().alias(c) for c in groups.columns]
        return rows.select("*", *scalars)
    renamed = groups.withColumnsRenamed({k: f"_group_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in keys])
    return rows.join(renamed, condition).drop(*[f"_group_{k}" for k in keys])


def share_of(df: DataFrame, value: str, parent: list[str], name: str, total_name: str | None = None) -> DataFrame:
    """Add value / sum(value) over `parent`, for parents of any size.

    The parent totals are summed before the shuffle and joined back, so no task sees a whole parent.
    """
    total = total_name or f"_{name}_total"
    totals = df.groupBy(*parent).agg(F.sum(value).alias(total))
    joined = join_groups(df, totals, parent).withColumn(name, ratio(value, total))
    return joined if total_name else joined.drop(total)


def month_number(month: Column | str) -> Column:
    """Months on one calendar axis."""
    return F.year(month) * 12 + F.month(month)
