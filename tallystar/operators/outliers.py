"""What the largest values of a group do to its mean and sum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions.columns import join_groups, mean, number, ratio, rounded
from tallystar.schema import TIMES_TYPE

UPPER_POINTS = {"p90": 0.90, "p95": 0.95, "p99": 0.99}


def outlier_contrast(counts: DataFrame, limits: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Means and sums with and without the values above `p99`, their group's limit.

    Nothing is removed from the data. `weight` is the number of rows with each value.
    """
    below = number("value") <= F.col("p99")
    weighted = F.col("value") * F.col(weight).cast(TIMES_TYPE)
    return (
        join_groups(counts, limits, keys)
        .groupBy(*keys)
        .agg(
            F.sum(weight).alias("row_count"),
            F.coalesce(F.sum(F.when(~below, F.col(weight))), F.lit(0)).alias("rows_above_p99"),
            F.sum(weighted).alias("sum_with_outliers"),
            F.sum(F.when(below, weighted)).alias("sum_without_top"),
            F.sum(F.when(below, F.col(weight))).alias("_kept"),
        )
        .withColumns(
            {
                "mean_with_outliers": mean("sum_with_outliers", "row_count"),
                "mean_without_top": mean("sum_without_top", "_kept"),
            }
        )
        .drop("_kept")
    )


def ratio_impact() -> Column:
    """How far the top moves the mean, relative to the mean without it."""
    return ratio(F.col("mean_with_outliers") - F.col("mean_without_top"), "mean_without_top")


def pct_impact(digits: int) -> Column:
    return rounded(100 * ratio_impact(), digits).alias("pct_impact")
