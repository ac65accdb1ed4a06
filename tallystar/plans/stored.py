"""What is summed, counted and ordered once, when the star is written."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.columns import join_groups, mean, number
from tallystar.operators.ordering import quantiles
from tallystar.operators.outliers import UPPER_POINTS, outlier_contrast
from tallystar.operators.sequence import ROW_BITS
from tallystar.schema import TIMES_TYPE, WEIGHT
from tallystar.storage import settle


def total_by_place_year(fact: DataFrame) -> DataFrame:
    """Total and row count per indicator, place and year.

    Of a fact that is dealt by range of these keys, each sum is made where its rows are, without another shuffle.
    """
    return fact.groupBy("indicator_id", "place_id", F.col("source_year").alias("year")).agg(
        F.sum("value").alias("total"), F.count("*").alias("row_count")
    )


def total_by_month(fact: DataFrame) -> DataFrame:
    """Total and row count per indicator and month."""
    return fact.groupBy("indicator_id", "time_id").agg(F.sum("value").alias("total"), F.count("*").alias("row_count"))


def count_values(fact: DataFrame, time: DataFrame) -> DataFrame:
    """How often each value occurs, per indicator and year: what percentiles are read from."""
    return (
        fact.join(time.select("time_id", "year"), "time_id")
        .groupBy("indicator_id", "source_year", "year", "value")
        .agg(F.count("*").alias("times"))
    )


def year_statistics(fact: DataFrame, value_counts: DataFrame) -> DataFrame:
    """Count, sum, mean, median, extremes and population deviation per indicator and year."""
    keys = ["indicator_id", "source_year"]
    stats = fact.groupBy(*keys).agg(
        F.count("*").alias("row_count"),
        F.sum("value").alias("total"),
        F.min("value").alias("minimum"),
        F.max("value").alias("maximum"),
        F.stddev_pop(number("value")).alias("deviation"),
    )
    medians = quantiles(value_counts, keys, "value", {"median": 0.5}, "times")
    return (
        stats.join(medians, keys)
        .withColumn("mean", mean("total", "row_count"))
        .withColumnRenamed("source_year", "year")
        .select("indicator_id", "year", "row_count", "total", "mean", "median", "minimum", "maximum", "deviation")
    )


def weights_of(value_counts: DataFrame, indicators: DataFrame) -> DataFrame:
    """Value counts of the weight family."""
    weights = indicators.where(F.col("family") == WEIGHT).select("indicator_id")
    return value_counts.join(weights, "indicator_id", "left_semi")


def weight_statistics(weights: DataFrame) -> DataFrame:
    """Count, sum, mean, percentiles and maximum of the weights per indicator and calendar year."""
    keys = ["indicator_id", "year"]
    stats = weights.groupBy(*keys).agg(
        F.sum("times").alias("row_count"),
        F.sum(F.col("value") * F.col("times").cast(TIMES_TYPE)).alias("total"),
        F.max("value").alias("maximum"),
    )
    points = quantiles(weights, keys, "value", {"median": 0.5} | UPPER_POINTS, "times")
    return stats.join(points, keys).withColumn("mean", mean("total", "row_count"))


def weight_contrast(weights: DataFrame) -> DataFrame:
    """Outlier contrast per weight indicator, over all years."""
    keys = ["indicator_id"]
    return outlier_contrast(weights, quantiles(weights, keys, "value", {"p99": 0.99}, "times"), keys, "times")


ORDER_KEYS = ["indicator_id", "year"]


def order_of_places(
    place_year: DataFrame, places: DataFrame, keep: Callable[[DataFrame], DataFrame] = settle
) -> DataFrame:
    """Every place's position by descending total, per indicator and year and (null year) over all years.

    `position` counts within the whole list, `state_position` within the state, and `rank` gives equal totals the
    same number. Pages and rankings are filters on these. One range sort, kept by `keep`, gives all three: rows count up
    within a partition of the sort, and counts per partition say how many stand in earlier ones. A partition is dealt with
    in one task, in the order of the sort, and what it needs from the others is a row per list and state; so the
    result is clustered and sorted by indicator, year and position without another sort of all rows.
    """
    # One shuffle by place serves the sums over all years and the names; a place has a row per indicator and year.
    yearly = place_year.select("indicator_id", "year", "place_id", "total").repartition("place_id")
    overall = yearly.groupBy("indicator_id", "place_id").agg(F.sum("total").alias("total"))
    # Merged, not hashed: rows leave place by place, and their names pack well in the sort's shuffle.
    names = places.select("place_id", "state", "municipality").hint("merge")
    overall = overall.withColumn("year", F.lit(None).cast("int"))
    labelled = yearly.join(names, "place_id").unionByName(overall.join(names, "place_id"))
    order = [F.asc("indicator_id"), F.asc_nulls_first("year"), F.desc("total"), F.asc("municipality"), F.asc("state")]
    placed = keep(labelled.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_slot", ROW_BITS))
    part, tie = ["_part", *ORDER_KEYS], [*ORDER_KEYS, "total"]

    def earlier(*keys: str) -> Column:
        window = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    # Per partition, list and state: few rows, however many places there are. Both are numbered in the order of the sort.
    ends = [F.min("_start").alias("_start"), F.max("_most").alias("_most"), F.min("_least").alias("_least")]
    cells = placed.withColumns({"_start": F.col("_slot"), "_most": F.col("total"), "_least": F.col("total")})
    cells = settle(cells.groupBy(*part, "state").agg(F.count("*").alias("_n"), *ends))
    in_order = Window.orderBy("_part", F.asc("indicator_id"), F.asc_nulls_first("year"))
    last = F.lag("_least").over(Window.partitionBy(*ORDER_KEYS).orderBy("_part"))
    parts = cells.groupBy(*part).agg(F.sum("_n").alias("_n"), *ends)
    parts = settle(parts.withColumns({"_before": earlier(*ORDER_KEYS), "_last": last, "_list": F.row_number().over(in_order)}))
    starts = parts.select(*part, "_before", "_start", "_list")
    in_list = F.col("_before") + F.col("_slot") - F.col("_start") + 1

    # Ties that lie in several partitions, with the position of their first row.
    spread = parts.where(F.col("_last") == F.col("_most")).select(*ORDER_KEYS, F.col("_most").alias("total"))
    spread = spread.distinct().withColumn("_spread", F.lit(True))
    first_rows = join_groups(placed.select(*tie, "_slot"), F.broadcast(spread), tie).groupBy(*tie).agg(F.min("_slot").alias("_slot"))
    first_rows = first_rows.withColumn("_part", F.shiftright("_slot", ROW_BITS))
    ties = join_groups(first_rows, starts, part).select(*[F.col(c).alias(f"_tied_{c}") for c in tie], in_list.alias("_rank"))

    state_before = cells.select(*part, "state", earlier(*ORDER_KEYS, "state").alias("_state_before"))
    state_before = state_before.withColumn("_cell", F.row_number().over(Window.orderBy(*part, "state")))
    offsets = join_groups(state_before, starts, part)
    # Windows over numbers only: rows come in the order of the sort, and no strings are compared.
    listed = join_groups(placed, F.broadcast(offsets), [*part, "state"]).repartitionByRange("_list")
    in_part = F.rank().over(Window.partitionBy("_list").orderBy(F.desc("total")))
    ahead = F.col("_before") + in_part
    in_state = F.col("_state_before") + F.row_number().over(Window.partitionBy("_list", "_cell").orderBy("_slot"))
    counted = listed.withColumn("_ahead", ahead).withColumn("state_position", in_state)
    same_tie = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_tied_{c}")) for c in tie])
    return counted.join(F.broadcast(ties), same_tie, "left").sortWithinPartitions("_slot").select(
        *ORDER_KEYS, in_list.alias("position"), "state_position", F.coalesce("_rank", "_ahead").alias("rank"),
        "place_id", "state", "municipality", "total",
    )
