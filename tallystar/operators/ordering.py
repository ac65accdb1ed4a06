"""Exact ranks and percentiles for groups too large for one task.

A window or a `percentile` aggregate brings a whole group to one task. Ranks come from one range sort
with offsets per partition. For percentiles the distinct stored values of a group are counted first and
put into buckets that follow the order of the values, coarse and fine. Counts then run on three levels:
over the coarse buckets of a group, the fine buckets of a coarse one, and the values of a fine one. With ten
decimals and values up to 10**11 each level holds at most 10**7 parts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.columns import join_groups
from tallystar.operators.sequence import ROW_BITS
from tallystar.storage import settle

BUCKET_WIDTHS = (10_000.0, 0.001)


def rank_within(df: DataFrame, keys: list[str], value: str, name: str, dense: bool = False) -> DataFrame:
    """Rank by descending value within the keys: with gaps, or dense. Null values get no rank.

    One range sort on (keys, value), checkpointed; rows of a tie may lie in several partitions. A partition
    sums up its runs of equal values, so the windows below see the runs of one partition, or one row per
    partition and key, but never a group.
    """
    ranked = df.where(F.col(value).isNotNull())
    order = [*[F.col(k).asc_nulls_first() for k in keys], F.desc(value), F.xxhash64(*df.columns)]
    placed = settle(ranked.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_slot", ROW_BITS))
    run = [*keys, value]
    runs = placed.groupBy("_part", *run).agg(F.count("*").alias("_n"), F.min("_slot").alias("_first"))

    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = runs.groupBy("_part", *keys).agg(F.sum("_n").alias("_n"))
    parts = parts.select("_part", *keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part", *keys).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_part", *run, F.coalesce(F.sum("_n").over(within), F.lit(0)).alias("_ahead"))
    at = (F.col("_before") + F.col("_ahead") + 1).alias(name)
    # A tie that spans partitions takes the place of its first row.
    starts = join_groups(runs, parts, ["_part", *keys]).select("_part", *run, at)
    ties = starts.groupBy(*run).agg(F.min(name).alias(name))
    if dense:
        ties = rank_within(ties.drop(name), keys, value, name)
    ranks = join_groups(starts.drop(name), ties, run)
    found = join_groups(placed, ranks, ["_part", *run]).select(*df.columns, name)
    return found.unionByName(df.where(F.col(value).isNull()).withColumn(name, F.lit(None).cast("bigint")))


def window_rank(df: DataFrame, keys: list[str], value: str, name: str, dense: bool = False) -> DataFrame:
    """The same ranks for groups known to be small (states, indicators, classes)."""
    window = Window.partitionBy(*keys).orderBy(F.desc(value))
    function = F.dense_rank if dense else F.rank
    return df.withColumn(name, F.when(F.col(value).isNotNull(), function().over(window)).cast("bigint"))


def _targets(points: Mapping[str, float], total: Column) -> Column:
    """Two row numbers per point (0-based), below and above its position, and how far it lies between them."""

    def target(name: str, side: str, point: float) -> Column:
        position = F.lit(float(point)) * (total - 1)
        row = F.floor(position) if side == "low" else F.ceil(position)
        return F.struct(
            F.lit(name).alias("name"), F.lit(side).alias("side"), row.alias("row"), (position - F.floor(position)).alias("between")
        )

    return F.array(*[target(name, side, point) for name, point in points.items() for side in ("low", "high")])


def _holding_targets(parts: DataFrame, within: list[str], order: str) -> DataFrame:
    """The parts that hold a target, with those targets counted from the part's first row.

    A running count over the parts is held against the list of targets, so a part is never copied per target.
    """
    earlier = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    counted = parts.withColumn("_ahead", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    here = F.filter("_targets", lambda t: (t["row"] >= F.col("_ahead")) & (t["row"] < F.col("_ahead") + F.col("_n")))
    moved = F.transform(here, lambda t: t.withField("row", t["row"] - F.col("_ahead")))
    return counted.select(*within, order, moved.alias("_targets")).where(F.size("_targets") > 0)


def quantiles(
    df: DataFrame, keys: list[str], value: str, points: Mapping[str, float], weight: str | None = None
) -> DataFrame:
    """Exact inclusive percentiles with linear interpolation, one column per named point.

    `weight` names a column with the number of times each row counts. All points are looked for in one pass
    over each level, and only the buckets that hold one are opened.
    """
    if not keys:
        one_group = quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, points, weight)
        return one_group.drop("_all")
    times = F.sum(weight) if weight else F.count("*")
    # Cast, division and floor never swap two values, which is all the buckets need.
    buckets = {f"_bucket_{i}": F.floor(F.col(value).cast("double") / F.lit(w)) for i, w in enumerate(BUCKET_WIDTHS)}
    values = (
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(times.alias("_n")).withColumns(buckets)
    )

    coarse, *finer = buckets
    total = F.sum("_n").over(Window.partitionBy(*keys))
    parts = values.groupBy(*keys, coarse).agg(F.sum("_n").alias("_n")).withColumn("_targets", _targets(points, total))
    found, within = _holding_targets(parts, keys, coarse), [*keys, coarse]
    for bucket in finer:
        opened = join_groups(values, found, within).groupBy(*within, bucket)
        parts = opened.agg(F.sum("_n").alias("_n"), F.first("_targets").alias("_targets"))
        found, within = _holding_targets(parts, within, bucket), [*within, bucket]
    found = _holding_targets(join_groups(values, found, within), within, value)

    at = found.select(*keys, F.col(value).cast("double").alias("_value"), F.explode("_targets").alias("_target"))

    def pick(name: str, side: str) -> Column:
        wanted = (F.col("_target.name") == name) & (F.col("_target.side") == side)
        return F.max(F.when(wanted, F.col("_value")))

    def interpolated(name: str) -> Column:
        low, high = pick(name, "low"), pick(name, "high")
        between = F.max(F.when(F.col("_target.name") == name, F.col("_target.between")))
        return (low + between * (high - low)).alias(name)

    return at.groupBy(*keys).agg(*[interpolated(name) for name in points])
