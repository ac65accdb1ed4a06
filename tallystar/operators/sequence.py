"""Consecutive numbers 1..N in sort order, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.storage import settle

ROW_BITS = 33


def number_rows(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """Add `name` = 1..N following `order`, which has to be unique per row.

    The frame is range-sorted, each row keeps its slot within its partition
    (`monotonically_increasing_id`: partition number above 33 bits of row number), and the number of
    rows in earlier partitions is added. The sorted rows are checkpointed first, so that counting
    and numbering see the same partitions even when an executor is lost in between.
    """
    slotted = settle(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()))
    slotted = slotted.withColumn("_part", F.shiftright("_slot", ROW_BITS))
    # One row per partition of the sort, so this window stays small.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slotted.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    in_part = F.col("_slot").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        slotted.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + in_part + 1)
        .drop("_slot", "_part", "_offset")
    )
