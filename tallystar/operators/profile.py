"""Profiles of the raw feed: completeness, values, repeated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.columns import mean, percent, share_of
from tallystar.schema import FAMILY_MEASURES, RAW_COLUMNS, RAW_MEASURE_TYPE, SEX_MEASURES

TEXT_COLUMNS = ("state", "municipality", "indicator", "agent", "weapon", "age_band", "jurisdiction")
NUMBER_COLUMNS = SEX_MEASURES + ("victim_total", "count_value", "weight_value")
DIMENSIONAL_KEY = (
    "state", "municipality", "indicator", "ref_month", "agent", "weapon", "age_band", "jurisdiction",
)
REDUCED_KEY = ("state", "municipality", "indicator", "ref_month", "jurisdiction")
YEAR = "source_year"
TOP = 20


def _rows_of(wide: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per (year, column) from a wide row per year holding a struct per column."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), *[F.col(f"{c}.{f}").alias(f) for f in fields]) for c in columns]
    )
    return wide.select(YEAR, F.inline(entries))


def column_nulls(raw: DataFrame, columns: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Rows, nulls and null percentage per year and column, in one pass."""
    stats = [
        F.struct(F.count("*").alias("rows"), F.count_if(F.col(c).isNull()).alias("nulls")).alias(c) for c in columns
    ]
    long = _rows_of(raw.groupBy(YEAR).agg(*stats), columns, ["rows", "nulls"])
    return long.withColumn("pct_null", percent("nulls", "rows", 3))


def number_statistics(raw: DataFrame, columns: Sequence[str] = NUMBER_COLUMNS) -> DataFrame:
    """Extremes, sum, mean and number of negative values per year and numeric column."""

    def stats(c: str) -> Column:
        value = F.col(c).cast(RAW_MEASURE_TYPE)
        return F.struct(
            F.min(value).alias("minimum"),
            F.max(value).alias("maximum"),
            F.sum(value).alias("total"),
            F.count(value).alias("filled"),
            F.count_if(value < 0).alias("negative"),
        ).alias(c)

    fields = ["minimum", "maximum", "total", "filled", "negative"]
    long = _rows_of(raw.groupBy(YEAR).agg(*[stats(c) for c in columns]), columns, fields)
    return long.withColumn("mean", mean("total", "filled")).drop("filled")


def month_statistics(raw: DataFrame) -> DataFrame:
    """First, last and number of months per year."""
    month = F.to_date("ref_month")
    return raw.groupBy(YEAR).agg(
        F.min(month).alias("first_month"), F.max(month).alias("last_month"), F.count_distinct(month).alias("months")
    )


def months_list(raw: DataFrame) -> DataFrame:
    return raw.select(YEAR, F.date_format("ref_month", "yyyy-MM").alias("month")).distinct()


def value_counts(raw: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """How often each value of each text column occurs, per year; one shuffle for all columns."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    return (
        raw.select(YEAR, F.inline(entries))
        .where(F.col("value").isNotNull())
        .groupBy(YEAR, "column", "value")
        .agg(F.count("*").alias("row_count"))
    )


def distinct_counts(raw: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Distinct values per year and column, counted over the value counts."""
    return value_counts(raw, columns).groupBy(YEAR, "column").agg(F.count("*").alias("distinct_values"))


def top_values(raw: DataFrame, columns: Sequence[str] = TEXT_COLUMNS, n: int = TOP) -> DataFrame:
    """The n most frequent values; Spark keeps only n per group and task before the shuffle."""
    order = Window.partitionBy(YEAR, "column").orderBy(F.desc("row_count"), F.asc("value"))
    return value_counts(raw, columns).withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)


def repeated_keys(raw: DataFrame, key: Sequence[str] = DIMENSIONAL_KEY) -> DataFrame:
    """Groups of rows with the same key within a year; nulls compare equal."""
    keys = [YEAR, *[k for k in key if k != YEAR]]
    return raw.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def repetition(raw: DataFrame, key: Sequence[str] = DIMENSIONAL_KEY) -> DataFrame:
    """Per year: repeated groups, rows in them, and rows beyond the first of each group."""
    return (
        repeated_keys(raw, key)
        .groupBy(YEAR)
        .agg(F.count("*").alias("groups"), F.sum("row_count").alias("rows_in_groups"))
        .withColumn("surplus_rows", F.col("rows_in_groups") - F.col("groups"))
    )


def identical_rows(raw: DataFrame) -> DataFrame:
    """Repetition over all columns: rows that are the same in full."""
    return repetition(raw, RAW_COLUMNS)


def compare_keys(raw: DataFrame, candidates: dict[str, Sequence[str]]) -> DataFrame:
    """Repetition under several candidate keys; fewer groups mean a key closer to the grain."""
    frames = [repetition(raw, key).withColumn("candidate", F.lit(name)) for name, key in candidates.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def repetition_by_state(raw: DataFrame, key: Sequence[str] = RAW_COLUMNS, digits: int = 1) -> DataFrame:
    """Rows in repeated groups per state, with each state's share of the year."""
    rows = repeated_keys(raw, key).groupBy(YEAR, "state").agg(F.sum("row_count").alias("rows_in_groups"))
    shared = share_of(rows, "rows_in_groups", [YEAR], "share")
    return shared.withColumn("pct_of_year", F.round(F.col("share") * 100, digits)).drop("share")


def victim_total_mismatches(raw: DataFrame) -> DataFrame:
    """Rows whose stated victim total is not the sum over the sexes; an absent sex adds nothing."""
    nothing = F.lit(0).cast(RAW_MEASURE_TYPE)
    parts = sum((F.coalesce(F.col(m).cast(RAW_MEASURE_TYPE), nothing) for m in SEX_MEASURES), nothing)
    stated = F.col("victim_total").cast(RAW_MEASURE_TYPE)
    return raw.groupBy(YEAR).agg(F.count(stated).alias("stated"), F.count_if(stated != parts).alias("mismatches"))


def mixed_family_rows(raw: DataFrame) -> DataFrame:
    """Rows that fill the columns of more than one family."""
    filled = [
        F.greatest(*[F.col(m).isNotNull().cast("int") for m in columns], F.lit(0)) for columns in FAMILY_MEASURES.values()
    ]
    return raw.groupBy(YEAR).agg(F.count("*").alias("rows"), F.count_if(sum(filled, F.lit(0)) > 1).alias("mixed_rows"))
