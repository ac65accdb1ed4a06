"""The eight dimensions, with reproducible surrogate ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.operators.sequence import number_rows
from tallystar.reference import SEX_LABELS, Reference, require_coverage
from tallystar.schema import MONTHS_PER_FULL_YEAR
from tallystar.storage import settle

CLASS_COLUMNS = ("jurisdiction", "agent", "weapon", "age_band")


def surrogate_table(df: DataFrame, column: str, id_name: str) -> DataFrame:
    """Distinct non-null values in binary order, numbered 1..N."""
    members = df.select(column).where(F.col(column).isNotNull()).distinct()
    numbered = number_rows(members, [column], id_name)
    return numbered.select(F.col(id_name).cast("int").alias(id_name), column)


def month_counts(df: DataFrame) -> DataFrame:
    """Distinct months per calendar year."""
    year = F.year("ref_month").alias("year")
    return df.groupBy(year).agg(F.count_distinct(F.month("ref_month")).alias("months"))


def dim_time(df: DataFrame) -> DataFrame:
    """One row per month; a year with fewer than twelve months is partial."""
    partial = month_counts(df).select("year", (F.col("months") < MONTHS_PER_FULL_YEAR).alias("is_partial_year"))
    months = surrogate_table(df, "ref_month", "time_id").withColumns(
        {
            "year": F.year("ref_month"),
            "month": F.month("ref_month"),
            "quarter": F.quarter("ref_month"),
            "month_name": F.date_format("ref_month", "MMMM"),
        }
    )
    return months.join(partial, "year").select(
        "time_id", "ref_month", "year", "month", "quarter", "month_name", "is_partial_year"
    )


def dim_place(df: DataFrame, reference: Reference) -> DataFrame:
    """One row per (state, municipality); states without a region fail."""
    # Cut off once: the coverage check and the numbering both read the members.
    members = settle(df.select("state", "municipality").distinct())
    require_coverage(members, reference.regions, "state")
    numbered = number_rows(members, ["state", "municipality"], "place_id")
    return numbered.join(reference.regions, "state").select("place_id", "state", "municipality", "region")


def dim_indicator(df: DataFrame, reference: Reference) -> DataFrame:
    """All classified indicators, also those the data lacks; unclassified ones in the data fail."""
    require_coverage(df, reference.indicators, "indicator")
    return number_rows(reference.indicators, ["indicator"], "indicator_id").select(
        F.col("indicator_id").cast("int").alias("indicator_id"), "indicator", "family", "unit", "kind"
    )


def dim_jurisdiction(df: DataFrame) -> DataFrame:
    return surrogate_table(df, "jurisdiction", "jurisdiction_id")


def dim_agent(df: DataFrame) -> DataFrame:
    return surrogate_table(df, "agent", "agent_id")


def dim_weapon(df: DataFrame) -> DataFrame:
    return surrogate_table(df, "weapon", "weapon_id")


def dim_age_band(df: DataFrame) -> DataFrame:
    return surrogate_table(df, "age_band", "age_band_id")


def dim_sex(df: DataFrame) -> DataFrame:
    rows = [(number, label) for number, label in enumerate(SEX_LABELS.values(), start=1)]
    return df.sparkSession.createDataFrame(rows, "sex_id int, sex string")


def build_dimensions(df: DataFrame, reference: Reference) -> dict[str, Callable[[], DataFrame]]:
    """Builders of all dimensions of a staging or grain frame.

    Months, indicators and classes come from one pass over the rows: their distinct combinations
    are few against the rows, and are cut off there because six dimensions read them. A builder runs
    its own checks and counts when it is called, so callers may run several side by side.
    """
    combos = settle(df.select("ref_month", "indicator", *CLASS_COLUMNS).distinct())
    return {
        "time": lambda: dim_time(combos),
        "place": lambda: dim_place(df, reference),
        "indicator": lambda: dim_indicator(combos, reference),
        "jurisdiction": lambda: dim_jurisdiction(combos),
        "agent": lambda: dim_agent(combos),
        "weapon": lambda: dim_weapon(combos),
        "age_band": lambda: dim_age_band(combos),
        "sex": lambda: dim_sex(df),
    }
