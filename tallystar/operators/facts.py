"""From staging to the long fact: sum to the grain, look keys up, unpivot."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.errors import ContractError
from tallystar.reference import SEX_LABELS
from tallystar.schema import (
    COUNT,
    FACT_COLUMNS,
    GRAIN,
    MEASURE_TYPE,
    MEASURES,
    OPTIONAL_IDS,
    REQUIRED_IDS,
    SEX_MEASURES,
    VICTIM,
    WEIGHT,
)

# Lookup of each id: (dimension, natural key columns).
LOOKUPS = {
    "time_id": ("time", ["ref_month"]),
    "place_id": ("place", ["state", "municipality"]),
    "indicator_id": ("indicator", ["indicator"]),
    "jurisdiction_id": ("jurisdiction", ["jurisdiction"]),
    "agent_id": ("agent", ["agent"]),
    "weapon_id": ("weapon", ["weapon"]),
    "age_band_id": ("age_band", ["age_band"]),
}


def aggregate_to_grain(staging: DataFrame) -> DataFrame:
    """Sum rows of the same key; null keys are keys, and a sum over nulls only stays null.

    Summing starts before the shuffle, so a key that holds a third of the rows arrives as one row
    per task.
    """
    return staging.groupBy(*GRAIN).agg(*[F.sum(m).cast(MEASURE_TYPE).alias(m) for m in MEASURES])


def merged_rows(staging: DataFrame, grain: DataFrame) -> DataFrame:
    """How many staging rows the sum has merged away."""
    return staging.agg(F.count("*").alias("staging_rows")).select(
        "staging_rows",
        grain.agg(F.count("*").alias("n")).scalar().alias("grain_rows"),
    ).withColumn("merged_rows", F.col("staging_rows") - F.col("grain_rows"))


# Dimensions that grow with the data: their joins shuffle, so they come when rows are as narrow as they get.
GROWING = ("place_id",)
SMALL = tuple(id_name for id_name in LOOKUPS if id_name not in GROWING)


def _look_up(rows: DataFrame, dims: Mapping[str, DataFrame], id_names: Iterable[str]) -> DataFrame:
    for id_name in id_names:
        dim, natural = LOOKUPS[id_name]
        rows = rows.join(dims[dim].select(id_name, *natural), natural, "left")
    return rows


def with_keys(grain: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Left lookup of every surrogate id; a null natural key keeps a null id.

    The grain comes after the sum, so no place has more rows than months x classes. Small
    dimensions are broadcast by Spark's own size check, a large place dimension is joined by shuffle.
    """
    return _look_up(grain, dims, SMALL + GROWING)


def unresolved(keyed: DataFrame) -> DataFrame:
    """Rows whose mandatory ids did not resolve."""
    missing = F.lit(False)
    for id_name in REQUIRED_IDS:
        missing = missing | F.col(id_name).isNull()
    return keyed.where(missing)


def require_keys(keyed: DataFrame) -> None:
    found = unresolved(keyed).select(*REQUIRED_IDS).limit(1).collect()
    if found:
        raise ContractError(f"mandatory ids did not resolve: {found[0].asDict()}")


def sex_id(measure: Column) -> Column:
    """Id of the sex a measure column belongs to; null for counts and weights."""
    labels = list(SEX_LABELS)
    return F.coalesce(*[F.when(measure == F.lit(name), F.lit(labels.index(name) + 1)) for name in SEX_MEASURES])


def unpivot(keyed: DataFrame, still: Iterable[str] = ()) -> DataFrame:
    """One row per non-null measure; nulls (not applicable, not reported) give no row.

    `still` names ids that are looked up later: their natural keys stay in their place.
    """
    ids = [c for c in REQUIRED_IDS + OPTIONAL_IDS if c != "sex_id" and c not in still] + ["source_year"]
    ids += [c for id_name in still for c in LOOKUPS[id_name][1]]
    long = keyed.unpivot(ids, list(MEASURES), "measure", "value").where(F.col("value").isNotNull())
    return long.withColumn("sex_id", sex_id(F.col("measure")))


def typed_fact(long: DataFrame) -> DataFrame:
    types = {c: "int" for c in REQUIRED_IDS + OPTIONAL_IDS} | {"place_id": "bigint", "source_year": "int"}
    casts = {c: F.col(c).cast(t) for c, t in types.items()} | {"value": F.col("value").cast(MEASURE_TYPE)}
    return long.withColumns(casts).select(*FACT_COLUMNS)


def build_fact(grain: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Keys, unpivot and casts over the grain.

    Places are looked up last: if that takes a shuffle, it moves ids and one value a row, not the grain's texts and measures.
    """
    long = unpivot(_look_up(grain, dims, SMALL), GROWING).drop("measure")
    return typed_fact(_look_up(long, dims, GROWING))


def bad_values(fact: DataFrame) -> DataFrame:
    """Counts of negative and of null values."""
    return fact.agg(
        F.count_if(F.col("value") < 0).alias("negative_values"),
        F.count_if(F.col("value").isNull()).alias("null_values"),
    )


def require_valid_fact(fact: DataFrame) -> None:
    """Mandatory ids present, values present and not negative: one pass over the written fact."""
    row = fact.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED_IDS + ("value",)],
        F.count_if(F.col("value") < 0).alias("negative"),
    ).first()
    broken = {name: n for name, n in row.asDict().items() if n}
    if broken:
        raise ContractError(f"fact rows with null ids, null values or negative values: {broken}")


def not_reported(grain: DataFrame, indicators: DataFrame, digits: int = 2) -> DataFrame:
    """Per indicator: grain rows, cells its family applies to, and how many were not reported."""
    cells = [F.count_if(F.col(m).isNull()).alias(f"null_{m}") for m in MEASURES]
    counted = grain.groupBy("indicator").agg(F.count("*").alias("grain_rows"), *cells)
    family, rows = F.col("family"), F.col("grain_rows")
    applicable = F.when(family == VICTIM, rows * len(SEX_MEASURES)).otherwise(rows)
    missing = (
        F.when(family == VICTIM, sum(F.col(f"null_{m}") for m in SEX_MEASURES))
        .when(family == COUNT, F.col("null_count_value"))
        .when(family == WEIGHT, F.col("null_weight_value"))
    )
    return (
        counted.join(indicators.select("indicator", "family"), "indicator")
        .withColumns({"applicable_cells": applicable, "missing_cells": missing})
        .withColumn("pct_missing", F.round(100 * F.col("missing_cells") / F.col("applicable_cells"), digits))
        .select("indicator", "family", "grain_rows", "applicable_cells", "missing_cells", "pct_missing")
    )
