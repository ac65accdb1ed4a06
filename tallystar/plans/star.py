"""The star schema of one feed: how it is built, stored and read back."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallystar.operators.dimensions import build_dimensions
from tallystar.operators.facts import aggregate_to_grain, build_fact, require_keys, require_valid_fact, with_keys
from tallystar.operators.staging import build_staging
from tallystar.plans.lookup import Lookup, read_lookup
from tallystar.plans.stored import (
    count_values,
    order_of_places,
    total_by_month,
    total_by_place_year,
    weight_contrast,
    weight_statistics,
    weights_of,
    year_statistics,
)
from tallystar.reference import Reference
from tallystar.sources import tables
from tallystar.sources.raw import stack_years
from tallystar.storage import building, drop_folder, settle, tasks_for, together

SUMS = ("place_year", "indicator_month", "value_counts", "indicator_year", "weight_year", "weight_contrast", "place_order")
STORED = ("staging", "grain", "fact", *SUMS)


@dataclass(frozen=True)
class Star:
    """The tables views and queries read."""

    reference: Reference
    staging: DataFrame
    grain: DataFrame
    fact: DataFrame
    dims: Mapping[str, DataFrame] = field(repr=False)
    place_year: DataFrame
    indicator_month: DataFrame
    value_counts: DataFrame
    indicator_year: DataFrame
    weight_year: DataFrame
    weight_contrast: DataFrame
    place_order: DataFrame
    lookup: Lookup = field(repr=False)
    raw: DataFrame | None = None
    # Checked on the stored tables: every row's source year is its calendar year: year filters may prune the fact's partitions.
    years_agree: bool = False
    # Rows of each layer, counted while they were written; absent for stars that are read back.
    counts: Mapping[str, int] | None = None

    @property
    def spark(self) -> SparkSession:
        return self.fact.sparkSession

    def dim(self, name: str) -> DataFrame:
        return self.dims[name]


def source_year_mismatches(grain: DataFrame) -> DataFrame:
    """Grain rows whose source year differs from their calendar year."""
    return grain.agg(F.count_if(F.col("source_year") != F.year("ref_month")).alias("rows_of_another_year"))


def build_in_memory(raw: Mapping[int, DataFrame] | DataFrame, reference: Reference) -> Star:
    """The star without a warehouse folder, its layers checkpointed: for small feeds and tests."""
    raw = stack_years(raw)
    staging = build_staging(raw)
    grain = settle(aggregate_to_grain(staging))
    dims = together(**{name: lambda b=b: settle(b()) for name, b in build_dimensions(grain, reference).items()})
    require_keys(with_keys(grain, dims))
    fact = settle(build_fact(grain, dims))
    require_valid_fact(fact)
    place_year, value_counts = total_by_place_year(fact), count_values(fact, dims["time"])
    sums = {
        "place_year": place_year,
        "indicator_month": total_by_month(fact),
        "value_counts": value_counts,
        "indicator_year": year_statistics(fact, value_counts),
        "weight_year": weight_statistics(weights_of(value_counts, dims["indicator"])),
        "weight_contrast": weight_contrast(weights_of(value_counts, dims["indicator"])),
        "place_order": order_of_places(place_year, dims["place"]),
    }
    return _opened(reference, dims, {"staging": staging, "grain": grain, "fact": fact, **sums}, raw)


def write_star(raw: Mapping[int, DataFrame] | DataFrame, reference: Reference, root: str) -> Star:
    """Build the star layer by layer; every layer is written once, counted on the way, and read back by the next."""
    raw = stack_years(raw)
    counted = {name: Observation(name) for name in ("raw", "staging", "grain", "fact")}
    # Counted in the stage that writes, whose tasks report once each however often one is run again.
    seen = raw.observe(counted["raw"], F.count("*").alias("rows"))
    with building(raw.sparkSession):
        staging = tables.write_staging(build_staging(seen), f"{root}/staging", counted["staging"])
        # From here on tasks follow the number of rows, not the bytes they are packed into.
        with tasks_for(raw.sparkSession, counted["staging"].get["rows"]):
            dims, stored = _write_layers(reference, root, staging, counted)
            counts = {name: observation.get["rows"] for name, observation in counted.items()}
            return _opened(reference, dims, stored, raw, counts)


def _write_layers(
    reference: Reference, root: str, staging: DataFrame, counted: Mapping[str, Observation]
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Everything behind staging: the dimensions, and the other stored tables."""
    grain = tables.write_table(aggregate_to_grain(staging), f"{root}/grain", counted["grain"])
    paths = tables.dimension_paths(root)
    builders = build_dimensions(grain, reference)
    dims = together(
        **{name: lambda name=name: tables.write_dimension(builders[name](), paths[name]) for name in builders}
    )
    # Written before it is dealt by range: its lookup's shuffle is gone by then, and the range is sampled without the joins.
    spark, looked_up, sorted_places = staging.sparkSession, f"{root}/looked_up", f"{root}/sorted_places"
    fact = tables.write_table(build_fact(grain, dims), looked_up)
    fact = tables.write_fact(fact, f"{root}/fact", counted["fact"])
    drop_folder(spark, looked_up)
    require_valid_fact(fact)

    def places() -> tuple[DataFrame, DataFrame]:
        by_place = tables.clustered(fact, "source_year")
        place_year = tables.write_clustered(total_by_place_year(by_place), f"{root}/place_year", "year")
        sorted_once = partial(tables.write_table, path=sorted_places)
        place_order = tables.write_table(order_of_places(place_year, dims["place"], sorted_once), f"{root}/place_order")
        drop_folder(spark, sorted_places)
        return place_year, place_order

    def months() -> DataFrame:
        return tables.write_table(total_by_month(fact), f"{root}/indicator_month")

    value_counts = tables.write_table(count_values(fact, dims["time"]), f"{root}/value_counts")
    weights = weights_of(value_counts, dims["indicator"])
    written = together(
        places=places,
        months=months,
        years=lambda: tables.write_table(year_statistics(fact, value_counts), f"{root}/indicator_year"),
        weights=lambda: tables.write_table(weight_statistics(weights), f"{root}/weight_year"),
        contrast=lambda: tables.write_table(weight_contrast(weights), f"{root}/weight_contrast"),
    )
    stored = {"staging": staging, "grain": grain, "fact": fact, "value_counts": value_counts}
    stored["place_year"], stored["place_order"] = written["places"]
    stored |= {"indicator_month": written["months"], "indicator_year": written["years"]}
    stored |= {"weight_year": written["weights"], "weight_contrast": written["contrast"]}
    return dims, stored


def read_star(spark: SparkSession, reference: Reference, root: str, raw: DataFrame | None = None) -> Star:
    """Open the tables of an earlier run."""
    stored = {name: tables.read_table(spark, f"{root}/{name}") for name in STORED}
    dims = {name: tables.read_table(spark, path) for name, path in tables.dimension_paths(root).items()}
    return _opened(reference, dims, stored, raw)


def _opened(
    reference: Reference,
    dims: Mapping[str, DataFrame],
    stored: Mapping[str, DataFrame],
    raw: DataFrame | None,
    counts: Mapping[str, int] | None = None,
) -> Star:
    read = together(
        lookup=lambda: read_lookup(
            dims["indicator"], dims["time"], dims["jurisdiction"], stored["indicator_month"], reference.regions
        ),
        mismatches=lambda: source_year_mismatches(stored["grain"]).first()[0],
    )
    return Star(
        reference=reference,
        dims=dims,
        raw=raw,
        lookup=read["lookup"],
        years_agree=read["mismatches"] == 0,
        counts=counts,
        **stored,
    )
