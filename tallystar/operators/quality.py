"""Checks of the built star and reconciliation of its layers; results are rows, not log lines."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.errors import ContractError
from tallystar.functions.columns import number
from tallystar.schema import (
    COUNT,
    FACT_KEY,
    FAMILY_MEASURES,
    MEASURES,
    RAW_MEASURE_TYPE,
    MONTHS_PER_FULL_YEAR,
    REQUIRED_IDS,
    VICTIM,
    WEIGHT,
)

TOLERANCE = 1e-6
PASS, FAIL = "PASS", "FAIL"
MANDATORY = REQUIRED_IDS + ("value",)


def _status(bad: Column) -> Column:
    return F.when(bad == 0, PASS).otherwise(FAIL)


def _check(one_row: DataFrame, name: str, bad: str, detail: Column) -> DataFrame:
    """A one-row frame as (check, status, n_bad, detail)."""
    n_bad = F.col(bad).cast("bigint")
    return one_row.select(
        F.lit(name).alias("check"), _status(n_bad).alias("status"), n_bad.alias("n_bad"), detail.alias("detail")
    )


def duplicate_keys(fact: DataFrame, key: tuple[str, ...] = FACT_KEY) -> DataFrame:
    """Keys held by more than one row, and by how many; nulls compare equal."""
    return fact.groupBy(*key).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def check_unique_grain(fact: DataFrame) -> DataFrame:
    found = duplicate_keys(fact).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n"))
    return _check(found, "unique_grain", "n", F.concat(F.col("n"), F.lit(" rows share a key")))


def families_per_indicator(indicators: DataFrame) -> DataFrame:
    """How many families the dimension gives each indicator id."""
    return indicators.groupBy("indicator_id").agg(
        F.count_distinct("family").alias("families"), F.min("family").alias("family")
    )


def fact_checks(fact: DataFrame, indicators: DataFrame) -> DataFrame:
    """The four checks that need each fact row once, in one pass over the fact.

    No negative values; mandatory fields filled; victim rows always with a sex and the others
    never; every indicator with exactly one family.
    """
    counts = {c: F.count_if(F.col(c).isNull()) for c in MANDATORY} | {
        "negative": F.count_if(F.col("value") < 0),
        "sexless": F.count_if(F.col("sex_id").isNull()),
        "sexed": F.count_if(F.col("sex_id").isNotNull()),
    }
    # The key gets a name of its own, so that its nulls can be counted next to it.
    per_indicator = fact.withColumn("_id", F.col("indicator_id")).groupBy("_id").agg(
        *[count.alias(f"_{name}") for name, count in counts.items()]
    )
    families = families_per_indicator(indicators)
    joined = per_indicator.join(families, F.col("_id") == F.col("indicator_id"), "left")
    victim = F.col("family") == VICTIM

    def total(column: Column, name: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).alias(name)

    row = joined.agg(
        *[total(F.col(f"_{c}"), c) for c in MANDATORY],
        total(F.col("_negative"), "negative"),
        total(F.when(victim, F.col("_sexless")), "victims_without_sex"),
        total(F.when(~victim, F.col("_sexed")), "others_with_sex"),
        F.count_if(F.coalesce("families", F.lit(0)) != 1).alias("mixed"),
    )

    def check(name: str, bad: Column, *detail: str | Column) -> Column:
        n_bad = bad.cast("bigint")
        return F.struct(
            F.lit(name).alias("check"),
            _status(n_bad).alias("status"),
            n_bad.alias("n_bad"),
            F.concat(*detail).alias("detail"),
        )

    nulls = F.concat_ws(", ", *[F.concat(F.lit(f"{c}: "), F.col(c)) for c in MANDATORY])
    return row.select(
        F.inline(
            F.array(
                check("no_negative_values", F.col("negative"), "negative", F.lit(" negative values")),
                check("mandatory_fields", sum((F.col(c) for c in MANDATORY), F.lit(0)), nulls),
                check(
                    "sex_consistency",
                    F.col("victims_without_sex") + F.col("others_with_sex"),
                    F.lit("victim rows without sex: "), "victims_without_sex",
                    F.lit(", other rows with sex: "), "others_with_sex",
                ),
                check(
                    "one_family_per_indicator", F.col("mixed"), "mixed", F.lit(" indicators without exactly one family")
                ),
            )
        )
    )


def check_no_negative(fact: DataFrame, indicators: DataFrame) -> DataFrame:
    return fact_checks(fact, indicators).where(F.col("check") == "no_negative_values")


def check_mandatory(fact: DataFrame, indicators: DataFrame) -> DataFrame:
    return fact_checks(fact, indicators).where(F.col("check") == "mandatory_fields")


def check_sex(fact: DataFrame, indicators: DataFrame) -> DataFrame:
    return fact_checks(fact, indicators).where(F.col("check") == "sex_consistency")


def check_one_family(fact: DataFrame, indicators: DataFrame) -> DataFrame:
    return fact_checks(fact, indicators).where(F.col("check") == "one_family_per_indicator")


def check_units(indicators: DataFrame) -> DataFrame:
    blank = F.col("unit").isNull() | (F.trim("unit") == "")
    found = indicators.agg(F.count_if(blank).alias("n"))
    return _check(found, "unit_present", "n", F.concat(F.col("n"), F.lit(" indicators without a unit")))


def year_problems(time: DataFrame) -> DataFrame:
    """Per year: whether the partial flag is wrong, and whether the months have a gap after January."""
    per_year = time.groupBy("year").agg(
        F.count("*").alias("months"),
        F.count_distinct("month").alias("distinct_months"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
        F.count_distinct("is_partial_year").alias("flags"),
        F.bool_or("is_partial_year").alias("is_partial_year"),
    )
    expected = F.col("months") < MONTHS_PER_FULL_YEAR
    gapless = (
        (F.col("first_month") == 1)
        & (F.col("last_month") == F.col("months"))
        & (F.col("distinct_months") == F.col("months"))
    )
    return per_year.select(
        "year",
        "months",
        ((F.col("flags") != 1) | (F.col("is_partial_year") != expected)).alias("wrong_flag"),
        (~gapless).alias("has_gap"),
    )


def check_time(time: DataFrame) -> DataFrame:
    dates = time.agg((F.count("ref_month") - F.count_distinct("ref_month")).alias("d"))
    found = (
        year_problems(time)
        .agg(F.count_if("wrong_flag").alias("flags"), F.count_if("has_gap").alias("gaps"))
        .withColumn("dates", dates.scalar())
        .withColumn("n", F.col("flags") + F.col("gaps") + F.col("dates"))
    )
    detail = F.concat(
        F.lit("years with a wrong flag: "), "flags", F.lit(", with a gap: "), "gaps", F.lit(", repeated dates: "), "dates"
    )
    return _check(found, "time_consistency", "n", detail)


def check_row_counts(raw: DataFrame, staging: DataFrame, counts: Mapping[str, int] | None = None) -> DataFrame:
    """`counts` holds the rows of both layers if they were counted while they were written."""
    if counts is not None:
        one = staging.sparkSession.range(1)
        found = one.select(F.lit(counts["staging"]).cast("bigint").alias("s"), F.lit(counts["raw"]).cast("bigint").alias("r"))
    else:
        found = staging.agg(F.count("*").alias("s")).withColumn("r", raw.agg(F.count("*").alias("r")).scalar())
    found = found.withColumn("n", F.abs(F.col("r") - F.col("s")))
    return _check(found, "staging_keeps_rows", "n", F.concat(F.lit("raw: "), "r", F.lit(", staging: "), "s"))


def check_source_year(grain: DataFrame) -> DataFrame:
    """The source year is the calendar year of its rows."""
    found = grain.agg(F.count_if(F.col("source_year") != F.year("ref_month")).alias("n"))
    return _check(found, "source_year_is_calendar_year", "n", F.concat(F.col("n"), F.lit(" grain rows of another year")))


def run_checks(
    raw: DataFrame,
    staging: DataFrame,
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    counts: Mapping[str, int] | None = None,
) -> DataFrame:
    """The eight checks, one row each."""
    checks = [
        check_row_counts(raw, staging, counts),
        check_unique_grain(fact),
        fact_checks(fact, dims["indicator"]),
        check_units(dims["indicator"]),
        check_time(dims["time"]),
    ]
    return reduce(DataFrame.unionByName, checks)


def known_counts(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """Row counts taken while the layers were written, in the form of `layer_counts`."""
    return spark.createDataFrame(list(counts.items()), "layer string, row_count long")


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every layer."""
    counts = [df.agg(F.lit(name).alias("layer"), F.count("*").alias("row_count")) for name, df in layers.items()]
    return reduce(DataFrame.unionByName, counts)


# --- reconciliation ----------------------------------------------------------


def source_totals(df: DataFrame, indicators: DataFrame, name: str) -> DataFrame:
    """Unrounded total per indicator over the columns its family uses, raw or staging, in one grouped pass."""
    sums = df.groupBy("indicator").agg(*[F.sum(F.col(m).cast(RAW_MEASURE_TYPE)).alias(m) for m in MEASURES])
    zero = F.lit(0).cast(RAW_MEASURE_TYPE)

    def of(family: str) -> Column:
        return sum((F.coalesce(F.col(m), zero) for m in FAMILY_MEASURES[family]), zero)

    total = F.coalesce(*[F.when(F.col("family") == family, of(family)) for family in (VICTIM, COUNT, WEIGHT)])
    return sums.join(indicators.select("indicator", "family"), "indicator").select("indicator", total.alias(name))


def fact_totals(fact: DataFrame, indicators: DataFrame) -> DataFrame:
    return (
        fact.groupBy("indicator_id")
        .agg(F.sum("value").alias("fact_total"))
        .join(indicators.select("indicator_id", "indicator"), "indicator_id")
        .select("indicator", "fact_total")
    )


def reconcile(raw: DataFrame, staging: DataFrame, fact: DataFrame, indicators: DataFrame) -> DataFrame:
    """Raw, staging and fact totals of every classified indicator; absent ones count as zero."""
    # Trimmed like staging, so that padded names meet their classification.
    raw = raw.withColumn("indicator", F.trim(F.col("indicator")))
    rows = indicators.select("indicator", "family")
    for totals in (
        source_totals(raw, indicators, "raw_total"),
        source_totals(staging, indicators, "staging_total"),
        fact_totals(fact, indicators),
    ):
        rows = rows.join(totals, "indicator", "left")
    names = ("raw_total", "staging_total", "fact_total")
    rows = rows.withColumns({n: F.coalesce(F.col(n), F.lit(0).cast(RAW_MEASURE_TYPE)) for n in names})
    difference = F.col("fact_total") - F.col("raw_total")
    return rows.withColumn("difference", difference).withColumn(
        "status", F.when(F.abs(number("difference")) <= TOLERANCE, PASS).otherwise(FAIL)
    )


def tally(results: DataFrame) -> DataFrame:
    """Numbers of passed and failed rows."""
    return results.agg(
        F.count("*").alias("checked"),
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == FAIL).alias("failed"),
    )


# --- declared constraints ----------------------------------------------------


def _natural_key(name: str, dim: DataFrame) -> list[str]:
    return [c for c in dim.columns if c in (name, "ref_month", "state", "municipality")] or [f"{name}_id"]


def _entry(name: str, part: str, key: Column, used: Column, members: Column) -> Column:
    """One row of the stacked keys: how often the fact uses a key, and how often its dimension holds it."""
    return F.struct(
        F.lit(name).alias("name"),
        F.lit(part).alias("part"),
        key.cast("string").alias("key"),
        used.cast("bigint").alias("used"),
        members.cast("bigint").alias("members"),
    )


def stacked_keys(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """(name, part, key, used, members): every id of the fact and every key of the dimensions, summed in one shuffle.

    The fact is read once and summed per task before the shuffle, so a hot id is one row per task.
    """
    one, none = F.lit(1), F.lit(0)
    of_fact = [_entry(name, "id", F.col(f"{name}_id"), one, none) for name in dims]
    value = F.when(F.col("value").isNull(), F.lit(None)).otherwise(F.when(F.col("value") < 0, "negative").otherwise("fine"))
    of_fact.append(_entry("value", "value", value, one, none))
    parts = [fact.select(F.inline(F.array(*of_fact)))]
    for name, dim in dims.items():
        nulls = sum((F.col(c).isNull().cast("int") for c in dim.columns), F.lit(0))
        of_dim = [
            _entry(name, "id", F.col(f"{name}_id"), none, one),
            _entry(name, "natural", F.to_json(F.struct(*_natural_key(name, dim))), none, one),
            _entry(name, "nulls", F.lit(None), none, nulls),
        ]
        parts.append(dim.select(F.inline(F.array(*of_dim))))
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.groupBy("name", "part", "key").agg(F.sum("used").alias("used"), F.sum("members").alias("members"))


def constraint_violations(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Violations per declared constraint of the written tables; the fact is read twice, each dimension once."""
    key, used, members = F.col("key"), F.col("used"), F.col("members")

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, used).otherwise(0))

    summed = stacked_keys(fact, dims).groupBy("name", "part").agg(
        rows_where(key.isNull()).alias("null_rows"),
        rows_where(key == "negative").alias("negative_rows"),
        rows_where(key.isNotNull() & (members == 0)).alias("orphan_rows"),
        F.count_if(members > 1).alias("repeated"),
        F.sum("members").alias("members"),
    )
    declared = [(f"fact.{c} not null", c.removesuffix("_id"), "value" if c == "value" else "id", "null_rows") for c in MANDATORY]
    declared.append(("fact.value >= 0", "value", "value", "negative_rows"))
    for name, dim in dims.items():
        declared += [
            (f"fact.{name}_id references {name}", name, "id", "orphan_rows"),
            (f"{name}({name}_id) unique", name, "id", "repeated"),
            (f"{name}({', '.join(_natural_key(name, dim))}) unique", name, "natural", "repeated"),
            (f"{name} not null", name, "nulls", "members"),
        ]
    rules = fact.sparkSession.createDataFrame(declared, "constraint string, name string, part string, counted string")
    counted = F.coalesce(*[F.when(F.col("counted") == c, F.col(c)) for c in ("null_rows", "negative_rows", "orphan_rows", "repeated", "members")])
    checked = rules.join(F.broadcast(summed), ["name", "part"], "left").select(
        "constraint", F.coalesce(counted, F.lit(0)).cast("bigint").alias("violations")
    )
    unique = duplicate_keys(fact).agg(F.count("*").alias("violations"))
    return checked.unionByName(unique.select(F.lit("fact key unique").alias("constraint"), "violations"))


def require_pass(results: DataFrame, what: str) -> None:
    """End the run when a row failed."""
    failed = [row.asDict() for row in results.where(F.col("status") == FAIL).collect()]
    if failed:
        raise ContractError(f"{what} failed: {failed}")
