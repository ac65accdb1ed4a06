"""The semantic layer: one function per view, all lazy.

Totals are summed on integer ids first; labels join the few rows that are left. Windows are used
only where the calendar or the configuration bounds them (months, states, indicators, classes). Places
go through `rank_within` and `share_of`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystar.functions.columns import mean, month_number, number, percent, ratio, rounded, share_of
from tallystar.operators.facts import not_reported
from tallystar.operators.ordering import window_rank
from tallystar.operators.outliers import UPPER_POINTS, pct_impact
from tallystar.plans.star import Star
from tallystar.reference import semantic_group
from tallystar.schema import MONTHS_PER_FULL_YEAR

LABELS = ("indicator", "family", "unit")


# --- labels ------------------------------------------------------------------


def indicator_labels(star: Star) -> DataFrame:
    """Indicator dimension with its semantic group."""
    return star.dim("indicator").withColumn("semantic_group", semantic_group(F.col("kind"), star.reference))


def year_flags(star: Star) -> DataFrame:
    """Distinct (year, partial flag)."""
    return star.dim("time").select("year", "is_partial_year").distinct()


def enriched_fact(star: Star) -> DataFrame:
    """Every fact row with all labels; the row count stays that of the fact."""
    df = star.fact
    for name in ("time", "place", "jurisdiction"):
        df = df.join(star.dim(name), f"{name}_id")
    df = df.join(indicator_labels(star), "indicator_id")
    for name in ("agent", "weapon", "age_band", "sex"):
        df = df.join(star.dim(name), f"{name}_id", "left")
    return df


# --- aggregates on ids -------------------------------------------------------


def indicator_year_statistics(star: Star) -> DataFrame:
    """Count, sum, mean, median, extremes and population deviation per indicator and year."""
    return star.indicator_year


def indicator_place_year(star: Star) -> DataFrame:
    """Total per indicator, place and year."""
    return star.place_year.select("indicator_id", "place_id", "year", "total")


def indicator_jurisdiction_year(star: Star) -> DataFrame:
    return star.fact.groupBy("indicator_id", "jurisdiction_id", F.col("source_year").alias("year")).agg(
        F.sum("value").alias("total"), F.count("*").alias("row_count")
    )


def indicator_month(star: Star) -> DataFrame:
    """Total per indicator and month."""
    return star.indicator_month.select("indicator_id", "time_id", "total")


# --- breakdowns --------------------------------------------------------------


def national(star: Star) -> DataFrame:
    return (
        indicator_year_statistics(star)
        .join(indicator_labels(star), "indicator_id")
        .join(year_flags(star), "year")
        .select(
            *LABELS, "kind", "semantic_group", "year", "is_partial_year",
            "row_count", "total", "mean", "median", "minimum", "maximum", "deviation",
        )
    )


def _state_totals(star: Star) -> DataFrame:
    places = star.dim("place").select("place_id", "state", "region")
    return (
        indicator_place_year(star)
        .join(places, "place_id")
        .groupBy("indicator_id", "state", "region", "year")
        .agg(F.sum("total").alias("total"), F.count("*").alias("places"))
    )


def by_state(star: Star) -> DataFrame:
    """Total per state, and the mean over its municipalities that have rows."""
    return (
        _state_totals(star)
        .join(indicator_labels(star), "indicator_id")
        .join(year_flags(star), "year")
        .withColumn("mean", mean("total", "places"))
        .select(*LABELS, "semantic_group", "state", "region", "year", "is_partial_year", "total", "mean")
    )


def _label_places(star: Star, totals: DataFrame) -> DataFrame:
    return (
        totals.join(indicator_labels(star), "indicator_id")
        .join(year_flags(star), "year")
        .join(star.dim("place").select("place_id", "state", "municipality"), "place_id")
    )


def by_municipality(star: Star) -> DataFrame:
    return _label_places(star, indicator_place_year(star)).select(
        *LABELS, "semantic_group", "state", "municipality", "year", "is_partial_year", "total"
    )


def by_indicator(star: Star, digits: int = 2) -> DataFrame:
    """Share of each indicator within its own family and year, never across units."""
    family_year = Window.partitionBy("family", "year")
    return (
        indicator_year_statistics(star)
        .join(indicator_labels(star), "indicator_id")
        .withColumn("family_year_total", F.sum("total").over(family_year))
        .withColumn("pct_of_family", percent("total", "family_year_total", digits))
        .select(
            *LABELS, "kind", "semantic_group", "year", "total", "mean", "median", "family_year_total", "pct_of_family"
        )
    )


def by_jurisdiction(star: Star) -> DataFrame:
    return (
        indicator_jurisdiction_year(star)
        .join(indicator_labels(star), "indicator_id")
        .join(star.dim("jurisdiction"), "jurisdiction_id")
        .select(*LABELS, "jurisdiction", "year", "total", "row_count")
    )


def _by_class(star: Star, name: str, per_indicator: bool = True) -> DataFrame:
    """Totals by a conditional class, over the rows the class applies to."""
    keys = [f"{name}_id", F.col("source_year").alias("year")] + (["indicator_id"] if per_indicator else [])
    totals = star.fact.where(F.col(f"{name}_id").isNotNull()).groupBy(*keys).agg(F.sum("value").alias("total"))
    totals = totals.join(star.dim(name), f"{name}_id")
    return totals.join(indicator_labels(star), "indicator_id") if per_indicator else totals


def by_sex(star: Star, digits: int = 2) -> DataFrame:
    """Shares sum to 100 per indicator and year."""
    whole = F.sum("total").over(Window.partitionBy("indicator_id", "year"))
    shared = _by_class(star, "sex").withColumn("pct", percent(F.col("total"), whole, digits))
    return shared.select("indicator", "kind", "year", "sex", "total", "pct")


def by_age_band(star: Star, digits: int = 2) -> DataFrame:
    shared = share_of(_by_class(star, "age_band"), "total", ["indicator_id", "year"], "share")
    pct = rounded(100 * F.col("share"), digits).alias("pct")
    return shared.select("indicator", "year", "age_band", "total", pct)


def by_agent(star: Star) -> DataFrame:
    return _by_class(star, "agent").select("indicator", "year", "agent", "total")


def by_weapon(star: Star) -> DataFrame:
    """Weapons ranked per year, across indicators."""
    totals = _by_class(star, "weapon", per_indicator=False)
    return window_rank(totals, ["year"], "total", "rank").select("year", "weapon", "total", "rank")


def victim_totals(star: Star) -> DataFrame:
    """The victim total that is never stored: the sum over all sexes, per indicator and month."""
    victims = indicator_labels(star).where(F.col("family") == "victim").select("indicator_id", "indicator")
    return (
        indicator_month(star)
        .join(victims, "indicator_id")
        .join(star.dim("time").select("time_id", "ref_month"), "time_id")
        .select("indicator", "ref_month", F.col("total").alias("victim_total"))
    )


# --- monthly series ----------------------------------------------------------


def monthly_series(star: Star) -> DataFrame:
    return (
        indicator_month(star)
        .join(indicator_labels(star), "indicator_id")
        .join(star.dim("time"), "time_id")
        .select(
            *LABELS, "semantic_group", "ref_month", "year", "month", "quarter", "month_name", "is_partial_year", "total"
        )
    )


def series_metrics(
    series: DataFrame, keys: list[str], calendar: bool = False, digits: int = 2
) -> DataFrame:
    """Previous month, month-over-month, 3-month moving mean and same month of the year before.

    `calendar=False` counts rows back (a missing month shifts the comparison), `calendar=True`
    counts months back (a missing month gives null). A series has one row per month.
    """
    if calendar:
        ordered = Window.partitionBy(*keys).orderBy(month_number("ref_month"))
        last_three = ordered.rangeBetween(-2, 0)

        def back(months: int) -> Column:
            return F.max("total").over(ordered.rangeBetween(-months, -months))
    else:
        ordered = Window.partitionBy(*keys).orderBy("ref_month")
        last_three = ordered.rowsBetween(-2, 0)

        def back(months: int) -> Column:
            return F.lag("total", months).over(ordered)

    change = F.col("total") - F.col("previous_month")
    return (
        series.withColumns(
            {
                "previous_month": back(1),
                "moving_mean_3": mean(F.sum("total").over(last_three), F.count("total").over(last_three)),
                "same_month_last_year": back(MONTHS_PER_FULL_YEAR),
            }
        )
        .withColumns(
            {
                "change": change,
                "pct_change": percent(change, "previous_month", digits),
                "pct_change_last_year": percent(
                    F.col("total") - F.col("same_month_last_year"), "same_month_last_year", digits
                ),
            }
        )
    )


def monthly_metrics(star: Star, calendar: bool = False, digits: int = 2) -> DataFrame:
    return series_metrics(monthly_series(star), ["indicator"], calendar, digits)


def comparable_cutoff(star: Star) -> DataFrame:
    """Last month all years reach: the least last month of the partial years, 12 if there are none."""
    last_months = (
        star.dim("time").where("is_partial_year").groupBy("year").agg(F.max("month").alias("last_month"))
    )
    return last_months.agg(F.coalesce(F.min("last_month"), F.lit(MONTHS_PER_FULL_YEAR)).alias("cutoff_month"))


def comparable_years(star: Star) -> DataFrame:
    """Totals of the months every year has."""
    return (
        monthly_series(star)
        .withColumn("months_included", comparable_cutoff(star).scalar())
        .where(F.col("month") <= F.col("months_included"))
        .groupBy(*LABELS, "year", "months_included")
        .agg(F.bool_or("is_partial_year").alias("is_partial_year"), F.sum("total").alias("comparable_total"))
    )


def deviation_from_history(star: Star, digits: int = 2) -> DataFrame:
    """z-score of each month against the whole history of its own indicator."""
    history = Window.partitionBy("indicator")
    return (
        monthly_series(star)
        .withColumns(
            {
                "historical_mean": mean(F.sum("total").over(history), F.count("total").over(history)),
                "historical_deviation": F.stddev_pop(number("total")).over(history),
            }
        )
        .withColumn(
            "z_score",
            rounded(ratio(number("total") - F.col("historical_mean"), "historical_deviation"), digits),
        )
        .select(
            *LABELS, "ref_month", "year", "month", "is_partial_year", "total",
            "historical_mean", "historical_deviation", "z_score",
        )
    )


# --- rankings ----------------------------------------------------------------


def state_ranking(star: Star) -> DataFrame:
    ranked = window_rank(by_state(star), ["indicator", "year"], "total", "rank")
    return ranked.select(*LABELS, "year", "is_partial_year", "state", "region", "total", "rank")


def municipality_ranking(star: Star) -> DataFrame:
    """Municipalities with a total above zero, from the stored order of places."""
    ranked = star.place_order.where(F.col("year").isNotNull() & (F.col("total") > 0))
    return (
        ranked.join(indicator_labels(star), "indicator_id")
        .join(year_flags(star), "year")
        .select(*LABELS, "year", "is_partial_year", "state", "municipality", "total", "rank")
    )


def region_ranking(star: Star) -> DataFrame:
    keys = [*LABELS, "year", "is_partial_year", "region"]
    totals = by_state(star).groupBy(*keys).agg(F.sum("total").alias("total"))
    return window_rank(totals, ["indicator", "year"], "total", "rank").select(*keys, "total", "rank")


def indicator_ranking(star: Star) -> DataFrame:
    """Indicators ranked within their semantic group and year."""
    totals = (
        indicator_place_year(star)
        .groupBy("indicator_id", "year")
        .agg(F.sum("total").alias("total"))
        .join(indicator_labels(star), "indicator_id")
    )
    ranked = window_rank(totals, ["semantic_group", "year"], "total", "rank")
    return ranked.select("semantic_group", "family", "unit", "year", "indicator", "total", "rank")


def jurisdiction_ranking(star: Star) -> DataFrame:
    ranked = window_rank(by_jurisdiction(star), ["indicator", "year"], "total", "rank")
    return ranked.select(*LABELS, "year", "jurisdiction", "total", "rank")


def state_share(star: Star, digits: int = 2) -> DataFrame:
    nationwide = F.sum("total").over(Window.partitionBy("indicator", "year"))
    return (
        by_state(star)
        .withColumn("pct_of_nation", percent(F.col("total"), nationwide, digits))
        .select(*LABELS, "year", "is_partial_year", "state", "region", "total", "pct_of_nation")
    )


# --- weights and outliers ----------------------------------------------------


def weight_percentiles(star: Star) -> DataFrame:
    """Count, sum, mean, percentiles and maximum of the weights, per indicator and year."""
    labels = star.dim("indicator").select("indicator_id", "indicator", "unit")
    return star.weight_year.join(labels, "indicator_id").select(
        "indicator", "year", "unit", "row_count", "total", "mean", "median", *UPPER_POINTS, "maximum"
    )


def outlier_impact(star: Star, digits: int = 1) -> DataFrame:
    """Outlier contrast per weight indicator, over all years."""
    names = star.dim("indicator").select("indicator_id", "indicator")
    return star.weight_contrast.join(names, "indicator_id").select(
        "indicator", "row_count", "rows_above_p99", "mean_with_outliers", "mean_without_top",
        "sum_with_outliers", "sum_without_top", pct_impact(digits),
    )


# --- quality -----------------------------------------------------------------


def quality_not_reported(star: Star, digits: int = 2) -> DataFrame:
    return not_reported(star.grain, star.dim("indicator"), digits)


def quality_summary(star: Star, digits: int = 2) -> DataFrame:
    """One row of coverage numbers; one aggregate per table."""
    partial = F.col("is_partial_year")
    time = star.dim("time").agg(
        F.struct(
            F.min("ref_month").alias("first_month"),
            F.max("ref_month").alias("last_month"),
            F.count_if(partial).alias("months_in_partial_years"),
            F.count_distinct(F.when(partial, F.col("year"))).alias("partial_years"),
        ).alias("t")
    )
    place = star.dim("place").agg(
        F.struct(
            F.count_distinct("state").alias("states"),
            F.count_distinct("municipality").alias("municipality_names"),
            F.count("*").alias("places"),
        ).alias("p")
    )
    missing = not_reported(star.grain, star.dim("indicator")).agg(F.avg("pct_missing").alias("m"))
    return (
        star.staging.agg(F.count("*").alias("staging_rows"))
        .withColumns(
            {
                "fact_rows": star.fact.agg(F.count("*").alias("n")).scalar(),
                "indicators": star.dim("indicator").agg(F.count_distinct("indicator").alias("n")).scalar(),
                "_place": place.scalar(),
                "_time": time.scalar(),
                "mean_pct_missing": rounded(missing.scalar(), digits),
            }
        )
        .select("staging_rows", "fact_rows", "indicators", "_place.*", "_time.*", "mean_pct_missing")
    )


# --- registry ----------------------------------------------------------------

VIEWS: dict[str, Callable[[Star], DataFrame]] = {
    "fact_enriched": enriched_fact,
    "agg_indicator_year": indicator_year_statistics,
    "agg_indicator_place_year": indicator_place_year,
    "agg_indicator_jurisdiction_year": indicator_jurisdiction_year,
    "year_flags": year_flags,
    "national": national,
    "by_state": by_state,
    "by_municipality": by_municipality,
    "by_indicator": by_indicator,
    "by_jurisdiction": by_jurisdiction,
    "by_sex": by_sex,
    "by_age_band": by_age_band,
    "by_agent": by_agent,
    "by_weapon": by_weapon,
    "agg_indicator_month": indicator_month,
    "monthly_series": monthly_series,
    "monthly_metrics": monthly_metrics,
    "comparable_cutoff": comparable_cutoff,
    "comparable_years": comparable_years,
    "deviation_from_history": deviation_from_history,
    "state_ranking": state_ranking,
    "municipality_ranking": municipality_ranking,
    "region_ranking": region_ranking,
    "indicator_ranking": indicator_ranking,
    "jurisdiction_ranking": jurisdiction_ranking,
    "state_share": state_share,
    "weight_percentiles": weight_percentiles,
    "outlier_impact": outlier_impact,
    "dim_indicator": indicator_labels,
    "quality_not_reported": quality_not_reported,
    "quality_summary": quality_summary,
}


def register_views(spark: SparkSession, star: Star, prefix: str = "") -> list[str]:
    """Register every view as a temporary view, all or none: all are analysed before the first is set."""
    frames = {f"{prefix}{name}": view(star) for name, view in VIEWS.items()}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)
