"""Dashboard measures as grouped functions: `measure(star, by, where)`.

A measure's filter context is written out: `by` lists the attributes of a row, `where` the selected
values, and shares and ranks take the `parent` or `within` attributes they are relative to.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.columns import join_groups, mean, number, ratio, rounded, share_of
from tallystar.operators.ordering import quantiles, rank_within, window_rank
from tallystar.operators.outliers import UPPER_POINTS, outlier_contrast, ratio_impact
from tallystar.plans import views
from tallystar.plans.star import Star
from tallystar.reference import (
    MIXED_UNITS,
    PARTIAL_PREFIX,
    QUALITY_LABELS,
    SEVERAL_INDICATORS,
    SEVERAL_YEARS,
)
from tallystar.schema import COUNT, VICTIM, WEIGHT

Filters = Mapping[str, object] | None

# Attribute -> the dimension that holds it.
ATTRIBUTES = {
    **dict.fromkeys(("ref_month", "year", "month", "quarter", "month_name", "is_partial_year"), "time"),
    **dict.fromkeys(("state", "municipality", "region"), "place"),
    **dict.fromkeys(("indicator", "family", "unit", "kind", "semantic_group"), "indicator"),
    "jurisdiction": "jurisdiction",
    "agent": "agent",
    "weapon": "weapon",
    "age_band": "age_band",
    "sex": "sex",
}
CONDITIONAL = ("agent", "weapon", "age_band", "sex")
# Attributes bounded by configuration or calendar: their ranks fit a window.
BOUNDED = (
    "state", "region", "indicator", "family", "unit", "kind", "semantic_group", "sex", "year", "month", "quarter",
    "jurisdiction", "agent", "weapon", "age_band",
)
# Attributes of whole years, which the sums per place and year can answer.
YEARLY = ("year", "is_partial_year")
# One of these among the keys keeps every total within one unit.
SINGLE_UNIT = ("indicator", "unit")


def _labels(star: Star, dim: str) -> DataFrame:
    return views.indicator_labels(star) if dim == "indicator" else star.dim(dim)


def _matches(column: str, wanted) -> Column:
    if isinstance(wanted, (list, tuple, set)):
        return F.col(column).isin(*wanted)
    return F.col(column) == F.lit(wanted)


@dataclass(frozen=True)
class Source:
    """A table that can answer a question: rows with ids, `total` and `row_count`, its time key and its partitions."""

    rows: DataFrame
    time_key: str
    year_column: str | None


def choose_source(star: Star, attributes: Iterable[str], per_value: bool = False) -> Source:
    """The smallest table whose keys cover the attributes: sums per month, per place and year, or the fact.

    The sums per place and year know no months, and their year is that of the feed; where that is not the
    calendar year, questions about years go to the fact.
    """
    dims = {ATTRIBUTES[a] for a in attributes}
    times = {a for a in attributes if ATTRIBUTES[a] == "time"}
    if not per_value:
        if dims <= {"indicator", "time"}:
            return Source(star.indicator_month, "time_id", None)
        if dims <= {"indicator", "place", "time"} and times <= set(YEARLY) and (star.years_agree or not times):
            return Source(star.place_year, "year", "year")
    rows = star.fact.withColumns({"total": F.col("value"), "row_count": F.lit(1)})
    return Source(rows, "time_id", "source_year" if star.years_agree else None)


def sliced(
    star: Star,
    attributes: Sequence[str],
    where: Filters = None,
    per_value: bool = False,
) -> DataFrame:
    """Sums by the attributes, within the filters, from the smallest table that holds them.

    Filters on indicators and times are looked up first: their ids and years prune files and partitions. Filters
    on other small dimensions reach the rows as semi-joins; a filter on places, which may be many, waits for the
    sums per id. Labels join those sums (`total`, `row_count`). `per_value=True` keeps each value apart, with
    `row_count` as its frequency.
    """
    where = dict(where or {})
    wanted = list(dict.fromkeys(attributes))
    unknown = [a for a in [*wanted, *where] if a not in ATTRIBUTES]
    if unknown:
        raise ValueError(f"unknown attributes {unknown}")
    source = choose_source(star, [*wanted, *where], per_value)

    def key(dim: str) -> str:
        return source.time_key if dim == "time" else f"{dim}_id"

    def filtered(dim: str, shown: Sequence[str] = ()) -> DataFrame:
        """Key and shown attributes of the members within the filters, each key once."""
        labels = _labels(star, dim)
        for attribute in where:
            if ATTRIBUTES[attribute] == dim:
                labels = labels.where(_matches(attribute, where[attribute]))
        columns = list(dict.fromkeys([key(dim), *shown]))
        return labels.select(*columns).distinct() if key(dim) == "year" else labels.select(*columns)

    filter_dims = dict.fromkeys(ATTRIBUTES[a] for a in where)
    dims = dict.fromkeys(ATTRIBUTES[a] for a in wanted) | ({"place": None} if "place" in filter_dims else {})
    rows = source.rows
    if "indicator" in filter_dims:
        wanted_ids = [row[0] for row in filtered("indicator").collect()]
        rows = rows.where(F.col("indicator_id").isin(wanted_ids))
        filter_dims.pop("indicator")
    if "time" in filter_dims and source.year_column is not None:
        times = _labels(star, "time")
        for attribute in where:
            if ATTRIBUTES[attribute] == "time":
                times = times.where(_matches(attribute, where[attribute]))
        years = [row[0] for row in times.select("year").distinct().collect()]
        rows = rows.where(F.col(source.year_column).isin(years))
    periods = [a for a in wanted if ATTRIBUTES[a] == "time"]
    if periods and "ref_month" not in periods:
        # Years and quarters are taken up before the sum: fewer sums per place to shuffle.
        rows = rows.join(filtered("time", periods), key("time"))
        dims.pop("time")
        filter_dims.pop("time", None)
    else:
        periods = []
    for dim in filter_dims:
        if dim != "place":
            rows = rows.join(filtered(dim), key(dim), "left_semi")

    per_row = periods + (["value"] if per_value else [])
    counted = [F.sum("row_count").alias("row_count")]
    sums = counted + ([] if per_value else [F.sum("total").alias("total")])
    rows = rows.groupBy(*[key(d) for d in dims], *per_row).agg(*sums)
    for dim in dims:
        shown = [a for a in wanted if ATTRIBUTES[a] == dim]
        how = "left" if dim in CONDITIONAL and dim not in filter_dims else "inner"
        rows = rows.join(filtered(dim, shown), key(dim), how)
    return rows.groupBy(*wanted, *(["value"] if per_value else [])).agg(*sums)


def unit_safe(keys: Sequence[str]) -> list[str]:
    """The keys, with the unit added when none of them keeps units apart."""
    keys = list(keys)
    return keys if any(k in SINGLE_UNIT for k in keys) else [*keys, "unit"]


# --- core --------------------------------------------------------------------


@dataclass(frozen=True)
class FilterContext:
    """What a number is looked at under: the attributes of its row and the filters, split by how they act.

    A filter on a dimension's own attributes restricts that dimension. Filters on other dimensions restrict the
    fact, and reach a dimension only if one asks which of its members the remaining fact rows hold.
    """

    by: tuple[str, ...]
    where: Mapping[str, object]

    def keys_of(self, dim: str) -> list[str]:
        return [a for a in dict.fromkeys(self.by) if ATTRIBUTES[a] == dim]

    def filters_on(self, dim: str) -> dict[str, object]:
        return {a: v for a, v in self.where.items() if ATTRIBUTES[a] == dim}

    def members(self, star: Star, dim: str) -> DataFrame:
        """The members a dimension's own filters leave, whether or not the fact holds them."""
        labels = _labels(star, dim)
        for attribute, wanted in self.filters_on(dim).items():
            labels = labels.where(_matches(attribute, wanted))
        return labels

    def members_held(self, star: Star, dim: str, attributes: Sequence[str]) -> DataFrame:
        """The members that the fact rows within all filters hold, per row of the context."""
        return sliced(star, [*self.by, *[a for a in attributes if a not in self.by]], self.where)


UNITS_FROM = ("dimension", "fact")


def core(star: Star, by: Sequence[str] = (), where: Filters = None, units_from: str = "dimension") -> DataFrame:
    """Totals, counts, units in context, unit-safe total, totals per family and selection labels.

    `units_from="dimension"` counts the units of the indicators that the filters on indicators leave; a filter on
    a place does not reach them. `units_from="fact"` counts the units of the fact rows within all filters.
    """
    if units_from not in UNITS_FROM:
        raise ValueError(f"units_from has to be one of {list(UNITS_FROM)}")
    context = FilterContext(tuple(dict.fromkeys(by)), dict(where or {}))
    by = list(context.by)
    # Copies, so that attributes named in `by` can be aggregated too.
    copies = {"_indicator": F.col("indicator"), "_family": F.col("family"), "_unit": F.col("unit")}
    rows = context.members_held(star, "indicator", ["indicator", "family", "unit"]).withColumns(copies)

    def of_family(family: str) -> Column:
        return F.sum(F.when(F.col("_family") == family, F.col("total")))

    selected = [
        F.count_distinct("_unit").alias("distinct_units"),
        F.count_distinct("_indicator").alias("_indicators"),
        F.min("_indicator").alias("_one_indicator"),
        F.min("_unit").alias("_one_unit"),
    ]
    totals = rows.groupBy(*by).agg(
        F.sum("total").alias("total_value"),
        F.sum("row_count").alias("row_count"),
        of_family(VICTIM).alias("victim_total"),
        of_family(COUNT).alias("count_total"),
        of_family(WEIGHT).alias("weight_total"),
        *(selected if units_from == "fact" else []),
    )
    if units_from == "dimension":
        keys = context.keys_of("indicator")
        members = context.members(star, "indicator").withColumns(copies).groupBy(*keys).agg(*selected)
        totals = join_groups(totals, members, keys)
    one_unit = F.col("distinct_units") == 1
    return totals.withColumns(
        {
            "safe_total": F.when(F.col("distinct_units") <= 1, F.col("total_value")),
            "selected_indicator": F.when(F.col("_indicators") == 1, F.col("_one_indicator")).otherwise(SEVERAL_INDICATORS),
            "selected_unit": F.when(one_unit, F.col("_one_unit")).otherwise(MIXED_UNITS),
        }
    ).drop("_indicators", "_one_indicator", "_one_unit")


# --- time --------------------------------------------------------------------


def _is_time(attribute: str) -> bool:
    return ATTRIBUTES.get(attribute) == "time"


def _months(star: Star, by: Sequence[str], where: Filters) -> tuple[list[str], DataFrame]:
    """Keys and whole monthly series: time attributes neither split nor cut a series."""
    keys = unit_safe([b for b in by if not _is_time(b)])
    return keys, sliced(star, [*keys, "ref_month"], {a: v for a, v in (where or {}).items() if not _is_time(a)})


def _shown(star: Star, metrics: DataFrame, by: Sequence[str], where: Filters) -> DataFrame:
    """The selected months of computed series, with the time attributes of `by`."""
    periods = [b for b in dict.fromkeys(by) if _is_time(b) and b != "ref_month"]
    selected = {a: v for a, v in (where or {}).items() if _is_time(a)}
    if not periods and not selected:
        return metrics
    times = star.dim("time")
    for attribute, wanted in selected.items():
        times = times.where(_matches(attribute, wanted))
    return metrics.join(times.select("ref_month", *periods), "ref_month")


def calendar_metrics(star: Star, by: Sequence[str] = ("indicator",), where: Filters = None, digits: int = 6) -> DataFrame:
    """Previous month, month-over-month, same month of the year before and 3-month mean, by calendar.

    Time filters and time attributes choose the months shown; the comparisons reach beyond them.
    """
    keys, months = _months(star, by, where)
    metrics = _shown(star, views.series_metrics(months, keys, calendar=True, digits=digits), by, where)
    keys = [*keys, *[b for b in dict.fromkeys(by) if _is_time(b) and b != "ref_month"]]
    # Measures are plain ratios; the views show percentages.
    change_last_year = F.col("total") - F.col("same_month_last_year")
    return metrics.select(
        *keys,
        "ref_month",
        "total",
        "previous_month",
        "change",
        rounded(ratio("change", "previous_month"), digits).alias("ratio_change"),
        "same_month_last_year",
        rounded(ratio(change_last_year, "same_month_last_year"), digits).alias("ratio_change_last_year"),
        "moving_mean_3",
    )


def comparable_total(star: Star, by: Sequence[str] = ("indicator", "year"), where: Filters = None) -> DataFrame:
    """Totals over the months every year has, with the cut-off month; the year stays a key."""
    keys = unit_safe(by)
    months = sliced(star, [*keys, *[a for a in ("month",) if a not in keys]], where)
    return (
        months.withColumn("cutoff_month", views.comparable_cutoff(star).scalar())
        .where(F.col("month") <= F.col("cutoff_month"))
        .groupBy(*keys, "cutoff_month")
        .agg(F.sum("total").alias("comparable_total"))
    )


def year_labels(star: Star) -> DataFrame:
    """Label of each selected year, and of the selection of several (null year)."""
    last = F.date_format(F.max("ref_month"), "MMM")
    year = F.col("year").cast("string")
    single = (
        star.dim("time")
        .groupBy("year", "is_partial_year")
        .agg(last.alias("_last"))
        .select(
            "year",
            F.when(F.col("is_partial_year"), F.concat(F.lit(PARTIAL_PREFIX), F.col("_last"), F.lit("/"), year))
            .otherwise(year)
            .alias("label"),
        )
    )
    several = star.dim("time").agg(F.count_distinct("year").alias("_years")).where(F.col("_years") > 1)
    return single.unionByName(several.select(F.lit(None).cast("int").alias("year"), F.lit(SEVERAL_YEARS).alias("label")))


# --- ranks and shares --------------------------------------------------------


def dense_ranking(star: Star, item: str, within: Sequence[str] = ("indicator",), where: Filters = None) -> DataFrame:
    """Dense rank of the items by total; equal totals share a rank and leave no gap."""
    keys = unit_safe(within)
    totals = sliced(star, list(dict.fromkeys([*keys, item])), where)
    rank_keys = [k for k in keys if k != item]
    rank = window_rank if item in BOUNDED else rank_within
    return rank(totals, rank_keys, "total", "rank", dense=True).drop("row_count")


def share(
    star: Star, item: str, parent: Sequence[str] = ("indicator",), where: Filters = None, digits: int = 6
) -> DataFrame:
    """Part of each item in the total of its parent; for parents of any size."""
    keys = unit_safe(parent)
    totals = sliced(star, list(dict.fromkeys([*keys, item])), where)
    shared = share_of(totals, "total", keys, "share", "parent_total")
    return shared.withColumn("share", rounded(F.col("share"), digits)).drop("row_count")


def indicator_share_of_family(star: Star, by: Sequence[str] = (), where: Filters = None, digits: int = 6) -> DataFrame:
    """Part of each indicator in its own family, never in the overall total."""
    totals = sliced(star, list(dict.fromkeys([*by, "indicator", "family"])), where)
    shared = share_of(totals, "total", [*by, "family"], "share", "parent_total")
    return shared.withColumn("share", rounded(F.col("share"), digits)).drop("row_count")


# --- statistics --------------------------------------------------------------


def weight_statistics(star: Star, by: Sequence[str] = (), where: Filters = None) -> DataFrame:
    """Median, P90, P95, P99 and maximum of the weight family."""
    points = {"median": 0.5} | UPPER_POINTS | {"maximum": 1.0}
    return _weight_points(_weight_values(star, by, where), list(by), points)


def _weight_values(star: Star, by: Sequence[str], where: Filters) -> DataFrame:
    return sliced(star, list(by), {**(where or {}), "family": WEIGHT}, per_value=True)


def _weight_points(values: DataFrame, keys: list[str], points: dict[str, float]) -> DataFrame:
    return quantiles(values, keys, "value", points, "row_count")


def weight_outliers(star: Star, by: Sequence[str] = ("indicator",), where: Filters = None, digits: int = 6) -> DataFrame:
    """Mean of the weights with and without the top 1% of their group, and the ratio between them."""
    keys = list(by)
    values = _weight_values(star, keys, where)
    limits = _weight_points(values, keys, {"p99": 0.99})
    contrast = outlier_contrast(values, limits, keys, "row_count")
    return contrast.select(
        *keys, "mean_with_outliers", "mean_without_top", rounded(ratio_impact(), digits).alias("ratio_impact")
    )


def history(star: Star, by: Sequence[str] = ("indicator",), where: Filters = None, digits: int = 6) -> DataFrame:
    """Each month against the mean and the population deviation of all months of its group.

    Time filters and time attributes choose the months shown, never the months compared with.
    """
    keys, months = _months(star, by, where)
    all_months = Window.partitionBy(*keys)
    scored = (
        months.withColumns(
            {
                "historical_mean": mean(F.sum("total").over(all_months), F.count("total").over(all_months)),
                "historical_deviation": F.stddev_pop(number("total")).over(all_months),
            }
        )
        .withColumn(
            "z_score",
            rounded(ratio(number("total") - F.col("historical_mean"), "historical_deviation"), digits),
        )
    )
    keys = [*keys, *[b for b in dict.fromkeys(by) if _is_time(b) and b != "ref_month"]]
    return _shown(star, scored, by, where).select(
        *keys, "ref_month", "total", "historical_mean", "historical_deviation", "z_score"
    )


# --- quality -----------------------------------------------------------------


def quality_totals(star: Star) -> DataFrame:
    return views.quality_summary(star).select(
        "staging_rows",
        "fact_rows",
        "indicators",
        "states",
        F.col("municipality_names").alias("municipalities"),
        "months_in_partial_years",
    )


def not_reported_ratio(star: Star, by: Sequence[str] = ("indicator",), digits: int = 6) -> DataFrame:
    """Ratio of the sums of missing and applicable cells; `by` is empty, indicator or family."""
    return (
        views.quality_not_reported(star)
        .groupBy(*by)
        .agg(F.sum("missing_cells").alias("_missing"), F.sum("applicable_cells").alias("_cells"))
        .select(*by, rounded(ratio("_missing", "_cells"), digits).alias("ratio_missing"))
    )


def quality_status(star: Star, by: Sequence[str] = ("indicator",)) -> DataFrame:
    """Good up to 10% not reported, to watch up to 25%, serious above.

    By indicator, those without any rows are listed as having no data.
    """
    value = F.col("ratio_missing")
    status = (
        F.when(value.isNull(), QUALITY_LABELS["none"])
        .when(value <= 0.10, QUALITY_LABELS["good"])
        .when(value <= 0.25, QUALITY_LABELS["watch"])
        .otherwise(QUALITY_LABELS["serious"])
    )
    rows = not_reported_ratio(star, by)
    if list(by) == ["indicator"]:
        rows = star.dim("indicator").select("indicator").join(rows, "indicator", "left")
    return rows.withColumn("status", status)


# --- dashboard pages ---------------------------------------------------------


def group_totals(star: Star, where: Filters = None) -> DataFrame:
    """One total per semantic group and unit."""
    return sliced(star, ["semantic_group", "unit"], where).select("semantic_group", "unit", "total")


def group_distribution(star: Star, where: Filters = None) -> DataFrame:
    """Number of indicators and of rows per semantic group: counts compare across units."""
    rows = sliced(star, ["semantic_group", "indicator"], where)
    return rows.groupBy("semantic_group").agg(
        F.count_distinct("indicator").alias("indicators"), F.sum("row_count").alias("row_count")
    )


def top_states(star: Star, indicator: str, n: int = 5, where: Filters = None) -> DataFrame:
    totals = sliced(star, ["state"], {**(where or {}), "indicator": indicator}).select("state", "total")
    return totals.orderBy(F.desc("total"), "state").limit(n)


def group_series(star: Star, where: Filters = None) -> DataFrame:
    """Monthly series per semantic group and unit."""
    return sliced(star, ["semantic_group", "unit", "ref_month"], where).select(
        "semantic_group", "unit", "ref_month", "total"
    )


def largest_deviations(star: Star, above: float = 2.0, n: int | None = None, digits: int = 2) -> DataFrame:
    """Months further than `above` deviations from the mean; the `n` furthest when asked for."""
    rows = views.deviation_from_history(star, digits).where(F.abs("z_score") > F.lit(above))
    if n is None:
        return rows
    return rows.orderBy(F.abs("z_score").desc(), "indicator", "ref_month").limit(n)


def strongest_changes(star: Star, falling: bool = False, n: int = 5, digits: int = 2) -> DataFrame:
    """Largest growths, or falls, against the same month of the year before."""
    change = F.col("pct_change_last_year")
    order = change.asc_nulls_last() if falling else change.desc_nulls_last()
    return (
        views.monthly_metrics(star, digits=digits)
        .select("indicator", "ref_month", "total", "same_month_last_year", "pct_change_last_year")
        .orderBy(order, "indicator", "ref_month")
        .limit(n)
    )


LEVELS = {
    "country": [],
    "region": ["region"],
    "state": ["region", "state"],
    "municipality": ["region", "state", "municipality"],
}


def drill_down(star: Star, level: str, by: Sequence[str] = ("indicator",), where: Filters = None) -> DataFrame:
    """Totals at one level of country, region, state, municipality."""
    if level not in LEVELS:
        raise ValueError(f"level has to be one of {list(LEVELS)}")
    keys = unit_safe([*by, *LEVELS[level]])
    return sliced(star, keys, where).select(*keys, "total", "row_count")


