"""The parameterised read queries.

Filters reach the fact before it is summed: the indicator and the year prune files and partitions,
the others are semi-joins with the filtered dimension. Labels join the sums. Questions the stored sums
per month or per place and year can answer do not read the fact at all. Names, units, years and sizes come from
the star's lookup, so a query is checked and returned without a job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.errors import NotEnoughDataError, NotFoundError
from tallystar.functions import arguments
from tallystar.functions.columns import rounded
from tallystar.operators.ordering import window_rank
from tallystar.plans import views
from tallystar.plans.star import Star

# Largest and default sizes of the results.
MAX_PAGE_SIZE, PAGE_SIZE = 100, 50
MAX_MUNICIPALITIES, TOP, RADAR = 100, 10, 50


def _times(star: Star, year=None, year_from=None, year_to=None, month=None) -> DataFrame | None:
    conditions = []
    if year is not None:
        conditions.append(F.col("year") == F.lit(year))
    if year_from is not None:
        conditions.append(F.col("year") >= F.lit(year_from))
    if year_to is not None:
        conditions.append(F.col("year") <= F.lit(year_to))
    if month is not None:
        conditions.append(F.col("month") == F.lit(month))
    if not conditions:
        return None
    times = star.dim("time")
    for condition in conditions:
        times = times.where(condition)
    return times.select("time_id")


def _fact(star: Star, indicator_id=None, jurisdiction=None, **period) -> DataFrame:
    """Fact rows of an indicator, a jurisdiction and a period; absent arguments add no predicate."""
    fact = star.fact
    if indicator_id is not None:
        fact = fact.where(F.col("indicator_id") == F.lit(indicator_id))
    times = _times(star, **period)
    if times is not None:
        fact = fact.join(times, "time_id", "left_semi")
    if star.years_agree:
        first = period.get("year") or period.get("year_from")
        last = period.get("year") or period.get("year_to")
        if first is not None:
            fact = fact.where(F.col("source_year") >= F.lit(first))
        if last is not None:
            fact = fact.where(F.col("source_year") <= F.lit(last))
    if jurisdiction is not None:
        # An unknown jurisdiction has no id, and no rows.
        fact = fact.where(F.col("jurisdiction_id") == F.lit(star.lookup.jurisdictions.get(jurisdiction)))
    return fact


def _places(star: Star, state=None, municipality=None, region=None) -> DataFrame:
    places = star.dim("place")
    for column, value in (("state", state), ("municipality", municipality), ("region", region)):
        if value is not None:
            places = places.where(F.col(column) == F.lit(value))
    return places


def _in_places(rows: DataFrame, places: DataFrame | None) -> DataFrame:
    return rows if places is None else rows.join(places.select("place_id"), "place_id", "left_semi")


def _place_rows(star: Star, indicator_id=None, jurisdiction=None, year=None, month=None) -> DataFrame:
    """`value` and `row_count` by indicator and place, to be summed: stored sums, or fact rows."""
    if jurisdiction is not None or month is not None or (year is not None and not star.years_agree):
        fact = _fact(star, indicator_id, jurisdiction, year=year, month=month)
        return fact.select("indicator_id", "place_id", "value", F.lit(1).alias("row_count"))
    stored = star.place_year.withColumnRenamed("total", "value")
    for column, wanted in (("indicator_id", indicator_id), ("year", year)):
        if wanted is not None:
            stored = stored.where(F.col(column) == F.lit(wanted))
    return stored


def _state(star: Star, state):
    return arguments.state_code(state, star.reference.state_code_length)


def _year(star: Star, name: str, value):
    return arguments.year(name, value, star.reference.year_bounds)


# --- indicators --------------------------------------------------------------


@dataclass(frozen=True)
class Page:
    """A page of rows; `total` is the lazy one-row count of all of them."""

    rows: DataFrame
    total: DataFrame
    page: int
    page_size: int


def list_indicators(star: Star) -> DataFrame:
    """All indicators by name; `total` repeats their number."""
    labels = views.indicator_labels(star)
    return labels.withColumn("total", star.dim("indicator").agg(F.count("*").alias("n")).scalar()).orderBy("indicator")


def _known(star: Star, indicator_id: int) -> tuple[str, str]:
    arguments.whole("indicator_id", arguments.required("indicator_id", indicator_id), -(2**31), 2**31 - 1)
    if indicator_id not in star.lookup.indicators:
        raise NotFoundError(f"no indicator {indicator_id}")
    return star.lookup.indicators[indicator_id]


def get_indicator(star: Star, indicator_id: int) -> DataFrame:
    _known(star, indicator_id)
    return views.indicator_labels(star).where(F.col("indicator_id") == F.lit(indicator_id))


def _the_indicator(star: Star, indicator_id: int) -> list[Column]:
    """Name and unit of the one indicator a result is about: a number never stands without them."""
    name, unit = _known(star, indicator_id)
    return [F.lit(name).alias("indicator"), F.lit(unit).alias("unit")]


# --- totals and series -------------------------------------------------------


def kpis(star: Star, indicator_id=None, state=None, municipality=None, year=None, jurisdiction=None) -> DataFrame:
    """Sum and row count per indicator, never across indicators."""
    state, year = _state(star, state), _year(star, "year", year)
    places = _places(star, state, municipality) if state or municipality else None
    sums = _in_places(_place_rows(star, indicator_id, jurisdiction, year), places)
    return (
        sums.groupBy("indicator_id")
        .agg(F.sum("value").alias("value"), F.sum("row_count").alias("row_count"))
        .join(star.dim("indicator"), "indicator_id")
        .select("indicator_id", "indicator", "family", "unit", "value", "row_count")
        .orderBy("indicator")
    )


def temporal(
    star: Star, indicator_id: int, state=None, municipality=None, jurisdiction=None, year_from=None, year_to=None
) -> DataFrame:
    """Monthly sums of one indicator."""
    state = _state(star, state)
    year_from, year_to = _year(star, "year_from", year_from), _year(star, "year_to", year_to)
    indicator = _the_indicator(star, indicator_id)
    places = _places(star, state, municipality) if state or municipality else None
    if places is None and jurisdiction is None:
        months = star.indicator_month.where(F.col("indicator_id") == F.lit(indicator_id))
        times = _times(star, year_from=year_from, year_to=year_to)
        months = months if times is None else months.join(times, "time_id", "left_semi")
        months = months.withColumnRenamed("total", "value")
    else:
        fact = _fact(star, indicator_id, jurisdiction, year_from=year_from, year_to=year_to)
        months = _in_places(fact, places).groupBy("time_id").agg(F.sum("value").alias("value"))
    return (
        months
        .join(star.dim("time"), "time_id")
        .groupBy("year", "month")
        .agg(F.sum("value").alias("value"), F.bool_or("is_partial_year").alias("is_partial_year"))
        .select(*indicator, "year", "month", "value", "is_partial_year")
        .orderBy("year", "month")
    )


def year_over_year(
    star: Star, indicator_id: int, base_year: int | None = None, comparison_year: int | None = None, digits: int = 2
) -> DataFrame:
    """Two years over the months both have; by default the last year against the one before.

    The last year is the last with any row, also when the cut-off month leaves none of its rows.
    """
    arguments.whole("base_year", base_year, 0)
    arguments.whole("comparison_year", comparison_year, 0)
    name, unit = _the_indicator(star, indicator_id)
    lookup = star.lookup
    if comparison_year is None:
        if not lookup.years(indicator_id):
            raise NotEnoughDataError(f"indicator {indicator_id} has no rows")
        comparison_year = lookup.years(indicator_id)[-1]
    if base_year is None:
        base_year = comparison_year - 1
    if not all(lookup.comparable(indicator_id, year) for year in (base_year, comparison_year)):
        raise NotEnoughDataError(f"not enough data to compare {base_year} and {comparison_year}")

    months = star.dim("time").where(F.col("year").isin(base_year, comparison_year) & (F.col("month") <= F.lit(lookup.cutoff_month)))
    pair = star.indicator_month.where(F.col("indicator_id") == F.lit(indicator_id)).join(months, "time_id")

    def total(year: int) -> Column:
        return F.sum(F.when(F.col("year") == year, F.col("total")))

    base, other = F.col("base_value"), F.col("comparison_value")
    return (
        pair.agg(
            total(base_year).alias("base_value"),
            total(comparison_year).alias("comparison_value"),
            F.bool_or("is_partial_year").alias("partial_period"),
        )
        .select(
            F.lit(indicator_id).alias("indicator_id"),
            name,
            unit,
            F.lit(base_year).alias("base_year"),
            F.lit(comparison_year).alias("comparison_year"),
            "base_value",
            "comparison_value",
            (other - base).alias("change"),
            rounded(F.try_divide((other - base).cast("double"), base.cast("double")) * 100, digits).alias("pct_change"),
            F.lit(lookup.cutoff_month).alias("months_compared"),
            "partial_period",
        )
    )


# --- geography ---------------------------------------------------------------


def by_state(star: Star, indicator_id: int, year=None, month=None, region=None, jurisdiction=None) -> DataFrame:
    year, month = _year(star, "year", year), arguments.month(month)
    indicator = _the_indicator(star, indicator_id)
    rows = _place_rows(star, indicator_id, jurisdiction, year, month)
    per_place = rows.groupBy("place_id").agg(F.sum("value").alias("value"))
    return (
        per_place.join(_places(star, region=region), "place_id")
        .groupBy("state", "region")
        .agg(F.sum("value").alias("value"))
        .select(*indicator, "state", "region", "value")
        .orderBy(F.desc("value"), "state", "region")
    )


def by_municipality(star: Star, indicator_id: int, state=None, year=None, page=1, page_size=PAGE_SIZE) -> Page:
    """One page of municipalities by descending value, and the number of all of them.

    The order is stored, so a page is a filtered read of its own rows, however far back it lies. `year` is the
    year of the feed, as in the stored sums.
    """
    state, year = _state(star, state), _year(star, "year", year)
    arguments.whole("page", arguments.required("page", page), 1)
    arguments.whole("page_size", arguments.required("page_size", page_size), 1, MAX_PAGE_SIZE)
    indicator = _the_indicator(star, indicator_id)
    place = "position" if state is None else "state_position"
    listed = _ordered_places(star, indicator_id, year)
    if state is not None:
        listed = listed.where(F.col("state") == F.lit(state))
    first = (page - 1) * page_size
    rows = listed.where(F.col(place).between(first + 1, first + page_size)).orderBy(place).limit(page_size)
    shown = rows.select(*indicator, "state", "municipality", F.col("total").alias("value"))
    return Page(shown, listed.agg(F.count("*").alias("total")), page, page_size)


def _ordered_places(star: Star, indicator_id: int, year: int | None) -> DataFrame:
    """The stored order of an indicator's places in a year, or over all years."""
    of_year = F.col("year").isNull() if year is None else F.col("year") == F.lit(year)
    return star.place_order.where((F.col("indicator_id") == F.lit(indicator_id)) & of_year)


# --- rankings ----------------------------------------------------------------


def _top(totals: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """First rows of a ranking; ranks of the first rows need no other rows."""
    order = [F.desc("value"), *[F.asc(k) for k in keys]]
    first = totals.orderBy(*order).limit(limit)
    return window_rank(first, [], "value", "rank").orderBy("rank", *keys)


def ranking_of_states(star: Star, indicator_id: int, year: int, limit: int = TOP) -> DataFrame:
    _year(star, "year", arguments.required("year", year))
    arguments.whole("limit", limit, 1, star.lookup.states)
    indicator = _the_indicator(star, indicator_id)
    totals = _place_year(star, indicator_id, year).join(star.dim("place"), "place_id")
    totals = totals.groupBy("state", "region").agg(F.sum("total").alias("value"))
    return _top(totals, ["state", "region"], limit).select(*indicator, "rank", "state", "region", "value")


def ranking_of_municipalities(star: Star, indicator_id: int, year: int, limit: int = TOP) -> DataFrame:
    """The first municipalities with a total above zero, equal totals by state and name."""
    _year(star, "year", arguments.required("year", year))
    arguments.whole("limit", limit, 1, MAX_MUNICIPALITIES)
    indicator = _the_indicator(star, indicator_id)
    # Ranks are at most positions, so the first `limit` rows by (rank, state, name) have such a rank.
    listed = _ordered_places(star, indicator_id, year).where((F.col("total") > 0) & (F.col("rank") <= F.lit(limit)))
    return (
        listed.orderBy("rank", "state", "municipality")
        .limit(limit)
        .select(*indicator, "rank", "state", "municipality", F.col("total").alias("value"))
    )


def _place_year(star: Star, indicator_id: int, year: int) -> DataFrame:
    wanted = (F.col("indicator_id") == F.lit(indicator_id)) & (F.col("year") == F.lit(year))
    return views.indicator_place_year(star).where(wanted)


def ranking_of_indicators(star: Star, group: str, year: int, limit: int = TOP) -> DataFrame:
    arguments.one_of("group", group, star.reference.group_names)
    _year(star, "year", arguments.required("year", year))
    arguments.whole("limit", limit, 1, len(star.lookup.indicators))
    return (
        views.indicator_ranking(star)
        .where((F.col("semantic_group") == F.lit(group)) & (F.col("year") == F.lit(year)))
        .select("rank", "indicator", "semantic_group", F.col("total").alias("value"))
        .orderBy("rank", "indicator")
        .limit(limit)
    )


def radar(star: Star, indicator_id=None, year=None, min_abs_z=None, limit: int = RADAR, digits: int = 2) -> DataFrame:
    """Months furthest from the history of their indicator; z-scores compare across units."""
    _year(star, "year", year)
    arguments.within("min_abs_z", min_abs_z, 0)
    # At most every indicator in every month.
    arguments.whole("limit", limit, 1, len(star.lookup.indicators) * star.lookup.months)
    rows = views.deviation_from_history(star, digits)
    if indicator_id is not None:
        wanted = star.dim("indicator").where(F.col("indicator_id") == F.lit(indicator_id)).select("indicator")
        rows = rows.join(wanted, "indicator", "left_semi")
    if year is not None:
        rows = rows.where(F.col("year") == F.lit(year))
    if min_abs_z is not None:
        rows = rows.where(F.abs("z_score") >= F.lit(min_abs_z))
    return (
        rows.select(
            "indicator", "year", "month", F.col("total").alias("value"),
            "historical_mean", "historical_deviation", "z_score",
        )
        .orderBy(F.abs("z_score").desc_nulls_last(), "indicator", "year", "month")
        .limit(limit)
    )


# --- metadata ----------------------------------------------------------------


def overview(star: Star) -> DataFrame:
    """First and last month, whether a year is partial, and coverage counts."""
    return views.quality_summary(star).select(
        F.date_format("first_month", "yyyy-MM").alias("first_month"),
        F.date_format("last_month", "yyyy-MM").alias("last_month"),
        (F.col("partial_years") > 0).alias("has_partial_year"),
        "indicators",
        "states",
        F.col("municipality_names").alias("municipalities"),
    )


def list_states(star: Star) -> DataFrame:
    return star.dim("place").select("state", "region").distinct().orderBy("state")


def list_years(star: Star) -> DataFrame:
    return star.dim("time").select("year").distinct().orderBy("year")


def list_jurisdictions(star: Star) -> DataFrame:
    return star.dim("jurisdiction").select("jurisdiction").orderBy("jurisdiction")


def list_municipalities(star: Star, state: str | None = None) -> DataFrame:
    return _places(star, _state(star, state)).select("state", "municipality").orderBy("state", "municipality")
