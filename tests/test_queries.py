from dataclasses import replace

import pytest
from conftest import counts_rows, star_of

from tallystar.errors import ArgumentError, NotEnoughDataError, NotFoundError
from tallystar.plans import queries


@pytest.fixture(scope="module")
def cargo(spark):
    """One indicator in four states, a full year and three months of the next."""
    star = star_of(spark, {2030: counts_rows(2030, 12), 2031: counts_rows(2031, 3)})
    name = "Roubo de carga"
    return star, star.dim("indicator").where(f"indicator = '{name}'").first().indicator_id


def test_indicator_list_and_detail(cargo):
    star, number = cargo
    rows = queries.list_indicators(star).collect()
    assert len(rows) == 31 and {r.total for r in rows} == {31} and [r.indicator for r in rows] == sorted(r.indicator for r in rows)
    found = queries.get_indicator(star, number).first()
    assert (found.indicator, found.family, found.unit, found.semantic_group) == ("Roubo de carga", "count", "ocorrências", "Ocorrências")
    with pytest.raises(NotFoundError):
        queries.get_indicator(star, 999_999)
    with pytest.raises(ArgumentError):
        queries.get_indicator(star, "nine")


@pytest.mark.parametrize(
    "call",
    [
        lambda s: queries.temporal(s, 999_999),
        lambda s: queries.year_over_year(s, 999_999),
        lambda s: queries.by_state(s, 999_999),
        lambda s: queries.by_municipality(s, 999_999),
        lambda s: queries.ranking_of_states(s, 999_999, 2030),
        lambda s: queries.ranking_of_municipalities(s, 999_999, 2030),
    ],
)
def test_unknown_indicator(cargo, call):
    with pytest.raises(NotFoundError):
        call(cargo[0])


@pytest.mark.parametrize(
    "call",
    [
        lambda s: queries.kpis(s, state="SAO"),
        lambda s: queries.kpis(s, year=1999),
        lambda s: queries.temporal(s, 1, year_from=2101),
        lambda s: queries.by_state(s, 1, month=13),
        lambda s: queries.by_municipality(s, 1, page=0),
        lambda s: queries.by_municipality(s, 1, page_size=101),
        lambda s: queries.ranking_of_states(s, 1, 2030, limit=28),
        lambda s: queries.ranking_of_states(s, 1, None),
        lambda s: queries.ranking_of_municipalities(s, 1, 2030, limit=101),
        lambda s: queries.ranking_of_indicators(s, "Outro", 2030),
        lambda s: queries.ranking_of_indicators(s, "Vítimas", 2030, limit=32),
        lambda s: queries.radar(s, min_abs_z=-1),
        lambda s: queries.radar(s, limit=931),
    ],
)
def test_argument_rules(cargo, call):
    with pytest.raises(ArgumentError):
        call(cargo[0])


def test_kpis(cargo):
    star, number = cargo
    rows = queries.kpis(star, number, state="sp", year=2030).collect()
    assert [(r.indicator_id, float(r.value), r.row_count, r.unit) for r in rows] == [(number, 12 * 5.0, 24, "ocorrências")]
    assert queries.kpis(star, state="AC").isEmpty()


def test_series_flags_the_partial_year(cargo):
    star, number = cargo
    rows = queries.temporal(star, number, year_from=2031).collect()
    assert [(r.month, r.is_partial_year) for r in rows] == [(1, True), (2, True), (3, True)]
    full = queries.temporal(star, number, municipality="A", year_to=2030).collect()
    assert len(full) == 12 and not any(r.is_partial_year for r in full) and {float(r.value) for r in full} == {4.0 + 3 + 3}


def test_year_over_year_compares_the_same_months(cargo):
    star, number = cargo
    found = queries.year_over_year(star, number).first()
    assert (found.base_year, found.comparison_year, found.months_compared, found.partial_period) == (2030, 2031, 3, True)
    assert float(found.base_value) == float(found.comparison_value) and found.pct_change == 0.0
    with pytest.raises(NotEnoughDataError):
        queries.year_over_year(star, number, 2020, 2031)
    empty = star.dim("indicator").where("indicator = 'Suicídio'").first().indicator_id
    with pytest.raises(NotEnoughDataError):
        queries.year_over_year(star, empty)


def test_year_over_year_from_a_zero_base(spark):
    star = star_of(spark, {2030: counts_rows(2030, 12, scale=0.0), 2031: counts_rows(2031, 12)})
    number = star.dim("indicator").where("indicator = 'Roubo de carga'").first().indicator_id
    found = queries.year_over_year(star, number, 2030, 2031).first()
    assert found.pct_change is None and float(found.change) > 0 and not found.partial_period


def test_states_descend(cargo):
    star, number = cargo
    rows = queries.by_state(star, number, year=2030, month=1).collect()
    assert [(r.state, float(r.value)) for r in rows] == [("SP", 5.0), ("MG", 3.0), ("RJ", 3.0)]
    assert [r.state for r in queries.by_state(star, number, region="Sul").collect()] == []


def test_pages_cover_all_rows_once(cargo):
    star, number = cargo
    pages = [queries.by_municipality(star, number, page=p, page_size=2) for p in (1, 2, 3)]
    rows = [(r.state, r.municipality, float(r.value)) for page in pages for r in page.rows.collect()]
    assert rows == [("SP", "A", 60.0), ("MG", "A", 45.0), ("RJ", "A", 45.0), ("SP", "B", 15.0)]
    assert pages[0].total.first().total == 4 and pages[2].rows.isEmpty()


def test_stored_sums_and_the_fact_agree(feed_context):
    """A year filter reads stored sums only once source years are known to be calendar years."""
    star = feed_context.star
    assert star.years_agree
    unknown = replace(star, years_agree=False)
    for query in (
        lambda s: queries.kpis(s, state="NATION_3", year=1998),
        lambda s: queries.by_state(s, 3, year=1998),
        lambda s: queries.by_municipality(s, 3, year=1998).rows,
        lambda s: queries.by_municipality(s, 3, year=1998).total,
        lambda s: queries.temporal(s, 3, year_from=1997),
    ):
        assert [tuple(r) for r in query(star).collect()] == [tuple(r) for r in query(unknown).collect()]


def test_queries_return_and_fail_without_a_job(feed_context):
    star, context = feed_context.star, feed_context.star.spark.sparkContext
    context.setJobGroup("lookups", "queries before they are collected")
    try:
        queries.year_over_year(star, 3)
        queries.by_state(star, 3, year=1998)
        queries.by_municipality(star, 3, page=7, page_size=3)
        queries.ranking_of_states(star, 3, 1998)
        queries.ranking_of_municipalities(star, 3, 1998)
        queries.ranking_of_indicators(star, "Lines", 1998)
        queries.radar(star, 3)
        queries.temporal(star, 3)
        for wrong, error in ((lambda: queries.by_state(star, 999), NotFoundError), (lambda: queries.year_over_year(star, 3, 1901, 1902), NotEnoughDataError)):
            with pytest.raises(error):
                wrong()
        assert list(context.statusTracker().getJobIdsForGroup("lookups")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_a_deep_page_is_one_filtered_read(feed_context):
    star = feed_context.star
    whole = queries.by_municipality(star, 3, page=1, page_size=100).rows.collect()
    for page in (1, 9, 25):
        rows = queries.by_municipality(star, 3, page=page, page_size=4).rows
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Sort " not in plan and "Exchange" not in plan and "GreaterThanOrEqual(position" in plan
        assert rows.collect() == whole[(page - 1) * 4 : page * 4]
    inside = queries.by_municipality(star, 3, state="NATION_3", page=2, page_size=2).rows.collect()
    assert inside == queries.by_municipality(star, 3, state="NATION_3", page_size=4).rows.collect()[2:]


def test_rankings(cargo):
    star, number = cargo
    assert [(r["rank"], r.state) for r in queries.ranking_of_states(star, number, 2030).collect()] == [(1, "SP"), (2, "MG"), (2, "RJ")]
    assert [(r["rank"], r.state, r.municipality) for r in queries.ranking_of_municipalities(star, number, 2030, 3).collect()] == [
        (1, "SP", "A"), (2, "MG", "A"), (2, "RJ", "A"),
    ]
    assert [(r["rank"], r.indicator) for r in queries.ranking_of_indicators(star, "Ocorrências", 2030).collect()] == [(1, "Roubo de carga")]


def test_radar_orders_by_distance(cargo):
    star, number = cargo
    rows = queries.radar(star, number).collect()
    distances = [abs(r.z_score) if r.z_score is not None else -1 for r in rows]
    assert len(rows) == 15 and distances == sorted(distances, reverse=True)
    assert all(abs(r.z_score) >= 1 for r in queries.radar(star, min_abs_z=1).collect())


def test_metadata(cargo):
    star, _ = cargo
    found = queries.overview(star).first()
    assert (found.first_month, found.last_month, found.has_partial_year) == ("2030-01", "2031-03", True)
    assert (found.indicators, found.states, found.municipalities) == (31, 3, 2)
    assert [r.state for r in queries.list_states(star).collect()] == ["MG", "RJ", "SP"]
    assert [r.year for r in queries.list_years(star).collect()] == [2030, 2031]
    assert [r.jurisdiction for r in queries.list_jurisdictions(star).collect()] == ["Estadual"]
    assert [r.municipality for r in queries.list_municipalities(star, "SP").collect()] == ["A", "B"]
