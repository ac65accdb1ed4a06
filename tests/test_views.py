from dataclasses import replace

import pytest
from conftest import as_dicts, months, row, star_of
from pyspark.sql import functions as F

from tallystar.plans import measures, views
from tallystar.schema import WEIGHT


@pytest.fixture(scope="module")
def feed_star(feed_context):
    return feed_context.star


def gap_star(spark, rows_2030, rows_2031=None):
    feeds = {2030: rows_2030}
    if rows_2031:
        feeds[2031] = rows_2031
    return star_of(spark, feeds)


def counts(year, month_values):
    return [row("SP", "A", "Roubo de carga", year, m, count_value=float(v)) for m, v in month_values.items()]


# --- invariants over any data ------------------------------------------------


def test_views_keep_the_fact_total(feed_star):
    fact_total = feed_star.fact.agg(F.sum("value")).first()[0]
    for view in (
        views.national, views.by_state, views.by_municipality, views.by_jurisdiction, views.monthly_series, views.by_indicator,
    ):
        assert view(feed_star).agg(F.sum("total")).first()[0] == fact_total, view.__name__


def test_enriched_fact_keeps_the_row_count(feed_star):
    assert views.enriched_fact(feed_star).count() == feed_star.fact.count()


def test_no_indicator_vanishes(feed_star):
    assert views.national(feed_star).select("indicator").distinct().count() == feed_star.dim("indicator").count()


def test_one_family_and_unit_per_indicator(feed_star):
    per = views.national(feed_star).groupBy("indicator").agg(F.count_distinct("family").alias("f"), F.count_distinct("unit").alias("u"))
    assert per.where("f <> 1 or u <> 1").isEmpty()


def test_only_the_partial_year_is_flagged(feed_star):
    assert [r.year for r in views.year_flags(feed_star).where("is_partial_year").collect()] == [2001]


@pytest.mark.parametrize("view", [views.by_sex, views.by_age_band])
def test_shares_sum_to_a_hundred(feed_star, view):
    sums = view(feed_star).groupBy("indicator", "year").agg(F.sum("pct").alias("s"))
    assert sums.where("abs(s - 100) > 0.5").isEmpty() and not sums.isEmpty()


@pytest.mark.parametrize(
    "view, keys",
    [
        (views.state_ranking, ["indicator", "year"]),
        (views.municipality_ranking, ["indicator", "year"]),
        (views.region_ranking, ["indicator", "year"]),
        (views.indicator_ranking, ["semantic_group", "year"]),
        (views.jurisdiction_ranking, ["indicator", "year"]),
        (views.by_weapon, ["year"]),
    ],
)
def test_every_ranking_starts_at_one(feed_star, view, keys):
    assert view(feed_star).groupBy(*keys).agg(F.min("rank").alias("r")).where("r <> 1").isEmpty()


def test_outlier_view_loses_nothing(feed_star):
    weights = feed_star.dim("indicator").where(F.col("family") == WEIGHT)
    expected = feed_star.fact.join(weights, "indicator_id").groupBy("indicator").agg(F.count("*").alias("n"), F.sum("value").alias("s"))
    found = views.outlier_impact(feed_star).join(expected, "indicator")
    assert found.count() == 2
    assert found.where("row_count <> n or abs(sum_with_outliers - s) > 1e-6 or rows_above_p99 <= 0").isEmpty()
    assert found.where("mean_without_top >= mean_with_outliers").isEmpty()


def test_every_view_registers(spark, feed_star):
    names = views.register_views(spark, feed_star, "t_")
    assert len(names) == len(views.VIEWS) == 31
    assert spark.sql("SELECT count(*) FROM t_national").first()[0] == 91
    assert spark.sql("SELECT max(cutoff_month) FROM t_comparable_cutoff").first()[0] == 8


# --- time --------------------------------------------------------------------


@pytest.mark.parametrize(
    "lasts, cutoff", [({2030: 12}, 12), ({2030: 12, 2031: 3}, 3), ({2030: 9, 2031: 6}, 6)], ids=["none", "one", "two"]
)
def test_comparable_cutoff_is_the_least_last_month(spark, lasts, cutoff):
    star = star_of(spark, {year: months(year, last) for year, last in lasts.items()})
    assert views.comparable_cutoff(star).first().cutoff_month == cutoff


def test_comparable_years_use_the_same_months(spark):
    star = gap_star(spark, counts(2030, {m: 1 for m in range(1, 13)}), counts(2031, {1: 5, 2: 5, 3: 5}))
    found = {r.year: r for r in views.comparable_years(star).collect()}
    assert float(found[2030].comparable_total) == 3 and float(found[2031].comparable_total) == 15
    assert found[2031].is_partial_year and not found[2030].is_partial_year and found[2030].months_included == 3


def test_positional_and_calendar_offsets_differ_on_a_gap(spark):
    star = gap_star(spark, counts(2030, {1: 10, 2: 20, 4: 40}))
    by_row = {r.month: r for r in views.monthly_metrics(star).collect()}
    by_month = {r.month: r for r in views.monthly_metrics(star, calendar=True).collect()}
    assert float(by_row[4].previous_month) == 20 and by_row[4].pct_change == 100.0
    assert by_month[4].previous_month is None and by_month[4].pct_change is None
    assert by_row[4].moving_mean_3 == pytest.approx(70 / 3) and by_month[4].moving_mean_3 == 30.0
    assert by_row[1].previous_month is None and float(by_row[2].change) == 10


def test_same_month_of_the_year_before(spark):
    star = gap_star(spark, counts(2030, {m: m for m in range(1, 13)}), counts(2031, {1: 3, 2: 1}))
    found = {(r.year, r.month): r for r in views.monthly_metrics(star).collect()}
    assert float(found[2031, 1].same_month_last_year) == 1 and found[2031, 1].pct_change_last_year == 200.0
    assert found[2031, 2].pct_change_last_year == -50.0 and found[2030, 12].same_month_last_year is None


def test_zero_base_gives_no_percentage(spark):
    star = gap_star(spark, counts(2030, {1: 0, 2: 4}))
    assert {r.month: r.pct_change for r in views.monthly_metrics(star).collect()} == {1: None, 2: None}


def test_z_score_is_null_without_spread(star):
    flat = views.deviation_from_history(star).where("indicator = 'Suicídio' or indicator = 'Roubo de carga'")
    assert flat.isEmpty()
    single = views.deviation_from_history(star).where("indicator = 'Apreensão de Cocaína'").first()
    assert single.z_score is None and float(single.historical_mean) == 12.5


def test_z_score(spark):
    star = gap_star(spark, counts(2030, {1: 1, 2: 1, 3: 1, 4: 5}))
    found = {r.month: r.z_score for r in views.deviation_from_history(star).collect()}
    assert found == {1: -0.58, 2: -0.58, 3: -0.58, 4: 1.73}


# --- breakdowns --------------------------------------------------------------


def test_state_mean_is_over_its_municipalities(spark):
    rows = [row("SP", n, "Roubo de carga", 2030, m, count_value=v) for n, v in (("A", 2.0), ("B", 4.0)) for m in (1, 2)]
    found = views.by_state(gap_star(spark, rows)).first()
    assert float(found.total) == 12 and found.mean == 6.0 and found.region == "Sudeste"


def test_family_share_never_crosses_units(star):
    rows = views.by_indicator(star).where("year = 2030").groupBy("family").agg(F.sum("pct_of_family").alias("s")).collect()
    assert {r.family: pytest.approx(r.s, abs=0.1) for r in rows} == {"victim": 100, "count": 100, "weight": 100}


def test_zero_denominator_gives_no_share(spark):
    star = gap_star(spark, months(2030, 12))
    assert {r.pct for r in views.by_sex(star).collect()} == {None}
    assert {r.pct_of_nation for r in views.state_share(star).collect()} == {None}


def test_rank_leaves_gaps_and_dense_rank_does_not(spark):
    totals = {"SP": 5.0, "RJ": 5.0, "MG": 1.0}
    star = gap_star(spark, [row(s, "A", "Roubo de carga", 2030, 1, count_value=v) for s, v in totals.items()])
    assert {r.state: r["rank"] for r in views.state_ranking(star).collect()} == {"SP": 1, "RJ": 1, "MG": 3}
    dense = measures.dense_ranking(star, "state", ["indicator", "year"])
    assert {r.state: r["rank"] for r in dense.collect()} == {"SP": 1, "RJ": 1, "MG": 2}


def test_municipalities_without_a_positive_total_are_not_ranked(star):
    ranked = views.municipality_ranking(star).where("indicator = 'Homicídio doloso'")
    assert [r.municipality for r in ranked.collect()] == ["BRASÍLIA"]


def test_victim_total_is_the_sum_over_sexes(star):
    found = views.victim_totals(star).where("indicator = 'Homicídio doloso' and ref_month = '2030-01-01'").first()
    assert float(found.victim_total) == 2.0


# --- measures ----------------------------------------------------------------


def test_safe_total_is_null_over_mixed_units(star):
    row_ = measures.core(star).first()
    assert row_.distinct_units > 1 and row_.safe_total is None and row_.selected_unit == "unidades mistas — não somar"
    assert row_.selected_indicator == "Vários indicadores"
    only = measures.core(star, where={"indicator": "Roubo de carga"}).first()
    assert only.total_value is None and only.row_count in (None, 0)
    victims = measures.core(star, where={"family": "victim"}).first()
    assert victims.selected_unit == "pessoas" and victims.safe_total == victims.total_value == victims.victim_total


def test_filters_on_every_kind_of_dimension(star):
    by_weapon = measures.core(star, ["weapon"], {"weapon": ["Pistola", "Fuzil"]})
    assert {r.weapon: float(r.total_value) for r in by_weapon.collect()} == {"Pistola": 3.0, "Fuzil": 2.0}
    place = measures.core(star, ["indicator"], {"municipality": "BRASÍLIA", "year": 2030})
    assert [(r.indicator, float(r.total_value)) for r in place.collect()] == [("Homicídio doloso", 2.0)]
    with pytest.raises(ValueError, match="colour"):
        measures.core(star, ["colour"])


def test_units_are_added_where_a_key_mixes_them(star):
    assert measures.unit_safe(["state"]) == ["state", "unit"] and measures.unit_safe(["indicator"]) == ["indicator"]
    assert "unit" in measures.share(star, "state", ["year"]).columns
    assert "unit" in measures.drill_down(star, "region", []).columns


def test_year_labels(star):
    labels = {r.year: r.label for r in measures.year_labels(star).collect()}
    assert labels == {2030: "2030", 2031: "DADOS PARCIAIS — JAN a Mar/2031", None: "Vários anos"}


def test_quality_status(star):
    found = {r.indicator: (r.ratio_missing, r.status) for r in measures.quality_status(star).collect()}
    assert len(found) == 31
    assert found["Mandado de prisão cumprido"] == (0.5, "Sério")
    assert found["Homicídio doloso"] == (0.0, "Bom") and found["Suicídio"] == (None, "Sem dados")


def test_shares_and_outliers_of_single_values(star):
    sexes = measures.share(star, "sex", ["indicator"], {"indicator": "Homicídio doloso"})
    assert {r.sex: r.share for r in sexes.collect()} == {"Feminino": 0.5, "Masculino": 0.5, "Não Informado": 0.0}
    single = measures.weight_outliers(star).first()
    assert single.mean_with_outliers == single.mean_without_top == 12.5 and single.ratio_impact == 0.0


def test_comparable_total_keeps_the_year(star):
    found = as_dicts(measures.comparable_total(star).where("indicator = 'Homicídio doloso'"))
    assert {r["year"] for r in found} == {2030, 2031} and {r["cutoff_month"] for r in found} == {3}


def test_drill_levels_have_one_total(feed_star):
    totals = {
        level: measures.drill_down(feed_star, level).agg(F.sum("total")).first()[0] for level in measures.LEVELS
    }
    assert len(set(totals.values())) == 1
    with pytest.raises(ValueError):
        measures.drill_down(feed_star, "continent")


def scanned(df):
    """The fact's scan in the plan."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_filtered_measures_prune_the_fact(feed_star):
    by_year = {"year": 1998}
    plans = {
        "top_states": scanned(measures.top_states(feed_star, "LINE PROMO", where=by_year)),
        "core": scanned(measures.core(feed_star, ["state"], by_year)),
        "weights": scanned(measures.weight_statistics(feed_star, ["indicator"], by_year)),
        "share": scanned(measures.share(feed_star, "sex", ["indicator"], {"family": "victim", **by_year})),
    }
    for name, plan in plans.items():
        assert any("year" in part.split("]", 1)[0] for part in plan.split("PartitionFilters: [")[1:]), name
    for name in ("top_states", "weights", "share"):
        assert any("indicator_id" in part.split("]", 1)[0] for part in plans[name].split("PushedFilters: [")[1:]), name


def test_sums_answer_what_their_keys_cover(feed_star):
    def read(df):
        plan = scanned(df)
        return [t for t in ("fact", "place_year", "indicator_month", "value_counts") if f"/{t}]" in plan]

    assert read(measures.core(feed_star, ["state", "year"])) == ["place_year"]
    assert read(measures.core(feed_star, ["region"], {"year": 1998, "family": "count"})) == ["place_year"]
    assert read(measures.core(feed_star, ["month"])) == read(measures.group_series(feed_star)) == ["indicator_month"]
    assert read(measures.group_totals(feed_star)) == read(measures.group_distribution(feed_star)) == ["indicator_month"]
    assert read(measures.share(feed_star, "state", ["indicator", "year"])) == ["place_year"]
    assert read(measures.drill_down(feed_star, "municipality")) == ["place_year"]
    for by, where in ((["state", "month"], None), (["jurisdiction"], None), (["state"], {"sex": "Feminino"})):
        assert read(measures.core(feed_star, by, where)) == ["fact"], by
    assert read(measures.core(replace(feed_star, years_agree=False), ["state", "year"])) == ["fact"]
    assert read(measures.core(replace(feed_star, years_agree=False), ["state"])) == ["place_year"]


def test_every_source_gives_the_same_sums(feed_star):
    unknown = replace(feed_star, years_agree=False)
    by = ["semantic_group", "state", "year", "is_partial_year"]
    for where in (None, {"year": [1997, 1998], "region": "ASIA"}, {"indicator": "LINE PROMO", "is_partial_year": False}):
        stored, direct = (measures.sliced(s, by, where) for s in (feed_star, unknown))
        assert stored.count() == direct.count() > 0
        assert stored.select(sorted(stored.columns)).exceptAll(direct.select(sorted(stored.columns))).isEmpty()


def test_units_in_context_by_dimension_and_by_fact(star):
    """One place holds one indicator, but a filter on places does not reach the indicator dimension."""
    where = {"municipality": "BRASÍLIA"}
    dimension, fact = (measures.core(star, [], where, units_from=u).first() for u in measures.UNITS_FROM)
    units = star.dim("indicator").select("unit").distinct().count()
    assert (dimension.distinct_units, fact.distinct_units) == (units, 1) and units > 1
    assert dimension.safe_total is None and float(fact.safe_total) == 2.0
    assert (dimension.selected_indicator, fact.selected_indicator) == ("Vários indicadores", "Homicídio doloso")
    assert dimension.total_value == fact.total_value and dimension.row_count == fact.row_count
    grouped = {r.semantic_group: r for r in measures.core(star, ["semantic_group"], where).collect()}
    assert set(grouped) == {"Vítimas"} and grouped["Vítimas"].distinct_units == 1 and float(grouped["Vítimas"].safe_total) == 2.0
    one = measures.core(star, ["state"], {"indicator": "Homicídio doloso"}).collect()
    assert {r.selected_indicator for r in one} == {"Homicídio doloso"} and all(r.safe_total is not None for r in one)
    with pytest.raises(ValueError, match="units_from"):
        measures.core(star, units_from="both")


def test_time_filters_do_not_cut_series(feed_star):
    key = ["indicator", "ref_month"]
    for measure in (measures.calendar_metrics, measures.history):
        whole = measure(feed_star).where("year(ref_month) = 1998")
        for cut in (measure(feed_star, where={"year": 1998}), measure(feed_star, ["indicator", "year"], {"year": 1998}).drop("year")):
            assert cut.count() == whole.count() > 0
            assert cut.select(whole.columns).exceptAll(whole).isEmpty()
        assert not whole.where("ref_month = '1998-01-01'").isEmpty() and key
