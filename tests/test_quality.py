import datetime as dt

import pytest
from conftest import as_dicts, feed_rows, months, row, star_of, zeros
from pyspark.sql import functions as F

from tallystar.errors import ContractError
from tallystar.operators import facts, profile, quality
from tallystar.plans import job, views
from tallystar.plans.star import read_star
from tallystar.reference import default_reference
from tallystar.sources import tables
from tallystar.sources.raw import raw_frame, stack_years


def statuses(results, key="check"):
    return {r[key]: (r.status, r.n_bad) for r in results.collect()}


def test_all_checks_pass(star):
    found = statuses(quality.run_checks(star.raw, star.staging, star.fact, star.dims))
    assert len(found) == 8 and set(found.values()) == {("PASS", 0)}


def test_each_check_finds_its_fault(star):
    fact, dims, indicators = star.fact, star.dims, star.dim("indicator")
    victim = indicators.where("family = 'victim'").first().indicator_id
    count = indicators.where("family = 'count'").first().indicator_id

    def broken(**columns):
        return fact.limit(1).withColumns({k: F.lit(v).cast(fact.schema[k].dataType) for k, v in columns.items()})

    assert statuses(quality.check_unique_grain(fact.unionByName(fact.limit(1))))["unique_grain"] == ("FAIL", 2)
    cases = {
        "no_negative_values": broken(value=-1, indicator_id=victim, sex_id=1),
        "mandatory_fields": broken(time_id=None, indicator_id=victim, sex_id=1),
        "sex_consistency": broken(indicator_id=count, sex_id=2),
        "one_family_per_indicator": broken(indicator_id=999),
    }
    for name, extra in cases.items():
        assert statuses(quality.fact_checks(fact.unionByName(extra), indicators))[name] == ("FAIL", 1), name
    blank = indicators.withColumn("unit", F.when(F.col("indicator_id") == 1, " ").otherwise(F.col("unit")))
    assert statuses(quality.check_units(blank))["unit_present"] == ("FAIL", 1)
    assert statuses(quality.check_time(dims["time"].where("month <> 5")))["time_consistency"] == ("FAIL", 2)
    assert statuses(quality.check_row_counts(star.raw, star.staging.limit(20)))["staging_keeps_rows"] == ("FAIL", 4)


def test_null_indicator_counts_as_a_null_field(star):
    extra = star.fact.limit(1).withColumn("indicator_id", F.lit(None).cast("int"))
    found = statuses(quality.fact_checks(star.fact.unionByName(extra), star.dim("indicator")))
    assert found["mandatory_fields"] == ("FAIL", 1)


def test_source_year_check(spark):
    odd = [dict(row("SP", "A", "Roubo de carga", 2030, 1, count_value=1.0), ref_month=dt.datetime(2029, 12, 1))]
    star = star_of(spark, {2030: months(2030, 12) + odd})
    assert not star.years_agree
    assert statuses(quality.check_source_year(star.grain))["source_year_is_calendar_year"] == ("FAIL", 1)


def test_reconciliation(star):
    found = quality.reconcile(star.raw, star.staging, star.fact, star.dim("indicator"))
    rows = {r.indicator: r for r in found.collect()}
    assert len(rows) == 31 and {r.status for r in rows.values()} == {"PASS"}
    assert float(rows["Homicídio doloso"].fact_total) == 2.0 and float(rows["Suicídio"].raw_total) == 0.0
    assert tuple(quality.tally(found).first()) == (31, 31, 0)
    lost = quality.reconcile(star.raw, star.staging, star.fact.where("value <> 12.5"), star.dim("indicator"))
    assert [(r.indicator, float(r.difference)) for r in lost.where("status = 'FAIL'").collect()] == [("Apreensão de Cocaína", -12.5)]
    with pytest.raises(ContractError):
        quality.require_pass(lost, "reconciliation")


def test_constraints(star):
    found = quality.constraint_violations(star.fact, star.dims)
    assert found.where("violations <> 0").isEmpty() and found.count() > 35
    orphan = star.fact.limit(1).withColumn("weapon_id", F.lit(99))
    broken = quality.constraint_violations(star.fact.unionByName(orphan), star.dims).where("violations <> 0")
    assert [tuple(r) for r in broken.collect()] == [("fact.weapon_id references weapon", 1)]


def test_constraints_find_each_fault_and_read_the_fact_twice(star):
    fact, dims = star.fact, star.dims

    def broken(**columns):
        return fact.limit(1).withColumns({k: F.lit(v).cast(fact.schema[k].dataType) for k, v in columns.items()})

    def found(fact, dims):
        return {r["constraint"]: r.violations for r in quality.constraint_violations(fact, dims).where("violations <> 0").collect()}

    assert found(fact.unionByName(fact.limit(1)), dims) == {"fact key unique": 1}
    negative = found(fact.unionByName(broken(value=-1)), dims)
    assert negative == {"fact.value >= 0": 1, "fact key unique": 1}
    assert found(fact.unionByName(broken(value=None, place_id=None)), dims) == {"fact.value not null": 1, "fact.place_id not null": 1}
    twice = {**dims, "weapon": dims["weapon"].unionByName(dims["weapon"].limit(1))}
    assert found(fact, twice) == {"weapon(weapon_id) unique": 1, "weapon(weapon) unique": 1}
    unnamed = {**dims, "agent": dims["agent"].withColumn("agent", F.lit(None).cast("string"))}
    assert found(fact, unnamed) == {"agent not null": 1}
    assert found(fact, {**dims, "sex": dims["sex"].where("sex_id <> 1")})["fact.sex_id references sex"] == fact.where("sex_id = 1").count()


def test_constraints_scan_the_fact_twice(spark, tmp_path):
    written = job.run({y: raw_frame(spark, r) for y, r in feed_rows().items()}, default_reference(spark), str(tmp_path / "run")).star
    plan = quality.constraint_violations(written.fact, written.dims)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("/star/fact]") == 2 and plan.count("FileScan") == 10


def test_not_reported_is_the_same_from_both_sides(star):
    one = facts.not_reported(star.grain, star.dim("indicator"))
    other = views.quality_not_reported(star)
    assert one.exceptAll(other).isEmpty() and one.count() == other.count()


def test_quality_summary(star):
    found = views.quality_summary(star).first()
    assert (found.staging_rows, found.indicators, found.states, found.municipality_names, found.places) == (24, 31, 2, 3, 3)
    assert (found.months_in_partial_years, found.partial_years) == (3, 1)


# --- profile -----------------------------------------------------------------


@pytest.fixture(scope="module")
def raw(spark):
    return stack_years({year: raw_frame(spark, rows) for year, rows in feed_rows().items()})


def test_profile(raw):
    nulls = {(r.source_year, r.column): (r.rows, r.nulls) for r in profile.column_nulls(raw).collect()}
    assert nulls[2030, "weapon"] == (21, 19) and nulls[2031, "female"] == (3, 0) and len(nulls) == 28
    numbers = {(r.source_year, r.column): r for r in profile.number_statistics(raw).collect()}
    weight = numbers[2030, "weight_value"]
    assert (float(weight.minimum), float(weight.total), weight.mean, weight.negative) == (12.5, 12.5, 12.5, 0)
    assert {(r.source_year, r.months) for r in profile.month_statistics(raw).collect()} == {(2030, 12), (2031, 3)}
    assert sorted(r.month for r in profile.months_list(raw).where("source_year = 2031").collect()) == ["2031-01", "2031-02", "2031-03"]
    distinct = {(r.source_year, r.column): r.distinct_values for r in profile.distinct_counts(raw).collect()}
    assert distinct[2030, "municipality"] == 3 and (2031, "weapon") not in distinct
    top = profile.top_values(raw, n=1).where("column = 'municipality' and source_year = 2030").first()
    assert (top.value, top.row_count, top.position) == ("CIDADE TESTE", 12, 1)


def test_repetition(raw):
    assert as_dicts(profile.repetition(raw)) == [{"source_year": 2030, "groups": 1, "rows_in_groups": 2, "surplus_rows": 1}]
    assert profile.identical_rows(raw).isEmpty()
    compared = {r.candidate: r.groups for r in profile.compare_keys(raw, {"full": profile.DIMENSIONAL_KEY, "reduced": profile.REDUCED_KEY}).collect()}
    assert compared == {"full": 1, "reduced": 2}
    by_state = profile.repetition_by_state(raw, profile.DIMENSIONAL_KEY).first()
    assert (by_state.state, by_state.pct_of_year) == ("DF", 100.0)


def test_profile_faults(spark):
    rows = [
        dict(row("SP", "A", "Homicídio doloso", 2030, 1, **zeros()), victim_total=3.0),
        row("SP", "A", "Homicídio doloso", 2030, 2, count_value=1.0, **zeros()),
    ]
    raw = stack_years({2030: raw_frame(spark, rows)})
    assert tuple(profile.victim_total_mismatches(raw).first()) == (2030, 2, 1)
    assert tuple(profile.mixed_family_rows(raw).first()) == (2030, 2, 1)


def test_top_values_are_cut_before_the_shuffle(raw):
    plan = profile.top_values(raw)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.rindex("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Exchange") < before_shuffle


# --- the job -----------------------------------------------------------------


def test_job_end_to_end(spark, tmp_path):
    raw = {year: raw_frame(spark, rows) for year, rows in feed_rows().items()}
    out = job.run(raw, default_reference(spark), str(tmp_path / "run"), "indicators_dw")
    job.require_passed(out)
    s = out.summary
    assert (s["raw_rows"], s["staging_rows"], s["grain_rows"], s["indicators"], s["states"]) == (24, 24, 23, 31, 2)
    assert (s["checks_passed"], s["checks_total"], s["reconciled_passed"], s["warehouse"]) == (9, 9, 31, "OK")
    assert s["partial_years"] == [2031] and str(s["first_month"]) == "2030-01-01"
    assert spark.table("indicators_dw.fact").count() == s["fact_rows"] == out.star.fact.count()
    other = spark.newSession()
    assert other.table("indicators_dw.quality_summary").first().fact_rows == s["fact_rows"]
    assert other.table("indicators_dw.dim_indicator").count() == 31
    assert other.table("indicators_dw.fact").where("source_year = 2031").count() > 0
    assert dict(other.table("indicators_dw.fact").dtypes)["value"] == "decimal(14,3)"
    for name in ("layer_counts", "checks", "not_reported", "reconciliation", "constraints"):
        assert not tables.read_table(spark, str(tmp_path / "run" / "quality" / name)).isEmpty()
    again = read_star(spark, default_reference(spark), str(tmp_path / "run" / "star"))
    assert again.fact.exceptAll(out.star.fact).isEmpty() and again.years_agree
    assert views.national(again).count() == views.national(out.star).count()


def test_failed_warehouse_load_keeps_the_files(spark, tmp_path):
    raw = {year: raw_frame(spark, rows) for year, rows in feed_rows().items()}
    out = job.run(raw, default_reference(spark), str(tmp_path / "run"), "no_catalog`.`bad")
    assert out.passed and out.summary["warehouse"].startswith("FAILED")
    assert tables.read_table(spark, str(tmp_path / "run" / "star" / "fact")).count() == out.summary["fact_rows"]


def test_failing_run_raises(spark, tmp_path):
    odd = months(2030, 12) + [row("SP", "B", "Homicídio doloso", 2030, 1, count_value=4.0)]
    out = job.run({2030: raw_frame(spark, odd)}, default_reference(spark), str(tmp_path / "run"))
    assert not out.passed
    with pytest.raises(ContractError):
        job.require_passed(out)


def test_command_line(spark, tmp_path, capsys):
    feeds = []
    for year, rows in feed_rows().items():
        raw_frame(spark, rows).write.option("header", True).csv(str(tmp_path / str(year)))
        feeds += ["--feed", f"{year}={tmp_path / str(year)}"]
    job.main([*feeds, "--format", "csv", "--out", str(tmp_path / "run")])
    assert "'reconciled_passed': 31" in capsys.readouterr().out
    assert spark.sql("SELECT count(*) FROM monthly_series").first()[0] > 0


def test_a_year_filter_prunes_partitions(spark, tmp_path):
    from tallystar.plans import queries

    raw = {year: raw_frame(spark, rows) for year, rows in feed_rows().items()}
    star = job.run(raw, default_reference(spark), str(tmp_path / "run")).star
    plan = queries.kpis(star, indicator_id=14, year=2031, jurisdiction="Estadual")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_year" in plan and "EqualTo(indicator_id,14)" in plan


def test_fine_cells_reach_the_fact_unrounded(spark):
    """Three rows of 0.0004 kg and one of 1.5 kg: every layer holds 1.5012."""
    fine = [row("SP", "A", "Apreensão de Cocaína", 2030, 1, weight_value=0.0004) for _ in range(3)]
    fine.append(row("SP", "B", "Apreensão de Cocaína", 2030, 1, weight_value=1.5))
    found = star_of(spark, {2030: fine})
    assert sorted(float(r.value) for r in found.fact.collect()) == [0.0012, 1.5]
    line = quality.reconcile(found.raw, found.staging, found.fact, found.dim("indicator")).where("indicator = 'Apreensão de Cocaína'").first()
    assert (float(line.raw_total), float(line.staging_total), float(line.fact_total)) == (1.5012, 1.5012, 1.5012)
    assert line.status == "PASS"
    numbers = profile.number_statistics(found.raw, ["weight_value"]).first()
    assert (float(numbers.minimum), float(numbers.total), numbers["mean"]) == (0.0004, 1.5012, pytest.approx(0.3753))
    split = [dict(row("SP", "A", "Homicídio doloso", 2030, 1, female=0.0004, male=0.0, unknown_sex=0.0), victim_total=0.0001)]
    assert tuple(profile.victim_total_mismatches(stack_years({2030: raw_frame(spark, split)})).first()) == (2030, 1, 1)
