"""Published tables and views: all or nothing, one switch, the same rows as the functions."""

import pytest
from conftest import counts_rows, feed_rows, months, row
from pyspark.sql import functions as F

from tallystar.plans import job, publish, views
from tallystar.plans.star import write_star
from tallystar.plans.view_sql import VIEW_SQL
from tallystar.reference import default_reference
from tallystar.sources.raw import raw_frame


def written(spark, rows_by_year, root):
    return write_star({y: raw_frame(spark, r) for y, r in rows_by_year.items()}, default_reference(spark), root)


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("published") / "one")
    weights = [row("SP", f"M{i}", "Apreensão de Cocaína", 2030, 1 + i % 12, weight_value=float(i * i) / 8) for i in range(40)]
    rows = feed_rows()
    star = written(spark, {2030: rows[2030] + counts_rows(2030, 12) + weights, 2031: rows[2031] + counts_rows(2031, 3, 2.0)}, root)
    assert publish.publish(star, root, "desk") == 1
    return star


def test_every_view_has_an_sql_text():
    assert set(VIEW_SQL) == set(views.VIEWS) and len(VIEW_SQL) == 31


@pytest.mark.parametrize("name", list(VIEW_SQL))
def test_another_session_reads_the_rows_of_the_function(spark, first, name):
    other = spark.newSession()
    shown, computed = other.table(f"desk.{name}"), views.VIEWS[name](first)
    assert sorted(shown.columns) == sorted(computed.columns)

    def rows(df):
        columns = sorted(df.columns)
        cells = [F.round(F.col(c).cast("double"), 6) if dict(df.dtypes)[c].startswith(("decimal", "double")) else F.col(c) for c in columns]
        return sorted(map(str, df.select(*[cell.cast("string") for cell in cells]).collect()))

    assert rows(shown) == rows(computed) and shown.count() > 0


def test_only_the_current_run_is_read(spark, first):
    plan = spark.sql("SELECT SUM(value) FROM desk.fact")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan and "Subquery" in plan


def test_a_broken_view_changes_nothing_and_a_good_run_switches_all(spark, first, tmp_path):
    before = {name: spark.table(f"desk.{name}").count() for name in ("fact", "national", "by_state", "quality_summary")}
    total = spark.table("desk.national").agg(F.sum("total")).first()[0]
    next_star = written(spark, {2030: months(2030, 12)}, str(tmp_path / "two"))
    changed = {**VIEW_SQL, "year_flags": "SELECT DISTINCT year, is_partial_year FROM @dim_time WHERE year > 0"}
    for broken in ("SELECT missing_column FROM @national", "SELECT FROM", "SELECT * FROM @no_such_table"):
        with pytest.raises(Exception):
            publish.publish(next_star, str(tmp_path / "two"), "desk", {**changed, "state_share": broken})
        assert publish.published_runs(spark, "desk") == [1]
        assert {name: spark.newSession().table(f"desk.{name}").count() for name in before} == before
        assert spark.table("desk.national").agg(F.sum("total")).first()[0] == total
        assert "year > 0" not in publish._view_text(spark, "desk", "year_flags")
        assert not [d.name for d in spark.catalog.listDatabases() if "candidate" in d.name]
        assert not spark.sql("SHOW PARTITIONS desk.stored_fact").where("partition LIKE 'run=2/%'").count()

    assert publish.publish(next_star, str(tmp_path / "two"), "desk", changed) == 2
    other = spark.newSession()
    assert other.table("desk.fact").count() == next_star.fact.count()
    assert other.table("desk.national").count() == views.national(next_star).count() == 1
    assert other.table("desk.quality_summary").first().staging_rows == 12


def test_a_failure_at_the_switch_puts_views_back(spark, tmp_path, monkeypatch):
    star = written(spark, {2030: months(2030, 12)}, str(tmp_path / "a"))
    publish.publish(star, str(tmp_path / "a"), "fallback")
    changed = {**VIEW_SQL, "year_flags": "SELECT DISTINCT year, is_partial_year FROM @dim_time WHERE year > 0"}
    write = publish.tables.write_table

    def failing(df, path, *rest):
        if path.endswith("/runs"):
            df.select("no_such_column")
        return write(df, path, *rest)

    monkeypatch.setattr(publish.tables, "write_table", failing)
    with pytest.raises(Exception, match="no_such_column"):
        publish.publish(star, str(tmp_path / "a"), "fallback", changed)
    assert "year > 0" not in publish._view_text(spark, "fallback", "year_flags")
    assert publish.published_runs(spark, "fallback") == [1] and spark.table("fallback.year_flags").count() == 1


def test_old_runs_leave_the_catalog(spark, tmp_path):
    star = written(spark, {2030: months(2030, 12)}, str(tmp_path / "a"))
    for _ in range(4):
        publish.publish(star, str(tmp_path / "a"), "kept", keep=2)
    assert publish.published_runs(spark, "kept") == [3, 4]
    runs = {r[0].split("/")[0] for r in spark.sql("SHOW PARTITIONS kept.stored_fact").collect()}
    assert runs == {"run=3", "run=4"}


def test_the_warehouse_rounds_and_the_star_does_not(spark, tmp_path):
    fine = [row("SP", "A", "Apreensão de Cocaína", 2030, 1, weight_value=0.0004) for _ in range(4)]
    star = written(spark, {2030: fine}, str(tmp_path / "fine"))
    publish.publish(star, str(tmp_path / "fine"), "fine")
    assert float(spark.table("fine.fact").first().value) == 0.002
    assert float(spark.table("fine.exact_fact").first().value) == float(star.fact.first().value) == 0.0016


def test_the_job_reads_no_layer_for_its_counts(spark, tmp_path):
    star = written(spark, feed_rows(), str(tmp_path / "star"))
    assert dict(star.counts) == {"raw": 24, "staging": 24, "grain": 23, "fact": star.fact.count()}
    for df in (job.quality_results(star)["layer_counts"], job.run_summary(star).select("staging_rows", "grain_rows", "fact_rows", "indicators")):
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
    counted = {r.layer: r.row_count for r in job.quality_results(star)["layer_counts"].collect()}
    assert counted == dict(star.counts)
