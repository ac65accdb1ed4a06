import datetime as dt

import pytest
from conftest import SF, as_dicts, feed_rows, months, row, star_of, zeros
from pyspark.sql import functions as F

from tallystar.errors import ContractError, CoverageError
from tallystar.operators import dimensions, facts
from tallystar.operators.sequence import number_rows
from tallystar.operators.staging import build_staging, require_same_rows
from tallystar.reference import INDICATORS, REGION_STATES, default_reference, semantic_group
from tallystar.schema import FACT_KEY, RAW_COLUMNS, SOURCE_HEADERS, STAGING_COLUMNS
from tallystar.sources.raw import raw_frame, read_feed, read_year, read_years, stack_years


def values_of(star, indicator, *columns, **where):
    df = star.fact.join(star.dim("indicator"), "indicator_id").join(star.dim("place"), "place_id")
    df = df.join(star.dim("sex"), "sex_id", "left").where(F.col("indicator") == indicator)
    for column, value in where.items():
        df = df.where(F.col(column) == value)
    return [tuple(r) for r in df.select(*columns).collect()]


# --- staging -----------------------------------------------------------------


def test_staging_keeps_rows_and_drops_the_victim_total(star):
    assert star.staging.count() == 24
    assert star.staging.columns == list(STAGING_COLUMNS)
    assert "victim_total" not in star.staging.columns
    assert {r[0] for r in star.staging.select("source_year").distinct().collect()} == {2030, 2031}


def test_staging_types(star):
    types = dict(star.staging.dtypes)
    assert types["ref_month"] == "date" and types["female"] == "decimal(28,10)" and types["source_year"] == "int"


def test_staging_trims_and_treats_blank_as_absent(spark):
    raw = raw_frame(spark, [row("  SP ", " A  ", "Homicídio doloso", 2030, 1, agent="   ", **zeros())])
    staged = build_staging(stack_years({2030: raw})).first()
    assert (staged.state, staged.municipality, staged.agent) == ("SP", "A", None)


def test_staging_drops_the_time_of_day(spark):
    raw = raw_frame(spark, [dict(row("SP", "A", "Homicídio doloso", 2030, 1), ref_month=dt.datetime(2030, 1, 1, 13, 5))])
    assert build_staging(stack_years({2030: raw})).first().ref_month == dt.date(2030, 1, 1)


def test_staging_rejects_text_that_is_no_number(spark):
    raw = raw_frame(spark, [row("SP", "A", "Homicídio doloso", 2030, 1)]).withColumn("count_value", F.lit("five"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        build_staging(stack_years({2030: raw})).collect()


def test_row_count_guard():
    require_same_rows(3, 3)
    with pytest.raises(ContractError):
        require_same_rows(3, 2)


# --- sources -----------------------------------------------------------------


def test_csv_round_trip_with_published_headers(spark, tmp_path):
    back = {new: old for old, new in SOURCE_HEADERS.items()}
    paths = {}
    for year, rows in feed_rows().items():
        df = raw_frame(spark, rows).withColumn("extra", F.lit("ignored")).withColumnsRenamed(back)
        paths[year] = str(tmp_path / str(year))
        df.write.option("header", True).csv(paths[year])
    raw = read_years(spark, dict(reversed(paths.items())), "csv")
    assert list(raw) == [2030, 2031]
    assert set(RAW_COLUMNS) <= set(raw[2030].columns)
    staged = build_staging(stack_years(raw))
    expected = build_staging(stack_years({y: raw_frame(spark, r) for y, r in feed_rows().items()}))
    assert staged.count() == 24 and staged.exceptAll(expected).isEmpty() and expected.exceptAll(staged).isEmpty()


@pytest.mark.parametrize("file_format", ["csv", "json", "parquet"])
def test_all_years_of_one_layout_are_one_scan(spark, tmp_path, file_format):
    back = {new: old for old, new in SOURCE_HEADERS.items()}
    paths = {}
    for year, rows in {**feed_rows(), 2032: months(2032, 2)}.items():
        paths[year] = str(tmp_path / f"y {year}")
        raw_frame(spark, rows).withColumnsRenamed(back).write.option("header", True).format(file_format).save(paths[year])
    feed = read_feed(spark, paths, file_format)
    assert feed._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    staged = build_staging(feed)
    expected = build_staging(stack_years(read_years(spark, paths, file_format)))
    assert staged.count() == 26 and staged.exceptAll(expected).isEmpty() and expected.exceptAll(staged).isEmpty()
    if file_format == "json":
        assert {t for c, t in feed.dtypes if c != "source_year"} == {"string"}


def test_years_of_different_layouts_are_read_by_name(spark, tmp_path):
    raw_frame(spark, months(2030, 12)).write.option("header", True).csv(str(tmp_path / "a"))
    turned = raw_frame(spark, months(2031, 3)).select(*reversed(RAW_COLUMNS), F.lit("x").alias("extra"))
    turned.write.option("header", True).csv(str(tmp_path / "b"))
    feed = read_feed(spark, {2030: str(tmp_path / "a"), 2031: str(tmp_path / "b")}, "csv")
    assert {r.source_year: r.n for r in build_staging(feed).groupBy("source_year").agg(F.count("female").alias("n")).collect()} == {2030: 12, 2031: 3}


def test_missing_file_and_missing_column_fail(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_year(spark, str(tmp_path / "absent"), 2030)
    raw_frame(spark, months(2030, 1)).drop("weapon").write.parquet(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="weapon"):
        read_year(spark, str(tmp_path / "short"), 2030)


# --- grain and fact ----------------------------------------------------------


def test_repeated_rows_are_summed_not_dropped(star):
    found = dict(values_of(star, "Homicídio doloso", "sex", "value", state="DF"))
    assert {k: float(v) for k, v in found.items()} == {"Feminino": 1.0, "Masculino": 1.0, "Não Informado": 0.0}
    assert facts.merged_rows(star.staging, star.grain).first().merged_rows == 1


def test_not_reported_gives_no_fact_row(star):
    assert [float(v[0]) for v in values_of(star, "Mandado de prisão cumprido", "value")] == [5.0]
    stats = {r.indicator: r for r in facts.not_reported(star.grain, star.dim("indicator")).collect()}
    warrants = stats["Mandado de prisão cumprido"]
    assert (warrants.grain_rows, warrants.applicable_cells, warrants.missing_cells, warrants.pct_missing) == (2, 2, 1, 50.0)
    assert stats["Homicídio doloso"].applicable_cells == 16 * 3 and stats["Homicídio doloso"].missing_cells == 0


def test_sum_of_nulls_is_null_and_of_some_nulls_is_not(spark):
    rows = [row("SP", "A", "Roubo de carga", 2030, 1), row("SP", "A", "Roubo de carga", 2030, 1)]
    rows += [row("SP", "B", "Roubo de carga", 2030, 1), row("SP", "B", "Roubo de carga", 2030, 1, count_value=2.0)]
    grain = facts.aggregate_to_grain(build_staging(stack_years({2030: raw_frame(spark, rows)})))
    found = {r.municipality: r.count_value for r in grain.collect()}
    assert found["A"] is None and float(found["B"]) == 2.0


def test_weapon_is_part_of_the_grain(star):
    assert sorted(float(v[0]) for v in values_of(star, "Arma de Fogo Apreendida", "value")) == [2.0, 3.0]


def test_fact_rules(star):
    assert star.fact.where("value < 0 or value is null").isEmpty()
    assert star.fact.groupBy(*FACT_KEY).count().where("count > 1").isEmpty()
    assert "victim_total" not in star.fact.columns
    assert star.fact.where("sex_id is null").count() == 4
    types = dict(star.fact.dtypes)
    assert types["value"] == "decimal(24,10)" and types["place_id"] == "bigint" and types["time_id"] == "int"


def test_negative_value_fails_the_build(spark):
    with pytest.raises(ContractError, match="negative"):
        star_of(spark, {2030: [row("SP", "A", "Roubo de carga", 2030, 1, count_value=-1.0)]})


def test_stray_count_on_a_victim_row_is_kept_and_caught(spark):
    from tallystar.operators import quality

    odd = star_of(spark, {2030: months(2030, 12) + [row("SP", "B", "Homicídio doloso", 2030, 1, count_value=4.0)]})
    assert odd.fact.where("sex_id is null").count() == 1
    result = quality.check_sex(odd.fact, odd.dim("indicator")).first()
    assert (result.status, result.n_bad) == ("FAIL", 1)


def test_a_place_with_a_third_of_all_rows(spark):
    """Half of the hot place's rows share one key; nothing is lost and nothing is dropped."""
    hot = [row("SP", "HOT", "Homicídio doloso", 2030, 1 + i % 2 * (i % 12), female=1.0, male=float(i % 3)) for i in range(300)]
    rest = [row("MG", f"M{i}", "Homicídio doloso", 2030, 1 + i % 12, female=2.0) for i in range(600)]
    star = star_of(spark, {2030: hot + rest})
    totals = star.fact.join(star.dim("place"), "place_id").groupBy("municipality").agg(F.sum("value").alias("v"))
    found = {r.municipality: float(r.v) for r in totals.collect()}
    assert found["HOT"] == 300 + sum(i % 3 for i in range(300)) and len(found) == 601
    assert sum(found.values()) == found["HOT"] + 1200
    assert facts.merged_rows(star.staging, star.grain).first().merged_rows == 900 - star.grain.count()


# --- dimensions and reference ------------------------------------------------


def test_time_dimension(star):
    rows = as_dicts(star.dim("time").orderBy("time_id"))
    assert [r["time_id"] for r in rows] == list(range(1, 16))
    assert sum(r["year"] == 2030 for r in rows) == 12 and not any(r["is_partial_year"] for r in rows if r["year"] == 2030)
    assert all(r["is_partial_year"] for r in rows if r["year"] == 2031)
    assert (rows[1]["month_name"], rows[1]["quarter"], rows[3]["quarter"]) == ("February", 1, 2)


def test_places_and_regions(star):
    rows = as_dicts(star.dim("place").orderBy("place_id"))
    assert [(r["place_id"], r["state"], r["municipality"], r["region"]) for r in rows] == [
        (1, "DF", "BRASÍLIA", "Centro-Oeste"),
        (2, "SP", "CIDADE TESTE", "Sudeste"),
        (3, "SP", "OUTRACIDADE", "Sudeste"),
    ]


def test_indicator_ids_follow_the_sorted_names(star):
    names = [r.indicator for r in star.dim("indicator").orderBy("indicator_id").collect()]
    assert names == sorted(name for name, *_ in INDICATORS) and len(names) == 31


def test_sex_dimension_is_fixed(star):
    assert [tuple(r) for r in star.dim("sex").orderBy("sex_id").collect()] == [(1, "Feminino"), (2, "Masculino"), (3, "Não Informado")]


def test_unknown_indicator_and_state_fail(spark):
    with pytest.raises(CoverageError, match="Indicador novo"):
        star_of(spark, {2030: [row("SP", "A", "Indicador novo", 2030, 1, count_value=1.0)]})
    with pytest.raises(CoverageError, match="XX"):
        star_of(spark, {2030: [row("XX", "A", "Roubo de carga", 2030, 1, count_value=1.0)]})


def test_reference_tables(spark):
    assert len(INDICATORS) == 31 and sum(len(s) for s in REGION_STATES.values()) == 27
    reference = default_reference(spark)
    groups = reference.indicators.groupBy(semantic_group(F.col("kind"), reference).alias("g")).count()
    assert {r.g: r["count"] for r in groups.collect()} == {
        "Vítimas": 17, "Ações Policiais": 1, "Ocorrências": 5, "Apreensões (Peso)": 2, "Apreensões (Unidade)": 1, "Serviços": 5,
    }
    other = spark.range(1).select(semantic_group(F.lit("Algo"), reference)).first()[0]
    assert other == "Outro"


def test_numbering_is_consecutive_in_sort_order(spark):
    rows = [(f"s{i % 7}", f"m{i:04d}") for i in range(2000)]
    df = spark.createDataFrame(rows, "state string, municipality string").repartition(5)
    numbered = number_rows(df, ["state", "municipality"], "n")
    found = [(r.state, r.municipality) for r in numbered.orderBy("n").collect()]
    assert found == sorted(rows)
    assert [r.n for r in numbered.select("n").orderBy("n").collect()] == list(range(1, 2001))


def test_place_ids_follow_the_names(spark, star):
    places = dimensions.dim_place(star.grain, default_reference(spark)).orderBy("place_id").collect()
    assert [(p.state, p.municipality) for p in places] == sorted((p.state, p.municipality) for p in places)
    assert [p.place_id for p in places] == list(range(1, len(places) + 1))


def test_surrogates_skip_nulls(star):
    assert [tuple(r) for r in star.dim("weapon").orderBy("weapon_id").collect()] == [(1, "Fuzil"), (2, "Pistola")]
    assert star.dim("agent").count() == 1 and star.dim("age_band").count() == 1


# --- the feed over the given tables ------------------------------------------


def test_feed_counts(feed_context):
    star = feed_context.star
    assert feed_context.raw.count() == 9000 and star.staging.count() == 9000
    assert star.grain.count() == 7605 and star.fact.count() == 8430 and star.dim("place").count() == 150
    missing = facts.not_reported(star.grain, star.dim("indicator")).where("family = 'count'")
    assert missing.agg(F.sum("missing_cells")).first()[0] == 30


def test_feed_repeated_keys(feed_context):
    from tallystar.operators.profile import DIMENSIONAL_KEY, repeated_keys

    found = repeated_keys(feed_context.raw, DIMENSIONAL_KEY).agg(F.count("*"), F.sum("row_count")).first()
    assert tuple(found) == (1163, 2558)


def test_entry_runs(spark):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).count() == 91
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert SF.endswith("sf0.001")
