"""What keeps the star's build linear: tasks follow rows, years are written unsorted, places are ordered by one sort."""

import random
import time

from conftest import SF, feed_rows, star_of
from pyspark.sql import functions as F

from checks.registry import reconciled_fine
from tallystar import storage
from tallystar.operators.facts import build_fact
from tallystar.plans import star as star_module
from tallystar.plans.stored import order_of_places, total_by_place_year
from tallystar.reference import default_reference
from tallystar.sources import tables
from tallystar.sources.driver_feed import feed
from tallystar.sources.raw import raw_frame


def settings(spark):
    names = (storage.OPEN_FILES_CONF, storage.SCAN_TASKS_CONF, storage.SHUFFLE_TASKS_CONF)
    return {name: spark.conf.get(name, None) for name in names}


def rows(df):
    return sorted(map(str, df.collect()))


def test_tasks_follow_the_rows_while_the_star_is_written(spark, tmp_path, monkeypatch):
    seen = {}

    def watched(name, module):
        step = getattr(module, name)

        def call(*given, **named):
            seen[name] = settings(spark)
            return step(*given, **named)

        monkeypatch.setattr(module, name, call)

    watched("_stored", tables)
    watched("build_fact", star_module)
    monkeypatch.setattr(storage, "ROWS_PER_TASK", 1)
    raw = {year: raw_frame(spark, rows) for year, rows in feed_rows().items()}
    before, n = settings(spark), sum(map(len, feed_rows().values()))
    written = star_module.write_star(raw, default_reference(spark), str(tmp_path / "star"))
    assert int(seen["build_fact"][storage.SCAN_TASKS_CONF]) >= n
    assert int(seen["build_fact"][storage.SHUFFLE_TASKS_CONF]) >= n
    assert settings(spark) == before
    tables.write_staging(written.staging, str(tmp_path / "again"))
    assert int(seen["_stored"][storage.OPEN_FILES_CONF]) == tables.OPEN_YEARS
    assert settings(spark) == before
    expected = star_of(spark, feed_rows())
    for name in ("fact", "place_year", "place_order"):
        of_star = getattr(expected, name)
        assert rows(getattr(written, name).select(of_star.columns)) == rows(of_star), name


def test_settings_come_back_after_a_failure(spark):
    before = settings(spark)
    try:
        with storage.tasks_for(spark, 10**9):
            assert spark.conf.get(storage.SHUFFLE_TASKS_CONF) == "1000"
            raise ValueError
    except ValueError:
        pass
    assert settings(spark) == before


def test_places_of_equal_totals_over_many_partitions(spark, tmp_path, monkeypatch):
    choose = random.Random(5)
    places = [(i, f"S{i % 3}", f"M{choose.randrange(10**6):06}-{i}") for i in range(400)]
    totals = [(k, y, i, 7 if i % 4 else choose.randrange(20)) for k in (1, 2) for y in (2030, 2031) for i in range(400)]
    place_year = spark.createDataFrame(totals, "indicator_id int, year int, place_id bigint, total int")
    place_year = place_year.withColumn("total", F.col("total").cast("decimal(34,10)"))
    dim = spark.createDataFrame(places, "place_id bigint, state string, municipality string")
    adaptive = "spark.sql.adaptive.coalescePartitions.enabled"
    monkeypatch.setattr(storage, "ROWS_PER_TASK", 500)
    spark.conf.set(adaptive, False)
    try:
        with storage.tasks_for(spark, len(totals)):
            ordered = order_of_places(place_year, dim, lambda df: tables.write_table(df, str(tmp_path / "sorted")))
            written = tables.write_table(ordered, str(tmp_path / "order"))
    finally:
        spark.conf.unset(adaptive)
    assert len(list((tmp_path / "sorted").glob("part-*"))) > 3
    found = {(r.indicator_id, r.year, r.place_id): (r.position, r.state_position, r.rank) for r in written.collect()}

    lists = {}
    for k, y, i, total in totals:
        lists.setdefault((k, y), {})[i] = total
        lists.setdefault((k, None), {}).setdefault(i, 0)
        lists[k, None][i] += total
    assert len(found) == sum(map(len, lists.values()))
    for key, members in lists.items():
        in_order = sorted(members, key=lambda i: (-members[i], places[i][2], places[i][1]))
        in_state = {}
        for position, i in enumerate(in_order, 1):
            in_state[i % 3] = in_state.get(i % 3, 0) + 1
            rank = 1 + sum(total > members[i] for total in members.values())
            assert found[*key, i] == (position, in_state[i % 3], rank)


def inputs_of_joins(df, column):
    """The columns that enter each join on a condition with this column from its left, as names."""
    found, nodes = [], [df._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        below = node.children()
        nodes += [below.apply(i) for i in range(below.size())]
        if node.nodeName() == "Join" and column in node.condition().toString():
            found.append({name.split("#")[0] for name in below.apply(0).output().mkString(",").split(",")})
    return found


def test_growing_tables_are_joined_with_narrow_rows(spark, star):
    (lines,) = inputs_of_joins(feed(spark, SF), "l_partkey")
    assert "n_name" not in lines and "state" not in lines and "municipality" not in lines
    for columns in inputs_of_joins(build_fact(star.grain, star.dims), "municipality"):
        assert "value" in columns
        assert not columns & {"indicator", "jurisdiction", "weapon", "female", "weight_value", "measure"}


def test_fact_of_null_and_unknown_keys(spark, star):
    one = star.grain.where("count_value IS NOT NULL").limit(1)
    odd = one.unionByName(one.withColumn("municipality", F.lit(None).cast("string")))
    odd = odd.unionByName(one.withColumn("municipality", F.lit("nowhere"))).withColumn("weight_value", F.col("count_value"))
    found = build_fact(odd, star.dims)
    assert found.count() == 6 and found.where("place_id IS NULL").count() == 4
    assert found.where("time_id IS NULL OR indicator_id IS NULL").count() == 0


def test_sums_of_places_take_one_shuffle_each(spark, star, tmp_path):
    sums = total_by_place_year(tables.clustered(star.fact, "source_year"))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "rangepartitioning(source_year" in plan
    written = tables.write_clustered(sums, str(tmp_path / "sums"), "year")
    assert rows(written.select(star.place_year.columns)) == rows(star.place_year)
    assert all(".zstd." in f.name for f in (tmp_path / "sums").glob("*/part-*"))

    plans = []

    def keep(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return storage.settle(df)

    order_of_places(storage.settle(star.place_year), star.dim("place"), keep)
    dealt = [line for line in plans[0].splitlines() if "Exchange hashpartitioning(" in line]
    assert dealt and not any("hashpartitioning(indicator_id" in line for line in dealt)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def left_behind(spark, before, seconds=20):
    """Shuffles that came since and stay: Spark removes them in the background."""
    until = time.monotonic() + seconds
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    return left


def test_the_build_leaves_no_shuffles_and_no_scratch_tables(spark, tmp_path):
    raw, before = feed(spark, SF), shuffle_files(spark)
    tables.write_landing(raw, str(tmp_path / "landing"))
    assert not left_behind(spark, before)
    raw = {year: raw_frame(spark, rows) for year, rows in feed_rows().items()}
    written = star_module.write_star(raw, default_reference(spark), str(tmp_path / "star"))
    assert not left_behind(spark, before)
    folders = {path.name for path in (tmp_path / "star").iterdir()}
    assert folders == {*star_module.STORED, *(f"dim_{name}" for name in written.dims)}
    assert spark.conf.get(storage.CLEANUP_CONF) == "false"


def test_the_fine_grain_leaves_no_shuffle(spark, feed_context):
    before = shuffle_files(spark)
    found = reconciled_fine(feed_context)
    assert not left_behind(spark, before)
    assert {row.status for row in found.collect()} == {"PASS"}


def test_partitions_of_shuffles_stay_small_while_the_star_is_written(spark, tmp_path, monkeypatch):
    seen, stored = [], tables._stored
    limits = (storage.JOINED_CONF, storage.HASH_JOIN_CONF)

    def watched(*given, **named):
        seen.append([spark.conf.get(name) for name in limits])
        return stored(*given, **named)

    monkeypatch.setattr(tables, "_stored", watched)
    raw = {year: raw_frame(spark, rows) for year, rows in feed_rows().items()}
    before = [spark.conf.get(name, None) for name in limits]
    star_module.write_star(raw, default_reference(spark), str(tmp_path / "star"))
    assert {joined for joined, _ in seen} == {str(8 << 20)}
    assert {hashed for _, hashed in seen[1:]} == {str(8 << 20)}
    spark.conf.set(storage.JOINED_CONF, "2m")  # a smaller setting of the session stays
    try:
        with storage.building(spark):
            assert spark.conf.get(storage.JOINED_CONF) == str(2 << 20)
        assert spark.conf.get(storage.JOINED_CONF) == "2m"
    finally:
        spark.conf.unset(storage.JOINED_CONF)
    assert [spark.conf.get(name, None) for name in limits] == before
