"""Ranks and percentiles against brute force, with one group holding a third of the rows."""

import math
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallystar.functions.columns import share_of
from tallystar.operators.ordering import quantiles, rank_within, window_rank

POINTS = {"p50": 0.5, "p90": 0.9, "p99": 0.99, "least": 0.0, "most": 1.0}


def interpolated(values, point):
    values = sorted(values)
    position = point * (len(values) - 1)
    low, high = math.floor(position), math.ceil(position)
    return values[low] + (position - low) * (values[high] - values[low])


def skewed_rows(seed=7):
    """Groups with small, large, negative and repeated values; group 0 has a third of all rows."""
    random.seed(seed)
    rows = []
    for i in range(1500):
        group = 0 if i % 3 == 0 else random.randrange(1, 6)
        value = random.choice(
            [0, random.randrange(50), random.randrange(10**6), random.randrange(10**10), round(random.random() * 10**5, 3), -random.randrange(10**5)]
        )
        rows.append((None if group == 5 else group, Decimal(str(value))))
    return rows


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.createDataFrame(skewed_rows(), "g int, v decimal(14,3)")


def test_quantiles_match_brute_force(skewed):
    groups = {}
    for group, value in skewed_rows():
        groups.setdefault(group, []).append(float(value))
    found = {r.g: r for r in quantiles(skewed, ["g"], "v", POINTS).collect()}
    assert set(found) == set(groups)
    for group, values in groups.items():
        for name, point in POINTS.items():
            assert found[group][name] == pytest.approx(interpolated(values, point), abs=1e-6), (group, name)


def test_quantiles_of_fine_values_and_a_bucket_with_all_rows(spark):
    """Values a ten-billionth apart share both kinds of buckets; all points come from one pass over the buckets."""
    rows = [(1, Decimal(i).scaleb(-10)) for i in range(700)] + [(1, Decimal("0.5"))] * 300 + [(2, Decimal("12345678901.0000000001"))]
    df = spark.createDataFrame(rows, "g int, v decimal(24,10)").repartition(5)
    many = {f"p{i}": i / 20 for i in range(21)}
    found = {r.g: r for r in quantiles(df, ["g"], "v", many).collect()}
    values = [float(v) for g, v in rows if g == 1]
    for name, point in many.items():
        assert found[1][name] == pytest.approx(interpolated(values, point), abs=1e-15)
        assert found[2][name] == float(Decimal("12345678901.0000000001"))
    plan = quantiles(df, ["g"], "v", many)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2


def test_quantiles_without_keys_and_with_weights(skewed):
    everything = [float(v) for _, v in skewed_rows()]
    row = quantiles(skewed, [], "v", {"p95": 0.95}).first()
    counted = skewed.groupBy("v").agg(F.count("*").alias("times"))
    weighted = quantiles(counted, [], "v", {"p95": 0.95}, "times").first()
    expected = interpolated(everything, 0.95)
    for found in (row, weighted):
        assert found.p95 == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("dense", [False, True])
def test_ranks_match_windows_and_brute_force(skewed, dense):
    known = skewed.where("g is not null")
    ours = rank_within(known, ["g"], "v", "r", dense)
    both = window_rank(ours, ["g"], "v", "w", dense)
    assert ours.count() == known.count() and both.where("not (r <=> w)").isEmpty()
    rows = [(g, v) for g, v in skewed_rows() if g == 0]
    ahead = {v: (len({x for _, x in rows if x > v}) if dense else sum(x > v for _, x in rows)) + 1 for _, v in rows}
    for r in ours.where("g = 0").collect():
        assert r.r == ahead[r.v]


def test_ranks_of_null_keys_and_null_values(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), (1, None), (1, 5)], "g int, v int")
    found = sorted(((r.g, r.v), r.r) for r in rank_within(df, ["g"], "v", "r").collect() if r.g is None)
    assert found == [((None, 1), 2), ((None, 3), 1)]
    assert {r.v: r.r for r in rank_within(df, ["g"], "v", "r").collect() if r.g == 1} == {None: None, 5: 1}


def test_ranks_without_keys(spark):
    df = spark.createDataFrame([(v,) for v in (5, 5, 70000, 1)], "v int")
    assert sorted((r.v, r.r) for r in rank_within(df, [], "v", "r").collect()) == [(1, 4), (5, 2), (5, 2), (70000, 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(min_value=0, max_value=99_999_999, places=3), min_size=1, max_size=40))
def test_quantiles_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v decimal(14,3)")
    found = quantiles(df, [], "v", {"m": 0.5, "p": 0.9}).first()
    numbers = [float(v) for v in values]
    assert found.m == pytest.approx(interpolated(numbers, 0.5), abs=1e-6)
    assert found.p == pytest.approx(interpolated(numbers, 0.9), abs=1e-6)


def test_shares_of_a_hot_parent_and_of_zero(spark):
    rows = [("hot", i, 1) for i in range(60)] + [("cold", 1, 3), ("cold", 2, 1), ("none", 1, 0), (None, 1, 2)]
    df = spark.createDataFrame(rows, "parent string, item int, v int")
    shared = share_of(df, "v", ["parent"], "s")
    assert shared.count() == len(rows)
    found = {(r.parent, r.item): r.s for r in shared.collect()}
    assert found[("hot", 3)] == pytest.approx(1 / 60) and found[("cold", 1)] == 0.75
    assert found[("none", 1)] is None and found[(None, 1)] == 1.0


@pytest.mark.parametrize("dense", [False, True])
def test_ranks_of_wide_totals_and_a_group_with_all_rows(spark, dense):
    """Totals up to 10**15 in one group, with a tie that holds half of all rows."""
    rows = [(1, 10**15 - 10**11 * i) for i in range(300)] + [(1, 7)] * 350 + [(2, 5), (1, -3)]
    df = spark.createDataFrame(rows, "g int, v long").repartition(6)
    values = sorted({v for g, v in rows if g == 1}, reverse=True)
    expected = {v: i + 1 if dense else 1 + sum(x > v for g, x in rows if g == 1) for i, v in enumerate(values)}
    found = rank_within(df, ["g"], "v", "r", dense).collect()
    assert len(found) == len(rows) and all(r.r == (expected[r.v] if r.g == 1 else 1) for r in found)
