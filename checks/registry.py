"""Every registered query: its name, the DataFrame it returns, and the same result in SQL.

The SQL strings follow the base tables of `checks.base_sql`. Percentages and other computed doubles
are compared at six decimals, where both engines round alike.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base_sql import BASE
from checks.context import Context, context, plain, published
from tallystar.operators import profile, quality
from tallystar.operators.dimensions import month_counts
from tallystar.operators.facts import LOOKUPS, aggregate_to_grain, bad_values, build_fact, merged_rows, unpivot, unresolved, with_keys
from tallystar.operators.staging import build_staging
from tallystar.plans import job, measures, queries, views
from tallystar.plans.star import source_year_mismatches
from tallystar.reference import unmapped
from tallystar.sources.tables import write_table
from tallystar.storage import building, run_dir, tasks_for


@dataclass(frozen=True)
class Entry:
    frame: Callable[[Context], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def add(name: str, frame: Callable[[Context], DataFrame], sql: str | None) -> None:
    assert name not in ENTRIES, name
    ENTRIES[name] = Entry(frame, BASE + sql if sql else None)


# Through text: the nearest double of a wide decimal, which a direct cast may miss by its last bit.
D = "CAST(CAST({} AS VARCHAR) AS DOUBLE)".format


def r6(expression: str) -> str:
    return f"ROUND({expression}, 6) + CAST(0 AS DOUBLE)"


def pct(top: str, bottom: str) -> str:
    return r6(f"100 * CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0)")


def rat(top: str, bottom: str) -> str:
    return r6(f"CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0)")


MEAN = r6("CAST(SUM(value) AS DOUBLE) / COUNT(*)")
TOTAL = D("SUM(value)")
LABELS = "indicator, family, unit"


def q(point: float) -> str:
    return r6(f"QUANTILE_CONT(CAST(value AS DOUBLE), {point})")


# --- sources, staging, grain, fact -------------------------------------------

add(
    "src3_all_years",
    lambda c: c.raw.groupBy("source_year").agg(
        F.count("*").alias("row_count"),
        F.count("victim_total").alias("victim_rows"),
        F.count("weight_value").alias("weight_rows"),
    ),
    "SELECT source_year, COUNT(*) AS row_count, COUNT(victim_total) AS victim_rows, COUNT(weight_value) AS weight_rows FROM raw GROUP BY source_year",
)
MEASURE_DOUBLES = ", ".join(f"{D(m)} AS {m}" for m in ("female", "male", "unknown_sex", "count_value", "weight_value"))
add(
    "stg_staging_rows",
    lambda c: c.star.staging,
    f"SELECT state, municipality, indicator, ref_month, agent, weapon, age_band, {MEASURE_DOUBLES}, jurisdiction, source_year FROM staging",
)
add(
    "stg7_layer_counts",
    lambda c: quality.layer_counts({"raw": c.raw, "staging": c.star.staging, "grain": c.star.grain, "fact": c.star.fact}),
    """SELECT 'raw' AS layer, COUNT(*) AS row_count FROM raw UNION ALL SELECT 'staging', COUNT(*) FROM staging
       UNION ALL SELECT 'grain', COUNT(*) FROM grain UNION ALL SELECT 'fact', COUNT(*) FROM long""",
)
add(
    "agg1_grain_rows",
    lambda c: c.star.grain,
    f"SELECT state, municipality, indicator, ref_month, jurisdiction, agent, weapon, age_band, source_year, {MEASURE_DOUBLES} FROM grain",
)
add(
    "agg2_merged_rows",
    lambda c: merged_rows(c.star.staging, c.star.grain),
    """SELECT (SELECT COUNT(*) FROM staging) AS staging_rows, (SELECT COUNT(*) FROM grain) AS grain_rows,
       (SELECT COUNT(*) FROM staging) - (SELECT COUNT(*) FROM grain) AS merged_rows""",
)
add(
    "key1_resolved_ids",
    lambda c: with_keys(c.star.grain, c.star.dims).groupBy("indicator").agg(
        *[F.count(id_name).alias(id_name) for id_name in LOOKUPS]
    ),
    """SELECT indicator, COUNT(*) AS time_id, COUNT(*) AS place_id, COUNT(*) AS indicator_id, COUNT(*) AS jurisdiction_id,
       COUNT(agent) AS agent_id, COUNT(weapon) AS weapon_id, COUNT(age_band) AS age_band_id FROM grain GROUP BY indicator""",
)
add(
    "key3_unresolved_rows",
    lambda c: unresolved(with_keys(c.star.grain, c.star.dims)).agg(F.count("*").alias("unresolved_rows")),
    """SELECT COUNT(*) AS unresolved_rows FROM grain g LEFT JOIN dim_place p ON p.state = g.state AND p.municipality = g.municipality
       LEFT JOIN dim_indicator i ON i.indicator = g.indicator LEFT JOIN dim_time t ON t.ref_month = g.ref_month
       LEFT JOIN dim_jurisdiction j ON j.jurisdiction = g.jurisdiction
       WHERE place_id IS NULL OR indicator_id IS NULL OR time_id IS NULL OR jurisdiction_id IS NULL""",
)
add(
    "unp1_long_rows",
    lambda c: unpivot(with_keys(c.star.grain, c.star.dims)).groupBy("measure", "sex_id").agg(
        F.count("*").alias("row_count"), F.sum("value").alias("total")
    ),
    f"""SELECT CASE sex WHEN 'Feminino' THEN 'female' WHEN 'Masculino' THEN 'male' WHEN 'Não Informado' THEN 'unknown_sex'
               ELSE CASE family WHEN 'count' THEN 'count_value' ELSE 'weight_value' END END AS measure,
               sex_id, COUNT(*) AS row_count, {TOTAL} AS total FROM labelled GROUP BY 1, 2""",
)
add(
    "unp3_bad_values",
    lambda c: bad_values(c.star.fact),
    "SELECT COUNT(*) FILTER (WHERE value < 0) AS negative_values, COUNT(*) FILTER (WHERE value IS NULL) AS null_values FROM labelled",
)
IDS = "time_id, place_id, indicator_id, jurisdiction_id, agent_id, weapon_id, age_band_id, sex_id"
add("fct1_fact_rows", lambda c: c.star.fact, f"SELECT {IDS}, {D('value')} AS value, source_year FROM labelled")
MISSING = f"SELECT *, ROUND(100.0 * missing_cells / NULLIF(applicable_cells, 0), 6) AS pct_missing FROM missing"
add("fct2_not_reported", lambda c: views.quality_not_reported(c.star, digits=6), MISSING)
add(
    "fct3_victim_totals",
    lambda c: views.victim_totals(c.star),
    f"SELECT indicator, ref_month, {TOTAL} AS victim_total FROM labelled WHERE family = 'victim' GROUP BY ALL",
)
add(
    "src_source_year_mismatches",
    lambda c: source_year_mismatches(c.star.grain),
    "SELECT COUNT(*) FILTER (WHERE source_year <> year(ref_month)) AS rows_of_another_year FROM grain",
)

# --- dimensions and reference ------------------------------------------------

for dimension, number in (
    ("time", 2), ("place", 4), ("jurisdiction", 6), ("agent", 7), ("weapon", 8), ("age_band", 9),
):
    add(f"dim{number}_{dimension}", lambda c, d=dimension: c.star.dim(d), f"SELECT * FROM dim_{dimension}")


def with_fact_rows(c: Context, labels: DataFrame, dimension: str) -> DataFrame:
    """Members of a configured dimension with the number of their fact rows, 0 for those absent from the data."""
    used = c.star.fact.groupBy(f"{dimension}_id").agg(F.count("*").alias("_rows"))
    counted = labels.join(used, f"{dimension}_id", "left")
    return counted.withColumn("fact_rows", F.coalesce("_rows", F.lit(0))).drop("_rows")


def used_sql(dimension: str, columns: str = "d.*") -> str:
    return f"""SELECT {columns}, COALESCE(u.fact_rows, 0) AS fact_rows FROM dim_{dimension} d
        LEFT JOIN (SELECT {dimension}_id, COUNT(*) AS fact_rows FROM labelled GROUP BY 1) u ON u.{dimension}_id = d.{dimension}_id"""


add("dim5_indicator", lambda c: with_fact_rows(c, c.star.dim("indicator"), "indicator"), used_sql("indicator", "d.* EXCLUDE (semantic_group)"))
add("dim10_sex", lambda c: with_fact_rows(c, c.star.dim("sex"), "sex"), used_sql("sex"))
add(
    "src4_feed_rows",
    lambda c: c.raw.agg(F.count("*").alias("feed_rows")),
    "SELECT (SELECT COUNT(*) FROM lineitem) + 2 * COUNT(*) AS feed_rows FROM orders",
)
FINE = "CAST(weight_value * CAST(0.00123 AS DECIMAL(6,5)) AS DECIMAL(28,10))"


def with_fine_cells(raw: DataFrame) -> DataFrame:
    """Weights with up to seven decimals."""
    fine = F.col("weight_value").cast("decimal(28,10)") * F.lit("0.00123").cast("decimal(6,5)")
    return raw.withColumn("weight_value", fine.cast("decimal(28,10)"))


add(
    "stg3_fine_cells",
    lambda c: aggregate_to_grain(build_staging(with_fine_cells(c.raw)))
    .groupBy("indicator").agg(F.sum("weight_value").alias("weight_total")).where("weight_total IS NOT NULL"),
    f"SELECT indicator, {D(f'SUM({FINE})')} AS weight_total FROM staging GROUP BY indicator HAVING SUM(weight_value) IS NOT NULL",
)
add(
    "dim3_partial_years",
    lambda c: month_counts(c.star.staging).withColumn("is_partial_year", F.col("months") < 12),
    "SELECT CAST(year(ref_month) AS BIGINT) AS year, COUNT(DISTINCT ref_month) AS months, COUNT(DISTINCT ref_month) < 12 AS is_partial_year FROM staging GROUP BY 1",
)
add(
    "dim11_dimension_sizes",
    lambda c: quality.layer_counts(dict(c.star.dims)),
    " UNION ALL ".join(
        f"SELECT '{d}' AS layer, COUNT(*) AS row_count FROM dim_{d}"
        for d in ("time", "place", "indicator", "jurisdiction", "agent", "weapon", "age_band", "sex")
    ),
)
add(
    "ref2_region_map",
    lambda c: c.star.reference.regions,
    "SELECT n_name AS state, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey",
)
add(
    "ref3_unmapped_values",
    lambda c: unmapped(c.star.staging, c.star.reference.indicators, "indicator").agg(F.count("*").alias("n")).select(
        F.lit("indicator").alias("column_name"), F.col("n").alias("unmapped")
    ).unionByName(
        unmapped(c.star.staging, c.star.reference.regions, "state").agg(F.count("*").alias("n")).select(
            F.lit("state").alias("column_name"), F.col("n").alias("unmapped")
        )
    ),
    """SELECT 'indicator' AS column_name, COUNT(*) AS unmapped FROM (SELECT DISTINCT indicator FROM staging) s
         WHERE NOT EXISTS (SELECT 1 FROM classified x WHERE x.indicator = s.indicator)
       UNION ALL SELECT 'state', COUNT(*) FROM (SELECT DISTINCT state FROM staging) s
         WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_name = s.state)""",
)
add(
    "ref5_semantic_groups",
    lambda c: measures.sliced(c.star, ["kind", "semantic_group"]).select("kind", "semantic_group", "row_count"),
    "SELECT kind, semantic_group, COUNT(*) AS row_count FROM labelled GROUP BY ALL",
)

# --- quality and reconciliation ----------------------------------------------


def check_sql(name: str, n_bad: str, detail: str, source: str) -> str:
    return f"""SELECT '{name}' AS "check", CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(n AS BIGINT) AS n_bad, {detail} AS detail
               FROM (SELECT {n_bad} FROM {source})"""


CHECKS = {
    "dq1_unique_grain": (
        lambda c: quality.check_unique_grain(c.star.fact),
        check_sql(
            "unique_grain", "COALESCE(SUM(k), 0) AS n", "n || ' rows share a key'",
            f"(SELECT COUNT(*) AS k FROM labelled GROUP BY {IDS} HAVING COUNT(*) > 1)",
        ),
    ),
    "dq2_no_negative": (
        lambda c: quality.check_no_negative(c.star.fact, c.star.dim("indicator")),
        check_sql("no_negative_values", "COUNT(*) FILTER (WHERE value < 0) AS n", "n || ' negative values'", "labelled"),
    ),
    "dq3_mandatory": (
        lambda c: quality.check_mandatory(c.star.fact, c.star.dim("indicator")),
        check_sql(
            "mandatory_fields",
            "COUNT(*) - COUNT(time_id) AS t, COUNT(*) - COUNT(place_id) AS p, COUNT(*) - COUNT(indicator_id) AS i, "
            "COUNT(*) - COUNT(jurisdiction_id) AS j, COUNT(*) - COUNT(value) AS v, t + p + i + j + v AS n",
            "'time_id: ' || t || ', place_id: ' || p || ', indicator_id: ' || i || ', jurisdiction_id: ' || j || ', value: ' || v",
            "labelled",
        ),
    ),
    "dq4_sex": (
        lambda c: quality.check_sex(c.star.fact, c.star.dim("indicator")),
        check_sql(
            "sex_consistency",
            "COUNT(*) FILTER (WHERE family = 'victim' AND sex_id IS NULL) AS a, "
            "COUNT(*) FILTER (WHERE family <> 'victim' AND sex_id IS NOT NULL) AS b, a + b AS n",
            "'victim rows without sex: ' || a || ', other rows with sex: ' || b",
            "labelled",
        ),
    ),
    "dq5_one_family": (
        lambda c: quality.check_one_family(c.star.fact, c.star.dim("indicator")),
        check_sql(
            "one_family_per_indicator", "COUNT(*) FILTER (WHERE f <> 1) AS n", "n || ' indicators without exactly one family'",
            "(SELECT COUNT(DISTINCT family) AS f FROM labelled GROUP BY indicator_id)",
        ),
    ),
    "dq6_units": (
        lambda c: quality.check_units(with_fact_rows(c, c.star.dim("indicator"), "indicator")),
        check_sql(
            "unit_present", "COUNT(*) FILTER (WHERE unit IS NULL OR TRIM(unit) = '') AS n", "n || ' indicators without a unit'",
            "(SELECT DISTINCT indicator, unit FROM labelled)",
        ),
    ),
    "dq7_time": (
        lambda c: quality.check_time(c.star.dim("time")),
        check_sql(
            "time_consistency",
            "COUNT(*) FILTER (WHERE flags <> 1 OR flag <> (months < 12)) AS a, COUNT(*) FILTER (WHERE NOT (lo = 1 AND hi = months AND d = months)) AS b, "
            "CAST(SUM(months - dates) AS BIGINT) AS e, a + b + e AS n",
            "'years with a wrong flag: ' || a || ', with a gap: ' || b || ', repeated dates: ' || e",
            "(SELECT year, COUNT(*) AS months, COUNT(DISTINCT month) AS d, MIN(month) AS lo, MAX(month) AS hi, "
            "COUNT(DISTINCT is_partial_year) AS flags, BOOL_OR(is_partial_year) AS flag, COUNT(DISTINCT ref_month) AS dates FROM dim_time GROUP BY year)",
        ),
    ),
    "dq8_row_counts": (
        lambda c: quality.check_row_counts(c.raw, c.star.staging),
        check_sql(
            "staging_keeps_rows", "ABS(r - s) AS n, r, s", "'raw: ' || r || ', staging: ' || s",
            "(SELECT (SELECT COUNT(*) FROM raw) AS r, (SELECT COUNT(*) FROM staging) AS s)",
        ),
    ),
}
for name, (frame, sql) in CHECKS.items():
    add(name, frame, sql)
add(
    "dq9_all_checks",
    lambda c: quality.run_checks(c.raw, c.star.staging, c.star.fact, c.star.dims),
    " UNION ALL ".join(sql for _, sql in CHECKS.values()),
)
FAMILY_TOTAL = """CASE i.family WHEN 'victim' THEN COALESCE(SUM(female), 0) + COALESCE(SUM(male), 0) + COALESCE(SUM(unknown_sex), 0)
                  WHEN 'count' THEN COALESCE(SUM(count_value), 0) ELSE COALESCE(SUM(weight_value), 0) END"""
for layer, number in (("raw", 1), ("staging", 2)):
    add(
        f"rec1_{layer}_totals",
        lambda c, layer=layer: quality.source_totals(
            c.raw if layer == "raw" else c.star.staging, c.star.dim("indicator"), "total"
        ),
        f"SELECT x.indicator, CAST({FAMILY_TOTAL} AS DOUBLE) AS total FROM {layer} x JOIN dim_indicator i ON i.indicator = x.indicator GROUP BY x.indicator, i.family",
    )
add(
    "rec2_fact_totals",
    lambda c: quality.fact_totals(c.star.fact, c.star.dim("indicator")),
    f"SELECT indicator, {TOTAL} AS fact_total FROM labelled GROUP BY indicator",
)
RECONCILED = f"""SELECT i.indicator, i.family, COALESCE(r.t, 0) AS raw_total, COALESCE(s.t, 0) AS staging_total, COALESCE(f.t, 0) AS fact_total,
    COALESCE(f.t, 0) - COALESCE(r.t, 0) AS difference,
    CASE WHEN ABS(COALESCE(f.t, 0) - COALESCE(r.t, 0)) <= 0.000001 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM dim_indicator i
  LEFT JOIN (SELECT x.indicator, CAST({FAMILY_TOTAL} AS DOUBLE) AS t FROM raw x JOIN dim_indicator i ON i.indicator = x.indicator GROUP BY x.indicator, i.family) r ON r.indicator = i.indicator
  LEFT JOIN (SELECT x.indicator, CAST({FAMILY_TOTAL} AS DOUBLE) AS t FROM staging x JOIN dim_indicator i ON i.indicator = x.indicator GROUP BY x.indicator, i.family) s ON s.indicator = i.indicator
  LEFT JOIN (SELECT indicator, {TOTAL} AS t FROM labelled GROUP BY indicator) f ON f.indicator = i.indicator"""


def reconciled(c: Context) -> DataFrame:
    return quality.reconcile(c.raw, c.star.staging, c.star.fact, c.star.dim("indicator"))


add("rec3_reconciliation", reconciled, RECONCILED)


def reconciled_fine(c: Context) -> DataFrame:
    """Reconciliation of a feed with more decimals than the warehouse keeps: it passes, as nothing is rounded on the way."""
    raw, indicators, spark = with_fine_cells(c.raw), c.star.dim("indicator"), c.star.spark
    staging = build_staging(raw)
    # Written like the star's own grain: its shuffle is gone before the lookups shuffle, and tasks follow the rows.
    with building(spark), tasks_for(spark, c.star.counts["staging"]):
        grain = write_table(aggregate_to_grain(staging), f"{run_dir(spark, 'fine')}/grain")
    return quality.reconcile(raw, staging, build_fact(grain, c.star.dims), indicators)


RECONCILED_FINE = RECONCILED.replace("weight_value", FINE).replace("FROM labelled", "FROM (SELECT indicator, CASE family WHEN 'weight' THEN CAST(value * CAST(0.00123 AS DECIMAL(6,5)) AS DECIMAL(28,10)) ELSE value END AS value FROM labelled)")
add(
    "rec3_fine_cells",
    lambda c: reconciled_fine(c).select("indicator", "family", "raw_total", "staging_total", "fact_total", "status"),
    f"SELECT indicator, family, raw_total, staging_total, fact_total, 'PASS' AS status FROM ({RECONCILED_FINE})",
)
add(
    "rec4_reconciliation_tally",
    lambda c: quality.tally(reconciled(c)),
    f"SELECT COUNT(*) AS checked, COUNT(*) FILTER (WHERE status = 'PASS') AS passed, COUNT(*) FILTER (WHERE status = 'FAIL') AS failed FROM ({RECONCILED})",
)
add(
    "run1_summary",
    lambda c: job.run_summary(c.star).withColumn("partial_years", F.concat_ws(",", F.col("partial_years").cast("array<string>"))),
    """SELECT (SELECT COUNT(*) FROM staging) AS staging_rows, (SELECT COUNT(*) FROM grain) AS grain_rows, (SELECT COUNT(*) FROM labelled) AS fact_rows,
       (SELECT COUNT(*) FROM dim_indicator) AS indicators, (SELECT COUNT(DISTINCT state) FROM dim_place) AS states,
       (SELECT COUNT(DISTINCT municipality) FROM dim_place) AS municipalities, (SELECT MIN(ref_month) FROM dim_time) AS first_month,
       (SELECT MAX(ref_month) FROM dim_time) AS last_month,
       (SELECT COALESCE(STRING_AGG(CAST(year AS VARCHAR), ',' ORDER BY year), '') FROM (SELECT DISTINCT year FROM dim_time WHERE is_partial_year)) AS partial_years""",
)
REFERENCED = ("time", "place", "indicator", "jurisdiction", "agent", "weapon", "age_band", "sex")
NATURAL = {"time": "ref_month", "place": "state, municipality"}
add(
    "snk7_constraints",
    lambda c: quality.constraint_violations(c.star.fact, c.star.dims),
    " UNION ALL ".join(
        [
            f'SELECT \'fact.{f} not null\' AS "constraint", COUNT(*) - COUNT({f}) AS violations FROM labelled'
            for f in ("time_id", "place_id", "indicator_id", "jurisdiction_id", "value")
        ]
        + [
            "SELECT 'fact.value >= 0', COUNT(*) FILTER (WHERE value < 0) FROM labelled",
            f"SELECT 'fact key unique', COUNT(*) FROM (SELECT 1 FROM labelled GROUP BY {IDS} HAVING COUNT(*) > 1)",
        ]
        + [
            part
            for d in REFERENCED
            for part in (
                f"SELECT 'fact.{d}_id references {d}', COUNT(*) FROM labelled f WHERE {d}_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_{d} x WHERE x.{d}_id = f.{d}_id)",
                f"SELECT '{d}({d}_id) unique', COUNT(*) FROM (SELECT 1 FROM dim_{d} GROUP BY {d}_id HAVING COUNT(*) > 1)",
                f"SELECT '{d}({NATURAL.get(d, d)}) unique', COUNT(*) FROM (SELECT 1 FROM dim_{d} GROUP BY {NATURAL.get(d, d)} HAVING COUNT(*) > 1)",
                f"SELECT '{d} not null', COUNT(*) FROM dim_{d} WHERE {d}_id IS NULL",
            )
        ]
    ),
)

# --- profiles ----------------------------------------------------------------

RAW_NAMES = (
    "state", "municipality", "indicator", "ref_month", "agent", "weapon", "age_band",
    "female", "male", "unknown_sex", "victim_total", "count_value", "weight_value", "jurisdiction",
)
TEXTS = ("state", "municipality", "indicator", "agent", "weapon", "age_band", "jurisdiction")
NUMBERS = ("female", "male", "unknown_sex", "victim_total", "count_value", "weight_value")
add(
    "prf1_nulls",
    lambda c: profile.column_nulls(c.raw).withColumn("pct_null", F.round(100 * F.col("nulls") / F.col("rows"), 6)),
    " UNION ALL ".join(
        f"""SELECT source_year, '{n}' AS "column", COUNT(*) AS "rows", COUNT(*) - COUNT({n}) AS nulls, ROUND(100.0 * (COUNT(*) - COUNT({n})) / COUNT(*), 6) AS pct_null FROM raw GROUP BY source_year"""
        for n in RAW_NAMES
    ),
)
add(
    "prf1_numbers",
    lambda c: profile.number_statistics(c.raw),
    " UNION ALL ".join(
        f"""SELECT source_year, '{n}' AS "column", {D(f'MIN({n})')} AS minimum, {D(f'MAX({n})')} AS maximum, {D(f'SUM({n})')} AS total,
            COUNT(*) FILTER (WHERE {n} < 0) AS negative, {rat(f'SUM({n})', f'COUNT({n})')} AS mean FROM raw GROUP BY source_year"""
        for n in NUMBERS
    ),
)
add(
    "prf1_fine_numbers",
    lambda c: profile.number_statistics(with_fine_cells(c.raw), ["weight_value"]).where("total IS NOT NULL"),
    f"""SELECT source_year, 'weight_value' AS "column", {D(f'MIN({FINE})')} AS minimum, {D(f'MAX({FINE})')} AS maximum, {D(f'SUM({FINE})')} AS total,
        COUNT(*) FILTER (WHERE {FINE} < 0) AS negative, {rat(f'SUM({FINE})', 'COUNT(weight_value)')} AS mean FROM raw GROUP BY source_year HAVING COUNT(weight_value) > 0""",
)
add(
    "prf1_months",
    lambda c: profile.month_statistics(c.raw),
    "SELECT source_year, MIN(ref_month) AS first_month, MAX(ref_month) AS last_month, COUNT(DISTINCT ref_month) AS months FROM raw GROUP BY source_year",
)
add(
    "prf1_months_list",
    lambda c: profile.months_list(c.raw),
    "SELECT DISTINCT source_year, strftime(ref_month, '%Y-%m') AS month FROM raw",
)
VALUES = " UNION ALL ".join(
    f"""SELECT source_year, '{n}' AS "column", {n} AS "value", COUNT(*) AS row_count FROM raw WHERE {n} IS NOT NULL GROUP BY ALL""" for n in TEXTS
)
add("prf1_value_counts", lambda c: profile.value_counts(c.raw), VALUES)
add(
    "prf1_distinct_counts",
    lambda c: profile.distinct_counts(c.raw),
    f"""SELECT source_year, "column", COUNT(*) AS distinct_values FROM ({VALUES}) GROUP BY ALL""",
)
add(
    "prf1_top_values",
    lambda c: profile.top_values(c.raw),
    f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_year, "column" ORDER BY row_count DESC, "value") AS position FROM ({VALUES})) WHERE position <= 20""",
)


def repeated_sql(keys: str) -> str:
    return f"""SELECT source_year, COUNT(*) AS groups, CAST(SUM(k) AS BIGINT) AS rows_in_groups, CAST(SUM(k) AS BIGINT) - COUNT(*) AS surplus_rows
               FROM (SELECT source_year, COUNT(*) AS k FROM raw GROUP BY source_year, {keys} HAVING COUNT(*) > 1) GROUP BY source_year"""


FULL = "state, municipality, indicator, ref_month, agent, weapon, age_band, jurisdiction"
REDUCED = "state, municipality, indicator, ref_month, jurisdiction"
ALL_RAW = ", ".join(RAW_NAMES)
add("prf2_repeated_keys", lambda c: profile.repetition(c.raw), repeated_sql(FULL))
add("prf2_identical_rows", lambda c: profile.identical_rows(c.raw), repeated_sql(ALL_RAW))
add(
    "prf3_candidate_keys",
    lambda c: profile.compare_keys(c.raw, {"full": profile.DIMENSIONAL_KEY, "reduced": profile.REDUCED_KEY}),
    f"SELECT *, 'full' AS candidate FROM ({repeated_sql(FULL)}) UNION ALL SELECT *, 'reduced' FROM ({repeated_sql(REDUCED)})",
)
add(
    "prf4_victim_totals",
    lambda c: profile.victim_total_mismatches(c.raw),
    """SELECT source_year, COUNT(victim_total) AS stated,
       COUNT(*) FILTER (WHERE victim_total <> COALESCE(female, 0) + COALESCE(male, 0) + COALESCE(unknown_sex, 0)) AS mismatches FROM raw GROUP BY source_year""",
)
add(
    "prf5_mixed_families",
    lambda c: profile.mixed_family_rows(c.raw),
    """SELECT source_year, COUNT(*) AS "rows", COUNT(*) FILTER (WHERE
       CAST(COALESCE(female, male, unknown_sex) IS NOT NULL AS INT) + CAST(count_value IS NOT NULL AS INT) + CAST(weight_value IS NOT NULL AS INT) > 1) AS mixed_rows
       FROM raw GROUP BY source_year""",
)
add(
    "prf6_repeats_by_state",
    lambda c: profile.repetition_by_state(c.raw, digits=6),
    f"""SELECT source_year, state, rows_in_groups, {pct('rows_in_groups', 'SUM(rows_in_groups) OVER (PARTITION BY source_year)')} AS pct_of_year
        FROM (SELECT source_year, state, CAST(SUM(k) AS BIGINT) AS rows_in_groups FROM
              (SELECT source_year, state, COUNT(*) AS k FROM raw GROUP BY source_year, {ALL_RAW} HAVING COUNT(*) > 1) GROUP BY ALL)""",
)

# --- views -------------------------------------------------------------------

add(
    "v01_fact_enriched",
    lambda c: views.enriched_fact(c.star),
    f"SELECT * EXCLUDE (value), {D('value')} AS value FROM labelled",
)
STATS = f"""COUNT(*) AS row_count, {TOTAL} AS total, {MEAN} AS mean, {q(0.5)} AS median, {D('MIN(value)')} AS minimum,
            {D('MAX(value)')} AS maximum, {r6('STDDEV_POP(CAST(value AS DOUBLE))')} AS deviation"""
add(
    "v02_agg_indicator_year",
    lambda c: views.indicator_year_statistics(c.star),
    f"SELECT indicator_id, source_year AS year, {STATS} FROM labelled GROUP BY indicator_id, source_year",
)
add(
    "v03_agg_indicator_place_year",
    lambda c: views.indicator_place_year(c.star),
    f"SELECT indicator_id, place_id, source_year AS year, {TOTAL} AS total FROM labelled GROUP BY indicator_id, place_id, source_year",
)
add(
    "v04_agg_indicator_jurisdiction_year",
    lambda c: views.indicator_jurisdiction_year(c.star),
    f"SELECT indicator_id, jurisdiction_id, source_year AS year, {TOTAL} AS total, COUNT(*) AS row_count FROM labelled GROUP BY indicator_id, jurisdiction_id, source_year",
)
add("v05_year_flags", lambda c: views.year_flags(c.star), "SELECT DISTINCT year, is_partial_year FROM dim_time")
add(
    "v06_national",
    lambda c: views.national(c.star),
    f"SELECT {LABELS}, kind, semantic_group, source_year AS year, is_partial_year, {STATS} FROM labelled GROUP BY ALL",
)
PLACE_TOTALS = f"""SELECT {LABELS}, semantic_group, state, region, municipality, source_year AS year, is_partial_year, SUM(value) AS total
                   FROM labelled GROUP BY ALL"""
STATE_TOTALS = f"SELECT {LABELS}, semantic_group, state, region, year, is_partial_year, SUM(total) AS total, CAST(SUM(total) AS DOUBLE) / COUNT(*) AS mean FROM ({PLACE_TOTALS}) GROUP BY ALL"
add(
    "v07_by_state",
    lambda c: views.by_state(c.star),
    f"SELECT * REPLACE ({D('total')} AS total, {r6('mean')} AS mean) FROM ({STATE_TOTALS})",
)
add(
    "v08_by_municipality",
    lambda c: views.by_municipality(c.star),
    f"SELECT * EXCLUDE (region) REPLACE ({D('total')} AS total) FROM ({PLACE_TOTALS})",
)
INDICATOR_YEAR = f"""SELECT {LABELS}, kind, semantic_group, source_year AS year, SUM(value) AS total, {MEAN} AS mean, {q(0.5)} AS median FROM labelled GROUP BY ALL"""
add(
    "v09_by_indicator",
    lambda c: views.by_indicator(c.star, digits=6),
    f"""SELECT * REPLACE ({D('total')} AS total), {D('SUM(total) OVER f')} AS family_year_total, {pct('total', 'SUM(total) OVER f')} AS pct_of_family
        FROM ({INDICATOR_YEAR}) WINDOW f AS (PARTITION BY family, year)""",
)
JURISDICTIONS = f"SELECT {LABELS}, jurisdiction, source_year AS year, SUM(value) AS total, COUNT(*) AS row_count FROM labelled GROUP BY ALL"
add("v10_by_jurisdiction", lambda c: views.by_jurisdiction(c.star), f"SELECT * REPLACE ({D('total')} AS total) FROM ({JURISDICTIONS})")


def class_share(columns: str, name: str) -> str:
    return f"""SELECT * REPLACE ({D('total')} AS total), {pct('total', 'SUM(total) OVER (PARTITION BY indicator, year)')} AS pct
               FROM (SELECT {columns}, source_year AS year, {name}, SUM(value) AS total FROM labelled WHERE {name} IS NOT NULL GROUP BY ALL)"""


add("v11_by_sex", lambda c: views.by_sex(c.star, digits=6), class_share("indicator, kind", "sex"))
add("v12_by_age_band", lambda c: views.by_age_band(c.star, digits=6), class_share("indicator", "age_band"))
add(
    "v13_by_agent",
    lambda c: views.by_agent(c.star),
    f"SELECT indicator, source_year AS year, agent, {TOTAL} AS total FROM labelled WHERE agent IS NOT NULL GROUP BY ALL",
)
add(
    "v14_by_weapon",
    lambda c: views.by_weapon(c.star),
    f"""SELECT year, weapon, {D('total')} AS total, RANK() OVER (PARTITION BY year ORDER BY total DESC) AS "rank"
        FROM (SELECT source_year AS year, weapon, SUM(value) AS total FROM labelled WHERE weapon IS NOT NULL GROUP BY ALL)""",
)
add(
    "v15_agg_indicator_month",
    lambda c: views.indicator_month(c.star),
    f"SELECT indicator_id, time_id, {TOTAL} AS total FROM labelled GROUP BY indicator_id, time_id",
)
add("v16_monthly_series", lambda c: views.monthly_series(c.star), f"SELECT * REPLACE ({D('total')} AS total) FROM series")
METRICS = f"""SELECT * REPLACE ({D('total')} AS total, {D('previous_month')} AS previous_month, {D('same_month_last_year')} AS same_month_last_year,
                               {r6('moving_mean_3')} AS moving_mean_3),
              {D('total - previous_month')} AS change, {pct('total - previous_month', 'previous_month')} AS pct_change,
              {pct('total - same_month_last_year', 'same_month_last_year')} AS pct_change_last_year"""
add("v17_monthly_metrics", lambda c: views.monthly_metrics(c.star, digits=6), f"{METRICS} FROM metrics")


def calendar_sql(source: str, keys: str, months: str = "") -> str:
    """Calendar offsets by self-joins, where the DataFrame uses range frames."""
    on = " AND ".join(f"{{0}}.{k} IS NOT DISTINCT FROM e.{k}" for k in keys.split(", "))
    third = " AND ".join(f"x.{k} IS NOT DISTINCT FROM e.{k}" for k in keys.split(", "))
    return f"""(SELECT e.*, p.total AS previous_month, l.total AS same_month_last_year,
        (SELECT AVG(CAST(x.total AS DOUBLE)) FROM {source} x WHERE {third} AND x.ref_month <= e.ref_month AND x.ref_month >= e.ref_month - INTERVAL 2 MONTH) AS moving_mean_3
        FROM {source} e LEFT JOIN {source} p ON {on.format('p')} AND p.ref_month = e.ref_month - INTERVAL 1 MONTH
        LEFT JOIN {source} l ON {on.format('l')} AND l.ref_month = e.ref_month - INTERVAL 12 MONTH)"""


add(
    "v17_monthly_metrics_calendar",
    lambda c: views.monthly_metrics(c.star, calendar=True, digits=6),
    f"{METRICS} FROM {calendar_sql('series', 'indicator')}",
)
add("v18_comparable_cutoff", lambda c: views.comparable_cutoff(c.star), "SELECT cutoff_month FROM cutoff")
COMPARABLE = f"""SELECT {LABELS}, year, (SELECT cutoff_month FROM cutoff) AS months_included, BOOL_OR(is_partial_year) AS is_partial_year, SUM(total) AS comparable_total
                 FROM series WHERE month <= (SELECT cutoff_month FROM cutoff) GROUP BY indicator, family, unit, year"""
add("v19_comparable_years", lambda c: views.comparable_years(c.star), f"SELECT * REPLACE ({D('comparable_total')} AS comparable_total) FROM ({COMPARABLE})")
DEVIATIONS = f"""SELECT {LABELS}, ref_month, year, month, is_partial_year, {D('total')} AS total, {r6('historical_mean')} AS historical_mean,
                 {r6('historical_deviation')} AS historical_deviation, z_score FROM deviations"""
add("v20_deviation_from_history", lambda c: views.deviation_from_history(c.star, digits=6), DEVIATIONS)


def ranked(columns: str, source: str, partition: str = "indicator, year", where: str = "") -> str:
    return f"""SELECT {columns}, {D('total')} AS total, RANK() OVER (PARTITION BY {partition} ORDER BY total DESC) AS "rank" FROM ({source}) {where}"""


STATE_RANKS = ranked(f"{LABELS}, year, is_partial_year, state, region", STATE_TOTALS)
PLACE_RANKS = ranked(f"{LABELS}, year, is_partial_year, state, municipality", PLACE_TOTALS, where="WHERE total > 0")
GROUP_RANKS = ranked(f"semantic_group, family, unit, year, indicator", INDICATOR_YEAR, "semantic_group, year")
add("v21_state_ranking", lambda c: views.state_ranking(c.star), STATE_RANKS)
add("v22_municipality_ranking", lambda c: views.municipality_ranking(c.star), PLACE_RANKS)
REGION_TOTALS = f"SELECT {LABELS}, year, is_partial_year, region, SUM(total) AS total FROM ({STATE_TOTALS}) GROUP BY ALL"
add("v23a_region_ranking", lambda c: views.region_ranking(c.star), ranked(f"{LABELS}, year, is_partial_year, region", REGION_TOTALS))
add("v23b_indicator_ranking", lambda c: views.indicator_ranking(c.star), GROUP_RANKS)
add("v23c_jurisdiction_ranking", lambda c: views.jurisdiction_ranking(c.star), ranked(f"{LABELS}, year, jurisdiction", JURISDICTIONS))
add(
    "v23d_state_share",
    lambda c: views.state_share(c.star, digits=6),
    f"""SELECT {LABELS}, year, is_partial_year, state, region, {D('total')} AS total,
        {pct('total', 'SUM(total) OVER (PARTITION BY indicator, year)')} AS pct_of_nation FROM ({STATE_TOTALS})""",
)
add(
    "v24_weight_percentiles",
    lambda c: views.weight_percentiles(c.star),
    f"""SELECT indicator, year, unit, COUNT(*) AS row_count, {TOTAL} AS total, {MEAN} AS mean, {q(0.5)} AS median, {q(0.9)} AS p90,
        {q(0.95)} AS p95, {q(0.99)} AS p99, {D('MAX(value)')} AS maximum FROM labelled WHERE family = 'weight' GROUP BY indicator, year, unit""",
)


def outlier_sql(keys: str) -> str:
    """From ranked weights: position 0.99 (n - 1) lies between two rows of the group, the limit between their values."""
    group = f"PARTITION BY {keys}" if keys else ""
    shown = f"{keys}, " if keys else ""
    by = f"GROUP BY {keys}" if keys else ""
    return f"""WITH ordered AS (
          SELECT {shown}value, CAST(value AS DOUBLE) AS v, ROW_NUMBER() OVER ({group} ORDER BY value) - 1 AS place,
                 0.99::DOUBLE * (COUNT(*) OVER ({group}) - 1) AS point FROM labelled WHERE family = 'weight'),
        limited AS (
          SELECT *, MAX(CASE WHEN place = FLOOR(point) THEN v END) OVER ({group}) AS low,
                 MAX(CASE WHEN place = CEIL(point) THEN v END) OVER ({group}) AS high FROM ordered),
        marked AS (SELECT *, v > low + (point - FLOOR(point)) * (high - low) AS extreme FROM limited)
        SELECT {shown}COUNT(*) AS row_count, CAST(COUNT_IF(extreme) AS BIGINT) AS rows_above_p99, SUM(value) AS s_all, SUM(CASE WHEN extreme THEN 0 ELSE value END) AS s_low,
               CAST(SUM(value) AS DOUBLE) / COUNT(*) AS m_all, CAST(SUM(CASE WHEN extreme THEN 0 ELSE value END) AS DOUBLE) / COUNT_IF(NOT extreme) AS m_low
        FROM marked {by}"""


add(
    "v25_outlier_impact",
    lambda c: views.outlier_impact(c.star, digits=6),
    f"""SELECT indicator, row_count, rows_above_p99, {r6('m_all')} AS mean_with_outliers, {r6('m_low')} AS mean_without_top,
        {D('s_all')} AS sum_with_outliers, {D('s_low')} AS sum_without_top, {r6('100 * (m_all - m_low) / NULLIF(m_low, 0)')} AS pct_impact
        FROM ({outlier_sql('indicator')})""",
)
add("v26_dim_indicator", lambda c: with_fact_rows(c, views.indicator_labels(c.star), "indicator"), used_sql("indicator"))
add("v27_quality_not_reported", lambda c: views.VIEWS["quality_not_reported"](c.star), MISSING.replace(", 6)", ", 2)"))
SUMMARY = """SELECT staged.staging_rows, facts.fact_rows, kinds.indicators, where_.states, where_.municipality_names, where_.places,
    calendar.first_month, calendar.last_month, calendar.months_in_partial_years, calendar.partial_years, gaps.mean_pct_missing
  FROM (SELECT COUNT(*) AS staging_rows FROM staging) AS staged
  CROSS JOIN (SELECT COUNT(*) AS fact_rows FROM long) AS facts
  CROSS JOIN (SELECT COUNT(*) AS indicators FROM dim_indicator) AS kinds
  CROSS JOIN (SELECT COUNT(*) AS places, COUNT(DISTINCT municipality) AS municipality_names, COUNT(DISTINCT state) AS states FROM dim_place) AS where_
  CROSS JOIN (SELECT MIN(ref_month) AS first_month, MAX(ref_month) AS last_month, CAST(COUNT_IF(is_partial_year) AS BIGINT) AS months_in_partial_years,
                     COUNT(DISTINCT CASE WHEN is_partial_year THEN year END) AS partial_years FROM dim_time) AS calendar
  CROSS JOIN (SELECT ROUND(SUM(ROUND(missing_cells * 100.0 / applicable_cells, 2)) / COUNT(*), 6) AS mean_pct_missing FROM missing) AS gaps"""
add("v28_quality_summary", lambda c: views.quality_summary(c.star, digits=6), SUMMARY)


def through_view(c: Context) -> DataFrame:
    views.register_views(c.star.spark, c.star, "star_")
    return c.star.spark.sql(
        """SELECT s.indicator, s.year, COUNT(*) AS states, SUM(s.total) AS total, MAX(s.rank) AS last_rank, MIN(y.comparable_total) AS comparable_total
           FROM star_state_ranking s JOIN star_comparable_years y ON y.indicator = s.indicator AND y.year = s.year GROUP BY s.indicator, s.year"""
    )


add(
    "snk6_registered_views",
    through_view,
    f"""SELECT s.indicator, s.year, COUNT(*) AS states, {D('SUM(s.total)')} AS total, MAX(s.place) AS last_rank, MIN({D('y.comparable_total')}) AS comparable_total
        FROM (SELECT *, RANK() OVER (PARTITION BY indicator, year ORDER BY total DESC) AS place FROM ({STATE_TOTALS})) s
        JOIN ({COMPARABLE}) y ON y.indicator = s.indicator AND y.year = s.year GROUP BY s.indicator, s.year""",
)

# Each published view and the entry that states its rows in SQL.
PUBLISHED = {
    "dim_indicator": "v26_dim_indicator", "year_flags": "v05_year_flags", "fact_enriched": "v01_fact_enriched",
    "agg_indicator_year": "v02_agg_indicator_year", "agg_indicator_place_year": "v03_agg_indicator_place_year",
    "agg_indicator_jurisdiction_year": "v04_agg_indicator_jurisdiction_year", "agg_indicator_month": "v15_agg_indicator_month",
    "national": "v06_national", "by_state": "v07_by_state", "by_municipality": "v08_by_municipality", "by_indicator": "v09_by_indicator",
    "by_jurisdiction": "v10_by_jurisdiction", "by_sex": "v11_by_sex", "by_age_band": "v12_by_age_band", "by_agent": "v13_by_agent",
    "by_weapon": "v14_by_weapon", "monthly_series": "v16_monthly_series", "monthly_metrics": "v17_monthly_metrics",
    "comparable_cutoff": "v18_comparable_cutoff", "comparable_years": "v19_comparable_years",
    "deviation_from_history": "v20_deviation_from_history", "state_ranking": "v21_state_ranking",
    "municipality_ranking": "v22_municipality_ranking", "region_ranking": "v23a_region_ranking", "indicator_ranking": "v23b_indicator_ranking",
    "jurisdiction_ranking": "v23c_jurisdiction_ranking", "state_share": "v23d_state_share", "weight_percentiles": "v24_weight_percentiles",
    "outlier_impact": "v25_outlier_impact", "quality_not_reported": "v27_quality_not_reported", "quality_summary": "v28_quality_summary",
}


def published_rows(c: Context) -> DataFrame:
    """Row counts of all published views, read by name."""
    database = published(c)
    counts = [f"SELECT '{view}' AS view_name, COUNT(*) AS row_count FROM `{database}`.`{view}`" for view in PUBLISHED]
    return c.star.spark.sql(" UNION ALL ".join(counts))


add(
    "snk6_published_views",
    published_rows,
    " UNION ALL ".join(
        f"SELECT '{view}' AS view_name, COUNT(*) AS row_count FROM ({ENTRIES[name].sql.removeprefix(BASE)})" for view, name in PUBLISHED.items()
    ),
)
for view, name in (("state_ranking", "v21_state_ranking"), ("national", "v06_national"), ("weight_percentiles", "v24_weight_percentiles")):
    add(
        f"snk6_published_{view}",
        lambda c, view=view: c.star.spark.table(f"`{published(c)}`.`{view}`"),
        ENTRIES[name].sql.removeprefix(BASE),
    )

# --- read queries ------------------------------------------------------------

INDICATOR, STATE, YEAR = 3, "NATION_3", 1998
ONE = f"indicator_id = {INDICATOR}"
add(
    "q01_indicators",
    lambda c: with_fact_rows(c, queries.list_indicators(c.star), "indicator"),
    used_sql("indicator", "d.*, (SELECT COUNT(*) FROM dim_indicator) AS total"),
)
add("q02_indicator", lambda c: with_fact_rows(c, queries.get_indicator(c.star, INDICATOR), "indicator"), f"{used_sql('indicator')} WHERE d.{ONE}")
KPI = f"SELECT indicator_id, indicator, family, unit, {TOTAL} AS value, COUNT(*) AS row_count FROM labelled"
KPI_GROUP = "GROUP BY indicator_id, indicator, family, unit"
add("q03_kpis", lambda c: queries.kpis(c.star), f"{KPI} {KPI_GROUP}")
add(
    "q03_kpis_filtered",
    lambda c: queries.kpis(c.star, state=STATE, year=YEAR, jurisdiction="O"),
    f"{KPI} WHERE state = '{STATE}' AND year = {YEAR} AND jurisdiction = 'O' {KPI_GROUP}",
)
TEMPORAL = f"SELECT MIN(indicator) AS indicator, MIN(unit) AS unit, year, month, {TOTAL} AS value, BOOL_OR(is_partial_year) AS is_partial_year FROM labelled WHERE {ONE}"
add("q04_temporal", lambda c: queries.temporal(c.star, INDICATOR), f"{TEMPORAL} GROUP BY year, month")
add(
    "q04_temporal_filtered",
    lambda c: queries.temporal(c.star, INDICATOR, state=STATE, jurisdiction="F", year_from=1997, year_to=2000),
    f"{TEMPORAL} AND state = '{STATE}' AND jurisdiction = 'F' AND year BETWEEN 1997 AND 2000 GROUP BY year, month",
)


def yoy_sql(base: str, other: str) -> str:
    return f"""SELECT CAST({INDICATOR} AS BIGINT) AS indicator_id, b.indicator, b.unit, b.year AS base_year, o.year AS comparison_year,
        {D('b.comparable_total')} AS base_value, {D('o.comparable_total')} AS comparison_value, {D('o.comparable_total - b.comparable_total')} AS change,
        {r6('CAST(o.comparable_total - b.comparable_total AS DOUBLE) / NULLIF(CAST(b.comparable_total AS DOUBLE), 0) * 100')} AS pct_change,
        o.months_included AS months_compared, b.is_partial_year OR o.is_partial_year AS partial_period
        FROM ({COMPARABLE}) b JOIN ({COMPARABLE}) o ON o.indicator = b.indicator
        WHERE b.indicator = (SELECT indicator FROM dim_indicator WHERE {ONE}) AND b.year = {base} AND o.year = {other}"""


LAST_YEAR = f"(SELECT MAX(year) FROM labelled WHERE {ONE})"
add("q05_year_over_year", lambda c: queries.year_over_year(c.star, INDICATOR, digits=6), yoy_sql(f"{LAST_YEAR} - 1", LAST_YEAR))
add("q05_year_over_year_given", lambda c: queries.year_over_year(c.star, INDICATOR, 1996, 1999, digits=6), yoy_sql("1996", "1999"))
BY_STATE = f"SELECT MIN(indicator) AS indicator, MIN(unit) AS unit, state, region, {TOTAL} AS value FROM labelled WHERE {ONE}"
add("q06_by_state", lambda c: queries.by_state(c.star, INDICATOR), f"{BY_STATE} GROUP BY state, region")
add(
    "q06_by_state_filtered",
    lambda c: queries.by_state(c.star, INDICATOR, year=YEAR, month=3, region="ASIA", jurisdiction="O"),
    f"{BY_STATE} AND year = {YEAR} AND month = 3 AND region = 'ASIA' AND jurisdiction = 'O' GROUP BY state, region",
)
BY_PLACE = f"SELECT MIN(indicator) AS indicator, MIN(unit) AS unit, state, municipality, {TOTAL} AS value FROM labelled WHERE {ONE}"
add(
    "q07_by_municipality_page",
    lambda c: queries.by_municipality(c.star, INDICATOR, page=2).rows,
    f"{BY_PLACE} GROUP BY state, municipality ORDER BY value DESC, municipality, state LIMIT 50 OFFSET 50",
)
add(
    "q07_by_municipality_deep_page",
    lambda c: queries.by_municipality(c.star, INDICATOR, page=300, page_size=4).rows,
    f"{BY_PLACE} GROUP BY state, municipality ORDER BY value DESC, municipality, state LIMIT 4 OFFSET 1196",
)
add(
    "q07_by_municipality_of_state_and_year",
    lambda c: queries.by_municipality(c.star, INDICATOR, state=STATE, year=YEAR, page=2, page_size=5).rows,
    f"{BY_PLACE} AND state = '{STATE}' AND year = {YEAR} GROUP BY state, municipality ORDER BY value DESC, municipality, state LIMIT 5 OFFSET 5",
)
add(
    "q07_stored_order",
    lambda c: c.star.place_order,
    f"""SELECT indicator_id, year, ROW_NUMBER() OVER (g ORDER BY total DESC, municipality, state) AS position,
               ROW_NUMBER() OVER (PARTITION BY indicator_id, year, state ORDER BY total DESC, municipality) AS state_position,
               RANK() OVER (g ORDER BY total DESC) AS "rank", place_id, state, municipality, {D('total')} AS total
        FROM (SELECT indicator_id, source_year AS year, place_id, state, municipality, SUM(value) AS total FROM labelled GROUP BY ALL
              UNION ALL SELECT indicator_id, NULL, place_id, state, municipality, SUM(value) FROM labelled GROUP BY ALL)
        WINDOW g AS (PARTITION BY indicator_id, year)""",
)
add(
    "q07_by_municipality_total",
    lambda c: queries.by_municipality(c.star, INDICATOR, state=STATE, year=YEAR).total,
    f"SELECT COUNT(*) AS total FROM ({BY_PLACE} AND state = '{STATE}' AND year = {YEAR} GROUP BY state, municipality)",
)


def top_sql(source: str, columns: str, where: str, order: str, limit: int = 10) -> str:
    return f"""SELECT "rank", {columns}, total AS value FROM ({source}) WHERE {where} ORDER BY "rank", {order} LIMIT {limit}"""


THIS = f"indicator = (SELECT indicator FROM dim_indicator WHERE {ONE}) AND year = {YEAR}"
add("q08_ranking_states", lambda c: queries.ranking_of_states(c.star, INDICATOR, YEAR), top_sql(STATE_RANKS, "indicator, unit, state, region", THIS, "state, region"))
add(
    "q09_ranking_municipalities",
    lambda c: queries.ranking_of_municipalities(c.star, INDICATOR, YEAR),
    top_sql(PLACE_RANKS, "indicator, unit, state, municipality", THIS, "state, municipality"),
)
add(
    "q10_ranking_indicators",
    lambda c: queries.ranking_of_indicators(c.star, "Lines", YEAR),
    top_sql(GROUP_RANKS, "indicator, semantic_group", f"semantic_group = 'Lines' AND year = {YEAR}", "indicator"),
)
RADAR = f"""SELECT indicator, year, month, {D('total')} AS value, {r6('historical_mean')} AS historical_mean,
            {r6('historical_deviation')} AS historical_deviation, z_score FROM deviations"""
RADAR_ORDER = "ORDER BY ABS(z_score) DESC NULLS LAST, indicator, year, month LIMIT"
add("q11_radar", lambda c: queries.radar(c.star, digits=6), f"{RADAR} {RADAR_ORDER} 50")
add(
    "q11_radar_filtered",
    lambda c: queries.radar(c.star, INDICATOR, 1999, 0.5, 930, digits=6),
    f"{RADAR} WHERE {THIS.replace(str(YEAR), '1999')} AND ABS(z_score) >= 0.5 {RADAR_ORDER} 930",
)
add(
    "q12_overview",
    lambda c: queries.overview(c.star),
    f"""SELECT strftime(first_month, '%Y-%m') AS first_month, strftime(last_month, '%Y-%m') AS last_month, partial_years > 0 AS has_partial_year,
        indicators, states, municipality_names AS municipalities FROM ({SUMMARY})""",
)
add("q13_states", lambda c: queries.list_states(c.star), "SELECT DISTINCT state, region FROM dim_place")
add("q14_years", lambda c: queries.list_years(c.star), "SELECT DISTINCT year FROM dim_time")
add("q15_jurisdictions", lambda c: queries.list_jurisdictions(c.star), "SELECT jurisdiction FROM dim_jurisdiction")
add("q16_municipalities", lambda c: queries.list_municipalities(c.star), "SELECT state, municipality FROM dim_place")
add(
    "q16_municipalities_of_state",
    lambda c: queries.list_municipalities(c.star, STATE),
    f"SELECT state, municipality FROM dim_place WHERE state = '{STATE}'",
)

# --- measures ----------------------------------------------------------------


def core(columns: str, by: tuple[str, ...], where: measures.Filters = None, units_from: str = "fact") -> Callable[[Context], DataFrame]:
    return lambda c: measures.core(c.star, by, where, units_from).select(*by, *columns.split(", "))


SAFE = f"CASE WHEN COUNT(DISTINCT unit) <= 1 THEN {TOTAL} END AS safe_total"
add(
    "m01_totals_and_units",
    core("total_value, row_count, distinct_units", ("state", "year")),
    f"SELECT state, year, {TOTAL} AS total_value, COUNT(*) AS row_count, COUNT(DISTINCT unit) AS distinct_units FROM labelled GROUP BY state, year",
)
add(
    "m04_safe_total",
    lambda c: core("distinct_units, safe_total", ("semantic_group", "year"))(c).unionByName(
        core("distinct_units, safe_total", ())(c).select(
            F.lit(None).cast("string").alias("semantic_group"), F.lit(None).cast("int").alias("year"), "distinct_units", "safe_total"
        )
    ),
    f"""SELECT semantic_group, year, COUNT(DISTINCT unit) AS distinct_units, {SAFE} FROM labelled GROUP BY semantic_group, year
        UNION ALL SELECT NULL, NULL, COUNT(DISTINCT unit), CASE WHEN COUNT(DISTINCT unit) <= 1 THEN {TOTAL} END FROM labelled""",
)
add(
    "m05_family_totals",
    core("victim_total, count_total, weight_total", ("region", "year")),
    "SELECT region, year, " + ", ".join(f"CAST(SUM(value) FILTER (WHERE family = '{f}') AS DOUBLE) AS {f}_total" for f in ("victim", "count", "weight"))
    + " FROM labelled GROUP BY region, year",
)
add(
    "m08_selected_labels",
    core("selected_indicator, selected_unit", ("semantic_group",)),
    """SELECT semantic_group, CASE WHEN COUNT(DISTINCT indicator) = 1 THEN MIN(indicator) ELSE 'Vários indicadores' END AS selected_indicator,
       CASE WHEN COUNT(DISTINCT unit) = 1 THEN MIN(unit) ELSE 'unidades mistas — não somar' END AS selected_unit FROM labelled GROUP BY semantic_group""",
)
# The other reading: units of the indicators that filters on indicators leave, wherever the fact has rows.
IN_DIMENSION = "distinct_units, safe_total, selected_indicator, selected_unit"


def dimension_sql(keys: str, where: str, indicator_keys: str, indicator_where: str = "TRUE") -> str:
    met = " AND ".join(f"d.{k} IS NOT DISTINCT FROM f.{k}" for k in indicator_keys.split(", ")) if indicator_keys else "TRUE"
    grouped = f"GROUP BY {indicator_keys}" if indicator_keys else ""
    shown = f"{indicator_keys}, " if indicator_keys else ""
    return f"""SELECT {', '.join(f'f.{k}' for k in keys.split(', '))}, f.total_value, f.row_count, d.units AS distinct_units, CASE WHEN d.units <= 1 THEN f.total_value END AS safe_total,
          CASE WHEN d.indicators = 1 THEN d.one ELSE 'Vários indicadores' END AS selected_indicator,
          CASE WHEN d.units = 1 THEN d.unit ELSE 'unidades mistas — não somar' END AS selected_unit
        FROM (SELECT {keys}, {TOTAL} AS total_value, COUNT(*) AS row_count FROM labelled WHERE {where} GROUP BY {keys}) f
        JOIN (SELECT {shown}COUNT(DISTINCT unit) AS units, COUNT(DISTINCT indicator) AS indicators, MIN(indicator) AS one, MIN(unit) AS unit
              FROM dim_indicator WHERE {indicator_where} {grouped}) d ON {met}"""


add(
    "m03_units_of_the_dimension_by_place",
    core(f"total_value, row_count, {IN_DIMENSION}", ("state", "year"), {"region": "ASIA", "jurisdiction": "O"}, "dimension"),
    dimension_sql("state, year", "region = 'ASIA' AND jurisdiction = 'O'", ""),
)
add(
    "m03_units_of_the_dimension_by_group",
    core(f"total_value, row_count, {IN_DIMENSION}", ("semantic_group", "state"), {"family": ["victim", "weight"], "year": 1998}, "dimension"),
    dimension_sql("semantic_group, state", "family IN ('victim', 'weight') AND year = 1998", "semantic_group", "family IN ('victim', 'weight')"),
)
add(
    "m03_units_of_one_indicator",
    core(f"total_value, row_count, {IN_DIMENSION}", ("state",), {"indicator": "LINE PROMO"}, "dimension"),
    dimension_sql("state", "indicator = 'LINE PROMO'", "", "indicator = 'LINE PROMO'"),
)
STATE_MONTHS = "(SELECT indicator, state, ref_month, SUM(value) AS total FROM labelled GROUP BY ALL)"
add(
    "m10_calendar_metrics",
    lambda c: measures.calendar_metrics(c.star, ["indicator", "state"]),
    f"""SELECT indicator, state, ref_month, {D('total')} AS total, {D('previous_month')} AS previous_month, {D('total - previous_month')} AS change,
        {rat('total - previous_month', 'previous_month')} AS ratio_change, {D('same_month_last_year')} AS same_month_last_year,
        {rat('total - same_month_last_year', 'same_month_last_year')} AS ratio_change_last_year, {r6('moving_mean_3')} AS moving_mean_3
        FROM {calendar_sql(STATE_MONTHS, 'indicator, state')}""",
)
add(
    "m10_calendar_metrics_of_a_year",
    lambda c: measures.calendar_metrics(c.star, ["indicator", "state", "year"], {"year": 1998}),
    f"""SELECT indicator, state, year(ref_month) AS year, ref_month, {D('total')} AS total, {D('previous_month')} AS previous_month, {D('total - previous_month')} AS change,
        {rat('total - previous_month', 'previous_month')} AS ratio_change, {D('same_month_last_year')} AS same_month_last_year,
        {rat('total - same_month_last_year', 'same_month_last_year')} AS ratio_change_last_year, {r6('moving_mean_3')} AS moving_mean_3
        FROM {calendar_sql(STATE_MONTHS, 'indicator, state')} WHERE year(ref_month) = 1998""",
)
add(
    "m16_comparable_total",
    lambda c: measures.comparable_total(c.star, ["indicator", "state", "year"]),
    f"""SELECT indicator, state, year, (SELECT cutoff_month FROM cutoff) AS cutoff_month, {TOTAL} AS comparable_total
        FROM labelled WHERE month <= (SELECT cutoff_month FROM cutoff) GROUP BY indicator, state, year""",
)
add(
    "m18_year_labels",
    lambda c: measures.year_labels(c.star),
    """SELECT year, CASE WHEN is_partial_year THEN 'DADOS PARCIAIS — JAN a ' || strftime(MAX(ref_month), '%b') || '/' || CAST(year AS VARCHAR)
              ELSE CAST(year AS VARCHAR) END AS label FROM dim_time GROUP BY year, is_partial_year
       UNION ALL SELECT NULL, 'Vários anos' FROM (SELECT COUNT(DISTINCT year) AS n FROM dim_time) WHERE n > 1""",
)


def dense_sql(item: str, within: str) -> str:
    return f"""SELECT {within}, {item}, {D('total')} AS total, DENSE_RANK() OVER (PARTITION BY {within} ORDER BY total DESC) AS "rank"
               FROM (SELECT {within}, {item}, SUM(value) AS total FROM labelled GROUP BY ALL)"""


for number, item in ((19, "state"), (20, "municipality"), (21, "region"), (23, "jurisdiction")):
    add(
        f"m{number}_dense_rank_{item}",
        lambda c, item=item: measures.dense_ranking(c.star, item, ["indicator", "year"]),
        dense_sql(item, "indicator, year"),
    )
add(
    "m22_dense_rank_indicator",
    lambda c: measures.dense_ranking(c.star, "indicator", ["semantic_group", "unit", "year"]),
    dense_sql("indicator", "semantic_group, unit, year"),
)


def share_sql(parent: str, item: str, where: str = "TRUE") -> str:
    return f"""SELECT {parent}, {item}, {D('total')} AS total, {D(f'SUM(total) OVER (PARTITION BY {parent})')} AS parent_total,
               {rat('total', f'SUM(total) OVER (PARTITION BY {parent})')} AS share
               FROM (SELECT {parent}, {item}, SUM(value) AS total FROM labelled WHERE {where} GROUP BY ALL)"""


add("m24_share_state", lambda c: measures.share(c.star, "state", ["indicator", "year"]), share_sql("indicator, year", "state"))
add(
    "m25_share_municipality",
    lambda c: measures.share(c.star, "municipality", ["indicator", "state"]),
    share_sql("indicator, state", "municipality"),
)
add("m26_share_indicator", lambda c: measures.indicator_share_of_family(c.star, ["year"]), share_sql("year, family", "indicator"))
add(
    "m27_share_sex",
    lambda c: measures.share(c.star, "sex", ["indicator"], {"family": "victim"}),
    share_sql("indicator", "sex", "family = 'victim'"),
)
WEIGHTS = f"{q(0.5)} AS median, {q(0.9)} AS p90, {q(0.95)} AS p95, {q(0.99)} AS p99, {D('MAX(value)')} AS maximum FROM labelled WHERE family = 'weight'"
add("m28_weight_statistics", lambda c: measures.weight_statistics(c.star), f"SELECT {WEIGHTS}")
add("m28_weight_statistics_by_state", lambda c: measures.weight_statistics(c.star, ["indicator", "state"]), f"SELECT indicator, state, {WEIGHTS} GROUP BY indicator, state")
OUTLIERS = f"{r6('m_all')} AS mean_with_outliers, {r6('m_low')} AS mean_without_top, {r6('(m_all - m_low) / NULLIF(m_low, 0)')} AS ratio_impact"
add("m33_weight_outliers", lambda c: measures.weight_outliers(c.star, []), f"SELECT {OUTLIERS} FROM ({outlier_sql('')})")
add(
    "m33_weight_outliers_by_region",
    lambda c: measures.weight_outliers(c.star, ["indicator", "region"]),
    f"SELECT indicator, region, {OUTLIERS} FROM ({outlier_sql('indicator, region')})",
)
HISTORY = (
    f"""SELECT e.indicator, e.region, ref_month, {D('total')} AS total, {r6('m')} AS historical_mean, {r6('s')} AS historical_deviation,
        {r6('(CAST(total AS DOUBLE) - m) / NULLIF(s, 0)')} AS z_score
        FROM (SELECT indicator, region, ref_month, SUM(value) AS total FROM labelled GROUP BY ALL) e
        JOIN (SELECT indicator, region, CAST(SUM(total) AS DOUBLE) / COUNT(*) AS m, STDDEV_POP(CAST(total AS DOUBLE)) AS s
              FROM (SELECT indicator, region, ref_month, SUM(value) AS total FROM labelled GROUP BY ALL) GROUP BY indicator, region) h
        ON h.indicator = e.indicator AND h.region = e.region"""
)
add("m36_history", lambda c: measures.history(c.star, ["indicator", "region"]), HISTORY)
add(
    "m36_history_of_a_year",
    lambda c: measures.history(c.star, ["indicator", "region", "year"], {"year": [1997, 1998]}),
    f"SELECT *, year(ref_month) AS year FROM ({HISTORY}) WHERE year(ref_month) IN (1997, 1998)",
)
add(
    "m39_quality_totals",
    lambda c: measures.quality_totals(c.star),
    f"SELECT staging_rows, fact_rows, indicators, states, municipality_names AS municipalities, months_in_partial_years FROM ({SUMMARY})",
)
add(
    "m45_not_reported_ratio",
    lambda c: measures.not_reported_ratio(c.star, ["family"]),
    f"SELECT family, {rat('SUM(missing_cells)', 'SUM(applicable_cells)')} AS ratio_missing FROM missing GROUP BY family",
)
add(
    "m46_quality_status",
    lambda c: measures.quality_status(c.star),
    """SELECT indicator, ratio_missing, CASE WHEN ratio_missing IS NULL THEN 'Sem dados' WHEN ratio_missing <= 0.10 THEN 'Bom'
              WHEN ratio_missing <= 0.25 THEN 'Atenção' ELSE 'Sério' END AS status
       FROM (SELECT i.indicator, ROUND(CAST(missing_cells AS DOUBLE) / NULLIF(applicable_cells, 0), 6) AS ratio_missing
             FROM dim_indicator i LEFT JOIN missing m ON m.indicator = i.indicator)""",
)
add(
    "p1_group_totals",
    lambda c: measures.group_totals(c.star),
    f"SELECT semantic_group, unit, {TOTAL} AS total FROM labelled GROUP BY semantic_group, unit",
)
add(
    "p2_group_distribution",
    lambda c: measures.group_distribution(c.star),
    "SELECT semantic_group, COUNT(DISTINCT indicator) AS indicators, COUNT(*) AS row_count FROM labelled GROUP BY semantic_group",
)
add(
    "p3_top_states",
    lambda c: measures.top_states(c.star, "LINE PROMO"),
    f"SELECT state, {TOTAL} AS total FROM labelled WHERE indicator = 'LINE PROMO' GROUP BY state ORDER BY total DESC, state LIMIT 5",
)
add(
    "p4_group_series",
    lambda c: measures.group_series(c.star),
    f"SELECT semantic_group, unit, ref_month, {TOTAL} AS total FROM labelled GROUP BY semantic_group, unit, ref_month",
)
add("p5_large_deviations", lambda c: measures.largest_deviations(c.star, 2.0, digits=6), f"SELECT * FROM ({DEVIATIONS}) WHERE ABS(z_score) > 2")
add(
    "p5_largest_deviation",
    lambda c: measures.largest_deviations(c.star, 2.0, 1, digits=6),
    f"SELECT * FROM ({DEVIATIONS}) WHERE ABS(z_score) > 2 ORDER BY ABS(z_score) DESC, indicator, ref_month LIMIT 1",
)
for name, falling, order in (("p6_top_growths", False, "DESC"), ("p6_top_falls", True, "ASC")):
    add(
        name,
        lambda c, falling=falling: measures.strongest_changes(c.star, falling, digits=6),
        f"""SELECT indicator, ref_month, total, same_month_last_year, pct_change_last_year FROM ({METRICS} FROM metrics)
            ORDER BY pct_change_last_year {order} NULLS LAST, indicator, ref_month LIMIT 5""",
    )
for level, columns in measures.LEVELS.items():
    keys = ", ".join(["indicator", *columns])
    add(
        f"p7_drill_{level}",
        lambda c, level=level: measures.drill_down(c.star, level),
        f"SELECT {keys}, {TOTAL} AS total, COUNT(*) AS row_count FROM labelled GROUP BY {keys}",
    )


def queries_by_name() -> dict[str, Callable]:
    def bound(entry: Entry) -> Callable:
        return lambda spark, sf_dir: plain(entry.frame(context(spark, sf_dir)))

    return {name: bound(entry) for name, entry in ENTRIES.items()}


def sql_by_name() -> dict[str, str]:
    return {name: entry.sql for name, entry in ENTRIES.items() if entry.sql is not None}
