"""The views as SQL over the stored tables: what the catalog keeps, for sessions that know nothing of this package.

`@name` stands for a relation of the same database. Percentiles, numberings and other results that need
more than one pass are stored by the run; the rest is joins, sums and windows over bounded groups. Every view has the
columns and rows of the function of the same name in `views`.
"""

from __future__ import annotations

LABELS = "indicator, family, unit"
LABELLED = "JOIN @dim_indicator USING (indicator_id) JOIN @year_flags USING (year)"


def _percent(top: str, bottom: str, digits: int = 2) -> str:
    return f"ROUND(100 * TRY_DIVIDE(DOUBLE({top}), DOUBLE({bottom})), {digits}) + 0.0D"


def _by_class(name: str, shown: str) -> str:
    return f"""SELECT {shown}, {name}, total FROM (
        SELECT indicator_id, {name}_id, source_year AS year, SUM(value) AS total FROM @exact_fact WHERE {name}_id IS NOT NULL GROUP BY ALL)
      JOIN @dim_{name} USING ({name}_id) JOIN @dim_indicator USING (indicator_id)"""


def _rank(source: str, columns: str, partition: str = "indicator, year") -> str:
    return f"SELECT {columns}, total, CAST(RANK() OVER (PARTITION BY {partition} ORDER BY total DESC) AS BIGINT) AS rank FROM {source}"


# In the order of their dependencies.
VIEW_SQL: dict[str, str] = {
    "dim_indicator": "SELECT * FROM @labels",
    "year_flags": "SELECT DISTINCT year, is_partial_year FROM @dim_time",
    "fact_enriched": """SELECT * FROM @exact_fact JOIN @dim_time USING (time_id) JOIN @dim_place USING (place_id)
        JOIN @dim_jurisdiction USING (jurisdiction_id) JOIN @dim_indicator USING (indicator_id) LEFT JOIN @dim_agent USING (agent_id)
        LEFT JOIN @dim_weapon USING (weapon_id) LEFT JOIN @dim_age_band USING (age_band_id) LEFT JOIN @dim_sex USING (sex_id)""",
    "agg_indicator_year": "SELECT * FROM @indicator_year",
    "agg_indicator_place_year": "SELECT indicator_id, place_id, year, total FROM @place_year",
    "agg_indicator_jurisdiction_year": """SELECT indicator_id, jurisdiction_id, source_year AS year, SUM(value) AS total, COUNT(*) AS row_count
        FROM @exact_fact GROUP BY ALL""",
    "agg_indicator_month": "SELECT indicator_id, time_id, total FROM @indicator_month",
    "national": f"""SELECT {LABELS}, kind, semantic_group, year, is_partial_year, row_count, total, mean, median, minimum, maximum, deviation
        FROM @indicator_year {LABELLED}""",
    "by_state": f"""SELECT {LABELS}, semantic_group, state, region, year, is_partial_year, total, TRY_DIVIDE(DOUBLE(total), DOUBLE(places)) AS mean
        FROM (SELECT indicator_id, state, region, year, SUM(total) AS total, COUNT(*) AS places
              FROM @place_year JOIN @dim_place USING (place_id) GROUP BY indicator_id, state, region, year) {LABELLED}""",
    "by_municipality": f"""SELECT {LABELS}, semantic_group, state, municipality, year, is_partial_year, total
        FROM @place_year {LABELLED} JOIN @dim_place USING (place_id)""",
    "by_indicator": f"""SELECT {LABELS}, kind, semantic_group, year, total, mean, median, SUM(total) OVER family_year AS family_year_total,
          {_percent('total', 'SUM(total) OVER family_year')} AS pct_of_family
        FROM @national WINDOW family_year AS (PARTITION BY family, year)""",
    "by_jurisdiction": f"""SELECT {LABELS}, jurisdiction, year, total, row_count FROM @agg_indicator_jurisdiction_year
        JOIN @dim_indicator USING (indicator_id) JOIN @dim_jurisdiction USING (jurisdiction_id)""",
    "by_sex": f"""SELECT *, {_percent('total', 'SUM(total) OVER (PARTITION BY indicator, year)')} AS pct
        FROM ({_by_class('sex', 'indicator, kind, year')})""",
    "by_age_band": f"""SELECT *, {_percent('total', 'SUM(total) OVER (PARTITION BY indicator, year)')} AS pct
        FROM ({_by_class('age_band', 'indicator, year')})""",
    "by_agent": _by_class("agent", "indicator, year"),
    "by_weapon": f"""SELECT year, weapon, total, CAST(RANK() OVER (PARTITION BY year ORDER BY total DESC) AS BIGINT) AS rank
        FROM (SELECT year, weapon, SUM(total) AS total FROM ({_by_class('weapon', 'year')}) GROUP BY year, weapon)""",
    "monthly_series": f"""SELECT {LABELS}, semantic_group, ref_month, year, month, quarter, month_name, is_partial_year, total
        FROM @indicator_month JOIN @dim_indicator USING (indicator_id) JOIN @dim_time USING (time_id)""",
    "monthly_metrics": f"""SELECT *, total - previous_month AS change, {_percent('total - previous_month', 'previous_month')} AS pct_change,
          {_percent('total - same_month_last_year', 'same_month_last_year')} AS pct_change_last_year
        FROM (SELECT *, LAG(total, 1) OVER months AS previous_month,
                TRY_DIVIDE(DOUBLE(SUM(total) OVER last_three), DOUBLE(COUNT(total) OVER last_three)) AS moving_mean_3,
                LAG(total, 12) OVER months AS same_month_last_year
              FROM @monthly_series WINDOW months AS (PARTITION BY indicator ORDER BY ref_month),
                last_three AS (PARTITION BY indicator ORDER BY ref_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""",
    "comparable_cutoff": """SELECT COALESCE(MIN(last_month), 12) AS cutoff_month
        FROM (SELECT year, MAX(month) AS last_month FROM @dim_time WHERE is_partial_year GROUP BY year)""",
    "comparable_years": f"""SELECT {LABELS}, year, months_included, BOOL_OR(is_partial_year) AS is_partial_year, SUM(total) AS comparable_total
        FROM (SELECT s.*, (SELECT cutoff_month FROM @comparable_cutoff) AS months_included FROM @monthly_series s)
        WHERE month <= months_included GROUP BY {LABELS}, year, months_included""",
    "deviation_from_history": f"""SELECT {LABELS}, ref_month, year, month, is_partial_year, total, historical_mean, historical_deviation,
          ROUND(TRY_DIVIDE(DOUBLE(total) - historical_mean, historical_deviation), 2) + 0.0D AS z_score
        FROM (SELECT *, TRY_DIVIDE(DOUBLE(SUM(total) OVER whole), DOUBLE(COUNT(total) OVER whole)) AS historical_mean,
                STDDEV_POP(DOUBLE(total)) OVER whole AS historical_deviation
              FROM @monthly_series WINDOW whole AS (PARTITION BY indicator))""",
    "state_ranking": _rank("@by_state", f"{LABELS}, year, is_partial_year, state, region"),
    "municipality_ranking": f"""SELECT {LABELS}, year, is_partial_year, state, municipality, total, rank
        FROM (SELECT * FROM @place_order WHERE year IS NOT NULL AND total > 0) {LABELLED}""",
    "region_ranking": _rank(
        f"(SELECT {LABELS}, year, is_partial_year, region, SUM(total) AS total FROM @by_state GROUP BY {LABELS}, year, is_partial_year, region)",
        f"{LABELS}, year, is_partial_year, region",
    ),
    "indicator_ranking": _rank("@national", "semantic_group, family, unit, year, indicator", "semantic_group, year"),
    "jurisdiction_ranking": _rank("@by_jurisdiction", f"{LABELS}, year, jurisdiction"),
    "state_share": f"""SELECT {LABELS}, year, is_partial_year, state, region, total,
          {_percent('total', 'SUM(total) OVER (PARTITION BY indicator, year)')} AS pct_of_nation FROM @by_state""",
    "weight_percentiles": """SELECT indicator, year, unit, row_count, total, mean, median, p90, p95, p99, maximum
        FROM @weight_year JOIN @dim_indicator USING (indicator_id)""",
    "outlier_impact": """SELECT indicator, row_count, rows_above_p99, mean_with_outliers, mean_without_top, sum_with_outliers, sum_without_top,
          ROUND(100 * TRY_DIVIDE(mean_with_outliers - mean_without_top, mean_without_top), 1) + 0.0D AS pct_impact
        FROM @weight_contrast JOIN @dim_indicator USING (indicator_id)""",
    "quality_not_reported": "SELECT * FROM @missing_cells",
    "quality_summary": """SELECT staging_rows, fact_rows, indicators, states, municipality_names, places, first_month, last_month, months_in_partial_years,
          partial_years, (SELECT ROUND(AVG(pct_missing), 2) + 0.0D FROM @missing_cells) AS mean_pct_missing
        FROM @layer_rows
        CROSS JOIN (SELECT COUNT(DISTINCT indicator) AS indicators FROM @dim_indicator)
        CROSS JOIN (SELECT COUNT(DISTINCT state) AS states, COUNT(DISTINCT municipality) AS municipality_names, COUNT(*) AS places FROM @dim_place)
        CROSS JOIN (SELECT MIN(ref_month) AS first_month, MAX(ref_month) AS last_month, COUNT_IF(is_partial_year) AS months_in_partial_years,
                      COUNT(DISTINCT CASE WHEN is_partial_year THEN year END) AS partial_years FROM @dim_time)""",
}
