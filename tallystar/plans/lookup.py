"""Small facts about a star, read once when it is opened: one row per indicator, month, and indicator and year.

All of it is bounded by the configuration and the calendar, never by the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.schema import MONTHS_PER_FULL_YEAR
from tallystar.storage import together


@dataclass(frozen=True)
class Lookup:
    """Names and units by indicator id, ids by jurisdiction, the first month with rows of each indicator and year, and sizes."""

    indicators: dict[int, tuple[str, str]]
    first_months: dict[int, dict[int, int]]
    jurisdictions: dict[str, int]
    cutoff_month: int
    months: int
    states: int

    def years(self, indicator_id: int) -> list[int]:
        """Years with any row, ascending."""
        return sorted(self.first_months.get(indicator_id, {}))

    def comparable(self, indicator_id: int, year: int) -> bool:
        """Whether the year has a row within the months all years reach."""
        return self.first_months.get(indicator_id, {}).get(year, MONTHS_PER_FULL_YEAR + 1) <= self.cutoff_month


def read_lookup(
    indicators: DataFrame, time: DataFrame, jurisdictions: DataFrame, indicator_month: DataFrame, regions: DataFrame
) -> Lookup:
    spans = (
        indicator_month.join(time.select("time_id", "year", "month"), "time_id")
        .groupBy("indicator_id", "year")
        .agg(F.min("month").alias("first"))
    )
    read = together(
        indicators=lambda: indicators.select("indicator_id", "indicator", "unit").collect(),
        calendar=lambda: time.select("year", "month", "is_partial_year").collect(),
        jurisdictions=lambda: jurisdictions.select("jurisdiction", "jurisdiction_id").collect(),
        spans=spans.collect,
        states=regions.count,
    )
    last_months: dict[int, int] = {}
    for row in read["calendar"]:
        if row.is_partial_year:
            last_months[row.year] = max(row.month, last_months.get(row.year, 0))
    first_months: dict[int, dict[int, int]] = {}
    for row in read["spans"]:
        first_months.setdefault(row.indicator_id, {})[row.year] = row.first
    return Lookup(
        indicators={row.indicator_id: (row.indicator, row.unit) for row in read["indicators"]},
        first_months=first_months,
        jurisdictions={row.jurisdiction: row.jurisdiction_id for row in read["jurisdictions"]},
        cutoff_month=min(last_months.values(), default=MONTHS_PER_FULL_YEAR),
        months=len(read["calendar"]),
        states=read["states"],
    )
