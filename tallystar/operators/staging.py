"""Staging: the raw feed, typed, row for row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.errors import ContractError
from tallystar.schema import KEY_STRINGS, MEASURES, RAW_MEASURE_TYPE, STAGING_COLUMNS


def build_staging(raw: DataFrame) -> DataFrame:
    """Trim, cast, prune; measures keep ten decimals, like grain and fact. Raw carries `source_year`; the derived victim total is left behind.

    Casts are strict (ANSI): text that is no number or date fails the job.
    """
    text = {c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in KEY_STRINGS}
    numbers = {c: F.col(c).cast(RAW_MEASURE_TYPE) for c in MEASURES}
    dates = {"ref_month": F.to_date("ref_month"), "source_year": F.col("source_year").cast("int")}
    return raw.withColumns(text | numbers | dates).select(*STAGING_COLUMNS)


def require_same_rows(n_raw: int, n_staging: int) -> None:
    if n_raw != n_staging:
        raise ContractError(f"staging changed the row count: raw {n_raw}, staging {n_staging}")
