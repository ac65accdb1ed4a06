"""Reading the per-year wide feeds."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from urllib.parse import quote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.schema import RAW_COLUMNS, RAW_SCHEMA, SOURCE_HEADERS

YEAR = "source_year"
# JSON is read by name, as text: published and English names, of which a feed has one or the other.
JSON_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in (*SOURCE_HEADERS, *RAW_COLUMNS)])


def _english(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in SOURCE_HEADERS.items() if old in df.columns})


def require_columns(df: DataFrame, year: int) -> DataFrame:
    """Every raw column has to be there; extra columns are tolerated."""
    missing = sorted(set(RAW_COLUMNS) - set(df.columns))
    if missing:
        raise ValueError(f"the {year} feed lacks the columns {missing}")
    return df


def _reader(spark: SparkSession, file_format: str):
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True).option("inferSchema", False).option("enforceSchema", False)
    return reader.schema(JSON_SCHEMA) if file_format == "json" else reader


def _columns(df: DataFrame, file_format: str) -> DataFrame:
    """English names; of a JSON field's two names the one that is filled."""
    if file_format != "json":
        return _english(df)
    return df.select(*[F.coalesce(new, old).alias(new) for old, new in SOURCE_HEADERS.items()], *_extra(df))


def _extra(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in SOURCE_HEADERS and c not in RAW_COLUMNS]


def read_year(spark: SparkSession, path: str, year: int, file_format: str = "parquet") -> DataFrame:
    """One year's feed, with the published or the English headers; a missing path fails here.

    Text formats are read as strings, so that staging's strict casts are the only parser. In JSON a field that
    is absent is null.
    """
    return require_columns(_columns(_reader(spark, file_format).load(path), file_format), year)


def read_years(spark: SparkSession, paths: Mapping[int, str], file_format: str = "parquet") -> dict[int, DataFrame]:
    """All years, ascending, one frame each."""
    return {year: read_year(spark, paths[year], year, file_format) for year in sorted(paths)}


def _year_of_file(paths: Mapping[int, str]) -> Column:
    """The year whose path a row's file lies under; of nested paths the longer one."""
    file = F.col("_metadata.file_path")
    within = {year: quote(urlsplit(path).path.rstrip("/"), safe="/%:@!$&'()*+,;=~") for year, path in paths.items()}
    longest_first = sorted(within.items(), key=lambda item: -len(item[1]))
    cases = [F.when(file.contains(path + "/") | file.endswith(path), F.lit(year)) for year, path in longest_first]
    return F.coalesce(*cases).cast("int")


def read_feed(spark: SparkSession, paths: Mapping[int, str], file_format: str = "parquet") -> DataFrame:
    """All years tagged with the year of their path: one scan for all years that are laid out alike.

    Only names and types are looked up per year. Years whose columns differ are read by a scan of their own.
    """
    if not paths:
        raise ValueError("no feed to read")
    layouts: list[tuple[T.StructType, dict[int, str]]] = []
    for year in sorted(paths):
        frame = _reader(spark, file_format).load(paths[year])
        require_columns(_columns(frame, file_format), year)
        same = next((years for schema, years in layouts if schema == frame.schema), None)
        if same is None:
            layouts.append((frame.schema, {year: paths[year]}))
        else:
            same[year] = paths[year]
    scans = []
    for schema, years in layouts:
        scan = _reader(spark, file_format).schema(schema).load(list(years.values()))
        tagged = scan.select("*", _year_of_file(years).alias("_year"))
        scans.append(_columns(tagged, file_format).withColumnRenamed("_year", YEAR))
    return _together(scans)


def _together(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_years(raw: Mapping[int, DataFrame] | DataFrame) -> DataFrame:
    """Bag union of the years, each row tagged with the year of its feed; a feed read as a whole stays as it is."""
    if isinstance(raw, DataFrame):
        return raw
    return _together([df.withColumn(YEAR, F.lit(year).cast(T.IntegerType())) for year, df in sorted(raw.items())])


def raw_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A raw feed from literal rows; absent columns are null."""
    return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)
