"""Writing and reading the tables of a run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallystar.schema import DIMENSIONS
from tallystar.storage import OPEN_FILES_CONF, at_least, building

# Years a task keeps open while it writes; beyond them Spark sorts the rest of its rows by year.
OPEN_YEARS = 32
CODEC = "zstd"


def write_landing(raw: DataFrame, path: str) -> dict[int, str]:
    """Lay a raw feed out as one folder per source year; returns the folder of each year."""
    with building(raw.sparkSession):
        years = _stored_by_year(raw, path).select("source_year").distinct().collect()
    return {row.source_year: f"{path}/source_year={row.source_year}" for row in years}


def _stored(
    df: DataFrame, path: str, partition: str | None = None, counted: Observation | None = None, codec: str | None = CODEC
) -> DataFrame:
    """Write a table and open what was written; its schema is known, so no file is opened for it.

    `counted` takes the number of `rows` on the way, in the stage that writes them. Without a codec the session's is used.
    """
    observed = df if counted is None else df.observe(counted, F.count("*").alias("rows"))
    writer = observed.write.mode("overwrite")
    if codec is not None:
        writer = writer.option("compression", codec)
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stored_by_year(df: DataFrame, path: str, counted: Observation | None = None) -> DataFrame:
    """Rows in any order, each to its year's file as it comes: whole rows are not sorted (nor spilled) for it."""
    with at_least(df.sparkSession, {OPEN_FILES_CONF: OPEN_YEARS}):
        return _stored(df, path, "source_year", counted)


def write_staging(staging: DataFrame, path: str, counted: Observation | None = None) -> DataFrame:
    return _stored_by_year(staging, path, counted)


def write_table(df: DataFrame, path: str, counted: Observation | None = None) -> DataFrame:
    return _stored(df, path, counted=counted)


def write_dimension(df: DataFrame, path: str) -> DataFrame:
    """Dimensions keep Spark's partitioning: places grow with the data, the others are one file anyway.

    They keep the session's codec too: Spark broadcasts them by the size of their files.
    """
    return _stored(df, path, codec=None)


def clustered(df: DataFrame, year: str) -> DataFrame:
    """Dealt by range of the year, the indicator and the place.

    A year or an indicator holding a third of all rows is spread over many tasks, and each task covers few indicators.
    """
    return df.repartitionByRange(year, "indicator_id", "place_id")


def write_clustered(df: DataFrame, path: str, year: str, counted: Observation | None = None) -> DataFrame:
    """What `clustered` has dealt, partitioned by year: a filter on an indicator skips files by their min/max statistics."""
    return _stored(df.sortWithinPartitions(year, "indicator_id", "place_id"), path, year, counted)


def write_fact(fact: DataFrame, path: str, counted: Observation | None = None) -> DataFrame:
    return write_clustered(clustered(fact, "source_year"), path, "source_year", counted)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_warehouse(spark: SparkSession, tables: dict[str, DataFrame], database: str) -> list[str]:
    """Full refresh: every table is recreated, in the given order (staging, dimensions, fact)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    loaded = []
    for name, df in tables.items():
        full_name = f"`{database}`.`{name}`"
        writer = df.write.mode("overwrite").format("parquet")
        if "source_year" in df.columns and name in ("staging", "fact"):
            writer = writer.partitionBy("source_year")
        writer.saveAsTable(full_name)
        loaded.append(full_name)
    return loaded


def register_tables(spark: SparkSession, paths: Mapping[str, str], database: str) -> list[str]:
    """External tables over folders that are written already: nothing is copied, layout and partitions stay."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    registered = []
    for name, path in paths.items():
        full_name = f"`{database}`.`{name}`"
        spark.sql(f"DROP TABLE IF EXISTS {full_name}")
        spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
        if any(column.isPartition for column in spark.catalog.listColumns(f"{database}.{name}")):
            spark.catalog.recoverPartitions(f"{database}.{name}")
        registered.append(full_name)
    return registered


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Full refresh of a table in a database, written by the executors in parallel."""
    df.write.mode("overwrite").option("truncate", True).jdbc(url, table, properties=properties)


def dimension_paths(root: str) -> dict[str, str]:
    return {name: f"{root}/dim_{name}" for name in DIMENSIONS}
