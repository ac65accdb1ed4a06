"""Publishing a run: tables and views of a database, all of them or none.

Every stored table of a run becomes a partition `run=n` of an external table over the folders that are written already;
nothing is copied. The views read the largest run of the table `runs`, so a run that is not listed there is
invisible, and listing it is one change of the catalog that switches all tables and views together. Before that,
all views are created over the new run in a database of their own; if one fails, that database and the run's partitions
go, and the published run stays. Views are replaced only where their text has changed, and put back if a later step
fails.

The fact is published twice: `fact` with the three decimals of the warehouse, `exact_fact` as stored.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.plans import views
from tallystar.plans.star import SUMS, Star
from tallystar.plans.view_sql import VIEW_SQL
from tallystar.schema import DIMENSIONS, WAREHOUSE_TYPE
from tallystar.sources import tables

RUNS = "runs"
CANDIDATE = "candidate"
# Stored tables that are partitioned by a year of their own.
YEAR_OF = {"staging": "source_year", "fact": "source_year", "place_year": "year"}


@dataclass(frozen=True)
class Stored:
    """A written folder, published as a partition of the table `stored_<name>`."""

    name: str
    frame: DataFrame
    path: str

    @property
    def year(self) -> str | None:
        return YEAR_OF.get(self.name)


def _quoted(*names: str) -> str:
    return ".".join(f"`{n.replace('`', '``')}`" for n in names)


def _text(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def resolve(text: str, database: str) -> str:
    """`@name` as a relation of the database."""
    return re.sub(r"@(\w+)", lambda m: _quoted(database, m[1]), text)


def results(star: Star) -> dict[str, DataFrame]:
    """Labels by configured rules, missing cells per indicator, and the counts of the layers: a few rows each."""
    counts = star.counts or {name: getattr(star, name).count() for name in ("staging", "fact")}
    layer_rows = star.spark.range(1).select(
        F.lit(counts["staging"]).cast("bigint").alias("staging_rows"), F.lit(counts["fact"]).cast("bigint").alias("fact_rows")
    )
    return {
        "labels": views.indicator_labels(star),
        "missing_cells": views.quality_not_reported(star),
        "layer_rows": layer_rows,
    }


def stored_tables(star: Star, root: str) -> list[Stored]:
    """Every folder of a written star, with the results added below `published`."""
    found = [Stored(name, getattr(star, name), f"{root}/{name}") for name in ("staging", "fact", *SUMS)]
    found += [Stored(f"dim_{d}", star.dim(d), path) for d, path in tables.dimension_paths(root).items()]
    for name, df in results(star).items():
        path = f"{root}/published/{name}"
        found.append(Stored(name, tables.write_table(df, path), path))
    return found


def base_views(found: list[Stored], database: str, run: str) -> dict[str, str]:
    """The relations the views are made of: each stored table at one run."""
    texts = {}
    for table in found:
        columns = ", ".join(_quoted(c) for c in table.frame.columns)
        source = f"FROM {_quoted(database, f'stored_{table.name}')} WHERE run = {run}"
        if table.name == "fact":
            texts["exact_fact"] = f"SELECT {columns} {source}"
            columns = columns.replace("`value`", f"CAST(`value` AS {WAREHOUSE_TYPE.simpleString()}) AS `value`")
        # The labelled dimension takes the place of the bare one.
        texts["bare_indicator" if table.name == "dim_indicator" else table.name] = f"SELECT {columns} {source}"
    return texts


def _create_tables(spark: SparkSession, found: list[Stored], database: str, root: str) -> None:
    for table in [*found, Stored(RUNS, spark.range(0).select(F.lit("").alias("root")), "")]:
        own = [f for f in table.frame.schema.fields if f.name != table.year]
        fields = [*own, *[f for f in table.frame.schema.fields if f.name == table.year]]
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in [*fields]) + ", run BIGINT"
        partitions = ", ".join(["run", *([_quoted(table.year)] if table.year else [])])
        name = f"stored_{table.name}" if table.name != RUNS else RUNS
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_quoted(database, name)} ({columns}) USING parquet "
            f"PARTITIONED BY ({partitions}) LOCATION {_text(f'{root}/published/no-run/{name}')}"
        )


def _add_run(spark: SparkSession, found: list[Stored], database: str, run: int) -> None:
    for table in found:
        name = _quoted(database, f"stored_{table.name}")
        if table.year is None:
            places = [f"PARTITION (run = {run}) LOCATION {_text(table.path)}"]
        else:
            years = [row[0] for row in table.frame.select(table.year).distinct().collect()]
            places = [
                f"PARTITION (run = {run}, {_quoted(table.year)} = {year}) LOCATION {_text(f'{table.path}/{table.year}={year}')}"
                for year in sorted(years)
            ]
        if places:
            spark.sql(f"ALTER TABLE {name} ADD {' '.join(places)}")


def _drop_run(spark: SparkSession, names: list[str], database: str, run: int) -> None:
    """Take a run's partitions out of the catalog; the files stay."""
    for name in names:
        if spark.catalog.tableExists(f"{database}.{name}"):
            for row in spark.sql(f"SHOW PARTITIONS {_quoted(database, name)}").collect():
                parts = dict(part.split("=", 1) for part in row[0].split("/"))
                if parts["run"] == str(run):
                    spec = ", ".join(f"{_quoted(k)} = {v}" for k, v in parts.items())
                    spark.sql(f"ALTER TABLE {_quoted(database, name)} DROP IF EXISTS PARTITION ({spec})")


def published_runs(spark: SparkSession, database: str) -> list[int]:
    if not spark.catalog.tableExists(f"{database}.{RUNS}"):
        return []
    return sorted(int(row[0].split("=")[1]) for row in spark.sql(f"SHOW PARTITIONS {_quoted(database, RUNS)}").collect())


def _view_text(spark: SparkSession, database: str, name: str) -> str | None:
    """The text of a view as it is in the catalog."""
    if not spark.catalog.tableExists(f"{database}.{name}"):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(database, name)}").collect()
    return next((row.data_type for row in rows if row.col_name == "View Text"), None)


def _create_view(spark: SparkSession, database: str, name: str, text: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(database, name)} AS {text}")


def publish(star: Star, root: str, database: str, public: Mapping[str, str] | None = None, keep: int = 2) -> int:
    """Publish the star written below `root` as the next run of the database; returns the number of the run.

    The last `keep` runs stay in the catalog for queries that still read them.
    """
    spark, public = star.spark, VIEW_SQL if public is None else public
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    run = max(published_runs(spark, database), default=0) + 1
    found = stored_tables(star, root)
    names = [f"stored_{table.name}" for table in found]
    candidate = f"{database}__{CANDIDATE}_{run}"
    before: dict[str, str | None] = {}
    try:
        _create_tables(spark, found, database, root)
        _drop_run(spark, names, database, run)
        _add_run(spark, found, database, run)

        spark.sql(f"DROP DATABASE IF EXISTS {_quoted(candidate)} CASCADE")
        spark.sql(f"CREATE DATABASE {_quoted(candidate)}")
        for name, text in (base_views(found, database, str(run)) | dict(public)).items():
            _create_view(spark, candidate, name, resolve(text, candidate))

        current = f"(SELECT MAX(run) FROM {_quoted(database, RUNS)})"
        for name, text in (base_views(found, database, current) | dict(public)).items():
            wanted, known = resolve(text, database), _view_text(spark, database, name)
            if known is None or known.strip() != wanted.strip():
                before[name] = known
                _create_view(spark, database, name, wanted)

        listed = f"{root}/published/{RUNS}"
        tables.write_table(spark.range(1).select(F.lit(root).alias("root")), listed)
        # The switch.
        spark.sql(f"ALTER TABLE {_quoted(database, RUNS)} ADD PARTITION (run = {run}) LOCATION {_text(listed)}")
    except PySparkException:
        for name, text in before.items():
            if text is None:
                spark.sql(f"DROP VIEW IF EXISTS {_quoted(database, name)}")
            else:
                _create_view(spark, database, name, text)
        _drop_run(spark, names, database, run)
        raise
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {_quoted(candidate)} CASCADE")
    for old in published_runs(spark, database)[:-keep]:
        _drop_run(spark, [RUNS, *names], database, old)
    return run
