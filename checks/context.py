"""The star of a data folder, built once per session and folder and then read from its tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.plans.publish import publish
from tallystar.plans.star import Star, write_star
from tallystar.sources import tables
from tallystar.sources.driver_feed import feed, feed_reference
from tallystar.sources.raw import read_feed
from tallystar.storage import run_dir


@dataclass(frozen=True)
class Context:
    star: Star
    root: str

    @property
    def raw(self) -> DataFrame:
        return self.star.raw


_built: dict[tuple[str, str], Context] = {}


def lay_out(spark: SparkSession, sf_dir: str, root: str) -> dict[int, str]:
    """Write the raw feed as one folder per year, the form its readers expect."""
    return tables.write_landing(feed(spark, sf_dir), f"{root}/landing")


def build_context(spark: SparkSession, sf_dir: str, root: str, paths: dict[int, str]) -> Context:
    return Context(write_star(read_feed(spark, paths), feed_reference(spark, sf_dir), root), root)


def context(spark: SparkSession, sf_dir: str) -> Context:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        root = run_dir(spark, "star")
        _built[key] = build_context(spark, sf_dir, root, lay_out(spark, sf_dir, root))
    return _built[key]


_published: dict[str, str] = {}


def published(c: Context) -> str:
    """The database the star of a folder is published in, once per session and folder."""
    if c.root not in _published:
        database = f"published_{abs(hash(c.root))}"
        publish(c.star, c.root, database)
        _published[c.root] = database
    return _published[c.root]


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Types both engines share: exact decimals as doubles, computed doubles rounded, integers as bigint."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column, digits) + F.lit(0.0)
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)
