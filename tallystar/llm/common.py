"""What the operators share: tables, byte columns, durable intermediates, numbering within keys, rates of labels."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import tallystar
from tallystar.storage import settle

ROW_BITS = 33
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the package to the executors once per application, for tasks that run its Python functions."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(tallystar.__file__)))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "tallystar"), "zip", root, "tallystar")
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def durable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; later jobs start from its files."""
    return settle(df)


def release(spark: SparkSession) -> None:
    """Let the driver forget finished phases, so that Spark's cleaner drops their shuffle files.

    The first collection ends what waits for finalizers, the second finds the shuffles unused.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null is the empty text."""
    return batch.column(name).cast(pa.binary()).fill_null(b"").to_pylist()


def ids(batch: pa.RecordBatch, name: str = "doc_id") -> list:
    return batch.column(name).to_pylist()


def batches(rows: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(rows, schema=schema)


def map_batches(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """`mapInArrow` after shipping the package."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """The fold whose labels are never learned: crc32 of the id as text leaves 1 when divided by 3."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def number_within(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Add `name` = 0, 1, ... within each combination of `keys`, following `order`, however large one is.

    The frame is range-sorted and checkpointed; each row then knows its partition and its place in it. Per
    partition and key the rows are counted, the counts of earlier partitions are added up (a row per
    partition and key that occurs there), and joined back. `order` must make rows unique or ties equivalent.
    """
    sort = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    placed = durable(df.orderBy(*sort).withColumn("_slot", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_slot", ROW_BITS))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy(*keys, "_part")
        .agg(F.count("*").alias("_rows"), F.min("_slot").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumnsRenamed({k: f"_key_{i}" for i, k in enumerate(keys)} | {"_part": "_of_part"})
    )
    same = placed["_part"] == parts["_of_part"]
    for i, key in enumerate(keys):
        same = same & placed[key].eqNullSafe(parts[f"_key_{i}"])
    return placed.join(parts, same).select(
        *[placed[c] for c in df.columns], (F.col("_slot") - F.col("_first") + F.col("_before")).alias(name)
    )


def stream(iterator: Iterator[pa.RecordBatch], one, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Apply `one(batch) -> dict of columns` to each batch."""
    for batch in iterator:
        if batch.num_rows:
            yield batches(one(batch), schema)
