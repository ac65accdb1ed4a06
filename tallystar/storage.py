"""Where intermediate tables go, and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Rows a task sums or sorts within its share of memory: of the grain's keys and sums, about half a GB.
ROWS_PER_TASK = 1_000_000
OPEN_FILES_CONF = "spark.sql.maxConcurrentOutputFileWriters"
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
SCAN_TASKS_CONF, SHUFFLE_TASKS_CONF = "spark.sql.files.minPartitionNum", "spark.sql.shuffle.partitions"
# Spark joins the partitions of a shuffle up to this size; the build's densest shuffles hold a row in 10 bytes.
JOINED_CONF, JOINED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 8 << 20
# A shuffled side whose partitions are all this small is hashed, so that the other side is not sorted for the join.
# Unlike a sort, the hashed side cannot be spilled.
HASH_JOIN_CONF, HASH_JOIN_BYTES = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", JOINED_BYTES
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only for a local master."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if context.getCheckpointDir() is None:
        if not named and not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tallystar-"))
    return (named or context.getCheckpointDir()).rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def at_least(spark: SparkSession, numbers: dict[str, int]) -> Iterator[None]:
    """Settings raised to these numbers while the jobs inside run; afterwards they are what they were."""
    with _set(spark, {name: max(number, int(spark.conf.get(name, None) or 0)) for name, number in numbers.items()}):
        yield


@contextmanager
def building(spark: SparkSession) -> Iterator[None]:
    """The jobs inside leave no shuffles behind, and join no partitions of a shuffle to more rows than a task takes.

    Spark would keep the files of every shuffle until its cleaner finds them unused, which a driver with little garbage
    puts off beyond the end of the build: layers are written tables, so nothing reads a shuffle again.
    """
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(JOINED_CONF))
    with _set(spark, {CLEANUP_CONF: "true", JOINED_CONF: min(now, JOINED_BYTES)}):
        yield


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python functions of the jobs inside get at most so many rows at once; a smaller setting of the session stays."""
    now = int(spark.conf.get(BATCH_CONF))
    with _set(spark, {BATCH_CONF: min(rows, now) if now > 0 else rows}):
        yield


@contextmanager
def _set(spark: SparkSession, values: dict[str, int | str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, old in before.items():
            if old is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, old)


def tasks_for(spark: SparkSession, rows: int):
    """Scans and shuffles of the jobs inside get a task per ROWS_PER_TASK rows, or more if the session says so.

    Parquet stores these rows in a few bytes each, so a split of the default size holds more of them than a task can
    sum or sort without spilling.
    """
    tasks = -(-rows // ROWS_PER_TASK)
    scans = max(tasks, spark.sparkContext.defaultParallelism)
    numbers = {SCAN_TASKS_CONF: scans, SHUFFLE_TASKS_CONF: tasks}
    if spark.conf.get(HASH_JOIN_CONF, None) is None:  # a session's own limit stays, whatever unit it is written in
        numbers[HASH_JOIN_CONF] = HASH_JOIN_BYTES
    return at_least(spark, numbers)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a table of this run that nothing reads any more."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are on shared storage, so a lost executor cannot change them."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def together(**work: Callable[[], T]) -> dict[str, T]:
    """Start independent jobs side by side, so that small ones do not wait for each other.

    The threads take over job group, scheduler pool and the session's other local properties.
    """
    done: dict[str, T] = {}
    failed: list[BaseException] = []

    def note(name: str, job: Callable[[], T]) -> None:
        try:
            done[name] = job()
        except BaseException as problem:  # raised again below, in the thread that asked
            failed.append(problem)

    threads = [InheritableThread(target=note, args=(name, job)) for name, job in work.items()]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if failed:
        raise failed[0]
    return done
