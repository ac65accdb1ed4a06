"""Best-fit packing by sum of squares: few sequences of at most CAPACITY tokens.

A document's token ids end with END; only documents longer than a sequence are cut, at multiples of CAPACITY.
Full pieces are sequences by themselves. The others are dealt to groups of about GROUP pieces by hash, and each
group is packed on its own, longest piece first: of all places (an open bin of some residual gap, or a new bin)
a piece takes the one after which the sum over gaps of the squared number of open bins is smallest. A group
leaves a few half-filled bins at most, against thousands of full ones, so the loss is independent of the number
of groups and no task sees more than its group.

Defined cases: a null or empty text is the one token END. Ties go to the bin with the smaller gap, then to the
bin opened last; equal pieces go by doc_id. Extra columns are ignored; repeated rows are packed each. An empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm import tokens
from tallystar.llm.common import durable, ids, map_batches, ship, table, text_bytes
from tallystar.storage import batches_of

if TYPE_CHECKING:  # workers that only cut texts do not load it
    import pandas as pd

CAPACITY = 4096
BATCH = 1024  # texts a worker holds at once
END = 1
GROUP = 32_768
GROUP_BITS = 32  # bins of a group are numbered below its own number

PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
PIECES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("row", pa.int64()), ("piece", pa.int32()),
    ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
])
PLACES = PIECES + ", sequence_id long, offset long"


def _cut_batch(batch: pa.RecordBatch, path: str | None) -> dict[str, list]:
    vocabulary, end, size = tokens.words(path), np.array([END], "<u4").tobytes(), CAPACITY * 4
    out: dict[str, list] = {name: [] for name in PIECES_ARROW.names}
    for doc_id, row, text in zip(ids(batch), ids(batch, "row"), text_bytes(batch), strict=True):
        buffer = memoryview(vocabulary.ids(text) + end)
        for piece, at in enumerate(range(0, len(buffer), size)):
            part = buffer[at : at + size]
            for name, value in zip(out, (doc_id, row, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                out[name].append(value)
    return out


def token_pieces(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The pieces of every document: number, start, length, crc32 of the ids."""

    def cut(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            for at in range(0, batch.num_rows, BATCH):
                yield pa.RecordBatch.from_pydict(_cut_batch(batch.slice(at, BATCH), path), schema=PIECES_ARROW)

    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return map_batches(rows, cut, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, in the given order of arrival; lengths from 1 to capacity.

    With n(g) open bins of gap g, filling one of gap g with s changes the sum of squares by
    2 n(g - s) + 1 (none when the bin closes) - 2 n(g) + 1, and a new bin by 2 n(capacity - s) + 1.
    """
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    counts = np.zeros(capacity + 1, np.int64)
    stacks: dict[int, list[int]] = {}
    opened = 0
    for i, s in enumerate(lengths.tolist()):
        rest = capacity - s
        have = counts[s:capacity]
        change = 2 * (counts[:rest] - have) + 2
        if rest:
            change[0] -= 1
            change[have == 0] = np.iinfo(np.int64).max
        after = int(change.argmin()) if rest else -1
        fresh = 2 * int(counts[rest]) + 1 if rest else 0
        if after >= 0 and change[after] <= fresh:
            gap = after + s
            counts[gap] -= 1
            bin_ = stacks[gap].pop()
        else:
            gap, after, bin_ = capacity, rest, opened
            opened += 1
        bins[i], offsets[i] = bin_, capacity - gap
        if after:
            counts[after] += 1
            stacks.setdefault(after, []).append(bin_)
    return bins, offsets


def _pack_group(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    group = group.sort_values(["length", "doc_id", "row", "piece"], ascending=[False, True, True, True], na_position="first")
    bins, offsets = sum_of_squares(group["length"].to_numpy(), capacity)
    number = (group["group"].to_numpy(np.int64) << GROUP_BITS) + bins
    return group.drop(columns="group").assign(sequence_id=number, offset=offsets)


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Add `sequence_id` and `offset` to durable pieces with columns PIECES."""
    ship(pieces.sparkSession)
    full = pieces.filter(F.col("length") == capacity)
    rest = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group))
    # Sequence numbers of full pieces lie below zero, apart from those of the groups.
    own = full.withColumn("sequence_id", -1 - F.monotonically_increasing_id())
    own = own.withColumn("offset", F.lit(0).cast("long"))
    dealt = rest.withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
    return own.unionByName(dealt.groupBy("group").applyInPandas(partial(_pack_group, capacity=capacity), PLACES))


def best_fit_packing(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    with batches_of(docs.sparkSession, BATCH):
        pieces = durable(token_pieces(docs, path))
    return pack(pieces).drop("row")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage."""
    return best_fit_packing(docs)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))
