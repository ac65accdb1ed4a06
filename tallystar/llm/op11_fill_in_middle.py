"""Fill-in-the-middle documents, cut by rank queries on a wavelet matrix over character classes.

A text is a row of units: white space and the word after it, or the white space at its end. Each character is put
into a class: its kind (space, letter, figure, other) and whether a unit ends with it. A wavelet matrix keeps the
classes of a block of texts, three bit rows with popcount directories, and answers "how many characters of class c
stand before place i". The ranks of the four ending classes add up to the number of units that end before a place;
bisection on that sum finds the place where a given number of units has ended, which gives both cuts of all texts of
the block at once. Two hashed numbers choose how many units prefix and middle take.

Memory of a task: some 30 bytes a character for a block of BLOCK characters or one longer text.

Defined cases: a null text is empty; an empty text, and one that holds a marker, stays plain. A null doc_id hashes as
the empty number. Repeated rows are cut each, alike. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.common import ids, map_batches, table, text_bytes

SEED = 42
PLAIN_FROM = 50  # of 100: documents left as they are
SUFFIX_FIRST = 80  # of 100: cut documents that begin with the suffix
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK = 1 << 20

KINDS = 4  # space, letter, figure, other
ENDS = 4  # added to the kind of a unit's last character
LEVELS = 3
ENDING = range(ENDS, ENDS + KINDS)

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.large_string())]
)


class BitRow:
    """Bits with the number of ones before each word of 64, so that a rank is one lookup and one popcount."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, below = places >> 6, (places & 63).astype(np.uint64)
        mask = (np.uint64(1) << below) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Numbers of LEVELS bits; each level holds one bit of all, ordered stably by the bits above it, zeros first."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.rows: list[tuple[int, BitRow, int]] = []
        for level in reversed(range(LEVELS)):
            bits = (values >> level) & 1 != 0
            self.rows.append((level, BitRow(bits), int(self.size - np.count_nonzero(bits))))
            values = np.concatenate([values[~bits], values[bits]])

    def rank(self, value: int, places: np.ndarray) -> np.ndarray:
        """How many of the first `places` numbers are `value`."""
        first = np.zeros(1, np.int64)
        for level, row, zeros in self.rows:
            ones, ones_first = row.rank(places), row.rank(first)
            if value >> level & 1:
                places, first = zeros + ones, zeros + ones_first
            else:
                places, first = places - ones, first - ones_first
        return places - first


def classes(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of each code point; `ends` are the places after the last character of each (non-empty) text."""
    space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    figure = (points >= 0x30) & (points <= 0x39)
    letter = ((points | 0x20) >= 0x61) & ((points | 0x20) <= 0x7A) | (points >= 0x80)
    last = np.zeros(len(points), bool)
    last[ends - 1] = True
    unit_ends = last.copy()
    unit_ends[:-1] |= ~space[:-1] & space[1:]
    kind = np.where(space, 0, np.where(letter, 1, np.where(figure, 2, 3))).astype(np.uint8)
    return kind + np.where(unit_ends, ENDS, 0).astype(np.uint8)


def units_before(matrix: WaveletMatrix, places: np.ndarray) -> np.ndarray:
    """Units that end before each place: the ranks of all ending classes."""
    return sum(matrix.rank(c, places) for c in ENDING)


def bisect(matrix: WaveletMatrix, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query the first place from `low` to `high` before which `wanted` units have ended."""
    low, high = low.copy(), high.copy()
    while (low < high).any():
        middle = (low + high) >> 1
        enough = units_before(matrix, middle) >= wanted
        high = np.where(enough, middle, high)
        low = np.where(enough, low, np.minimum(middle + 1, high))
    return low


def hashed(doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def cut_block(doc_ids: list, texts: list[str]) -> dict[str, list]:
    """Units, form, cuts and output of the texts of one block."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    matrix = WaveletMatrix(classes(points, ends[lengths > 0]))
    at_start = units_before(matrix, starts)
    n = units_before(matrix, ends) - at_start

    hashes = np.array([hashed(i) for i in doc_ids], np.int64).reshape(-1, 4)
    one, two = hashes[:, 0] % (n + 1), hashes[:, 1] % (n + 1)
    place = {
        name: bisect(matrix, at_start + units, starts, ends) - starts
        for name, units in (("first", np.minimum(one, two)), ("second", np.maximum(one, two)))
    }
    rows: dict[str, list] = {c: [] for c in ARROW.names}
    for i, text in enumerate(texts):
        form, prefix, middle, output = "plain", None, None, text
        if text and hashes[i, 2] % 100 < PLAIN_FROM and not any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
            a, b = int(place["first"][i]), int(place["second"][i])
            form = "spm" if hashes[i, 3] % 100 < SUFFIX_FIRST else "psm"
            before, after = f"{PREFIX}{text[:a]}", f"{SUFFIX}{text[b:]}"
            output = f"{after}{before}{MIDDLE}{text[a:b]}" if form == "spm" else f"{before}{after}{MIDDLE}{text[a:b]}"
            prefix, middle = a, b - a
        for name, value in zip(ARROW.names, (doc_ids[i], int(n[i]), form, prefix, middle, output), strict=True):
            rows[name].append(value)
    return rows


def _cut(iterator: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    for batch in iterator:
        doc_ids, texts, begin, size = ids(batch), [t.decode() for t in text_bytes(batch)], 0, 0
        for end, text in enumerate(texts, 1):
            size += len(text)
            if size >= block or end == len(texts):
                yield pa.RecordBatch.from_pydict(cut_block(doc_ids[begin:end], texts[begin:end]), schema=ARROW)
                begin, size = end, 0


def fill_in_middle(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) per document; no shuffle."""
    schema = SCHEMA
    return map_batches(docs.select("doc_id", "text"), partial(_cut, block=block), schema)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from. Texts with markers stay plain, so the first marker of each kind is ours."""

    def after(marker: str, text: Column) -> Column:
        return F.split(text, marker, 2)[1]

    def before(marker: str, text: Column) -> Column:
        return F.split(text, marker, 2)[0]

    middle = after(MIDDLE, output)
    psm = F.concat(after(PREFIX, before(SUFFIX, output)), middle, after(SUFFIX, before(MIDDLE, output)))
    spm = F.concat(after(PREFIX, before(MIDDLE, output)), middle, after(SUFFIX, before(PREFIX, output)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents"))

    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
