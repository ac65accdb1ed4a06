"""Repeated passages by a logarithmic family of sparse suffix arrays.

Every byte is removed that lies in a LENGTH-byte string which also starts in a document of smaller doc_id.

1. Sync points: of every LENGTH-byte window the KEY-byte string of smallest hash is its anchor, which depends on
   the window's bytes only. Equal windows have equal anchors, and one byte in thirteen starts an anchor.
2. Batches and levels: documents come in batches, in order of doc_id; there are more of them the larger the input. A
   batch's suffix array holds its suffixes at sync points, in order of the hash of their first KEY bytes and cut into parts
   by that hash. It is merge-scanned against itself and every level of the index: an anchor that stands in two
   different texts is reported for both. Then it becomes a level; two levels of equal rank merge into one of the next
   rank, so a suffix is rewritten O(log batches) times. A task that reads documents reports the anchors that its own
   documents share and sends each anchor on once.
3. Suffix contexts: around reported anchors the suffixes are compared in full. Equal windows meet and learn the
   smallest document that has them: first those of SLICE documents in the task that reads them, then what is left, the
   smallest of each slice, in the part of its anchor. Windows meet by a 64-bit hash and are equal only if all their bytes are.
4. Matched windows return to their documents, which are cut.

Equal texts (by SHA-256) are one text, owned by its smallest doc_id; all others are covered wholly. In the index a text
is named by 64 bits: an anchor that only stands in two different texts of the same name would not be reported.

Memory: a task holds the arrays of one part, of about PART anchors. A passage that very many documents share reaches the
part of its anchor once a slice. Windows that differ around it, where it begins and ends, do not shrink like that. So an
anchor is heavy that more than HEAVY texts of one Arrow batch have, or more than HEAVY batches of texts, and its windows
are dealt one by one, by the hash of all their bytes.

Defined cases: null is the empty text; texts below LENGTH bytes keep all bytes. A row without a doc_id has no place in the
order: it keeps all bytes and takes none from others. Rows with an equal doc_id and different texts are outside the
contract: each is compared with documents of smaller doc_id only. Very long texts are read in overlapping stretches.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm import hashing
from tallystar.llm.common import durable, ids, map_batches, release, table, text_bytes
from tallystar.storage import run_dir

LENGTH = 50
KEY = 26
WINDOW = LENGTH - KEY + 1  # anchors' starts that a window may choose from
STRETCH = 1 << 20  # bytes looked at together
PLACE = np.uint64(STRETCH - 1)
LEAST_BATCHES = 4
BATCH_BYTES = 1 << 26  # twice the input is one batch more
PART = 400_000
HEAVY = 256
DENSITY = 13  # bytes per anchor
SLICE = 1024
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
OWN, REPORT, OFTEN = -1, -2, -3  # levels of a batch's own suffixes, of anchors known to be shared and of heavy ones
BROADCAST_BYTES = 16 << 20  # heavy anchors up to this size are sent to all executors


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first window, number of windows) of each anchor of a text, over all its windows in order."""
    keys, firsts, numbers = [], [], []
    for at in range(0, max(0, len(text) - LENGTH + 1), STRETCH - LENGTH):
        piece = np.frombuffer(text, np.uint8, min(STRETCH - 1, len(text) - at), at)
        sums = hashing.prefix_sums(piece)
        n = len(piece) - KEY + 1
        starts = np.arange(n)
        hashed = hashing.windows(sums, starts, starts + KEY)
        least = (hashed & ~PLACE) | starts.astype(np.uint64)
        for step in (1, 2, 4, 8):
            least = np.minimum(least[:-step], least[step:])
        least = np.minimum(least[: -(WINDOW - 16)], least[WINDOW - 16 :])
        least = least[: STRETCH - LENGTH]  # the next stretch has the other windows
        place = (least & PLACE).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        keys.append(hashed[place[first]])
        firsts.append(first + at)
        numbers.append(np.diff(np.concatenate([first, [len(place)]])))
    if not keys:
        nothing = np.empty(0, np.int64)
        return nothing.view(np.uint64), nothing, nothing
    return np.concatenate(keys), np.concatenate(firsts), np.concatenate(numbers)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (hashing.mix(keys) % np.uint64(parts)).astype(np.int32)


def by_part(part: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by part, and (part, start, end) in that order."""
    order = np.argsort(part)
    ordered = part[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(ordered)) + 1, [len(ordered)]])
    return order, [(int(ordered[a]), int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


SUFFIXES = pa.schema([("level", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("owners", pa.binary())])
SUFFIX_COLUMNS = "level int, part int, keys binary, owners binary"


def _grouped(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys and owners in order of key, start of each key, whether it has several owners)."""
    order = np.argsort(keys)
    key, owner = keys[order], owners[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key, owner, starts, np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)


def _row(level: int | None, part: int | None, keys: np.ndarray, owners: np.ndarray) -> pa.RecordBatch:
    values = [[level], [part], [keys.tobytes()], [owners.tobytes()]]
    return pa.RecordBatch.from_pydict(dict(zip(SUFFIXES.names, values, strict=True)), schema=SUFFIXES)


def _sizes(starts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.concatenate([starts, [total]]))


def batch_suffixes(texts: DataFrame, parts: int, heavy: int) -> DataFrame:
    """The suffixes of a batch at its sync points, as arrays per task and part: one suffix per key, level OWN.

    Keys that several texts of a task have are reported here, for each of them, as rows of level REPORT; those that more
    than `heavy` have are named in rows of level OFTEN too.
    """

    def collect(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            keys, owners = [], []
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                for owner, text in zip(ids(rows, "owner"), text_bytes(rows), strict=True):
                    own = np.unique(anchors(text)[0])
                    keys.append(own)
                    owners.append(np.full(len(own), owner, np.int64))
            if not sum(map(len, keys)):
                continue
            key, owner, starts, differs = _grouped(np.concatenate(keys), np.concatenate(owners))
            sizes = _sizes(starts, len(key))
            shared, often = np.repeat(differs, sizes), key[starts[sizes > heavy]]
            if shared.any():  # any part will do for a report
                yield _row(REPORT, int(part_of(key[shared][:1], parts)[0]), key[shared], owner[shared])
            if len(often):
                yield _row(OFTEN, int(part_of(often[:1], parts)[0]), often, often[:0])
            key, owner = key[starts], owner[starts]
            order, pieces = by_part(part_of(key, parts))
            key, owner = key[order], owner[order]
            for at in range(0, len(pieces), 64):
                some = pieces[at : at + 64]
                columns = [[OWN] * len(some), [p for p, _, _ in some], [key[a:b].tobytes() for _, a, b in some], [owner[a:b].tobytes() for _, a, b in some]]
                yield pa.RecordBatch.from_pydict(dict(zip(SUFFIXES.names, columns, strict=True)), schema=SUFFIXES)

    return map_batches(texts.select("owner", "text"), collect, SUFFIX_COLUMNS)


def _parts(iterator: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, np.ndarray, np.ndarray]]]]:
    """(part, [(level, keys, owners)]) of rows that come in order of part."""
    current, rows = None, []
    for batch in iterator:
        for level, part, key, owner in zip(*(batch.column(c).to_pylist() for c in SUFFIXES.names), strict=True):
            if part != current and rows:
                yield current, rows
                rows = []
            current = part
            rows.append((level, np.frombuffer(key, np.uint64), np.frombuffer(owner, np.int64)))
    if rows:
        yield current, rows


def scan_and_insert(suffixes: DataFrame, levels: list[DataFrame], parts: int, heavy: int, insert: bool = True) -> DataFrame:
    """Merge-scan a batch against itself and all levels.

    Rows with a null part report (key, owner) pairs in `keys` and `owners`, or heavy keys where their level is OFTEN; the
    others are the batch's own suffix array, sorted, one row per part and one suffix per key, if it is to be inserted.
    """

    def reports(keys: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        joined = [np.concatenate(x) for x in (keys, owners)] if keys else [[], []]
        for at in range(0, len(joined[0]), 100_000):
            yield _row(None, None, *(x[at : at + 100_000] for x in joined))

    def scan(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _parts(iterator):
            found_keys, found_owners = ([r[i] for r in rows if r[0] == REPORT] for i in (1, 2))
            yield from (_row(OFTEN, None, r[1], r[2]) for r in rows if r[0] == OFTEN)
            own = [r for r in rows if r[0] == OWN]
            if not own:
                yield from reports(found_keys, found_owners)
                continue
            key, owner, starts, differs = _grouped(np.concatenate([k for _, k, _ in own]), np.concatenate([o for _, _, o in own]))
            first = owner[starts]
            for level, old_keys, old_owners in rows:
                if level >= 0:  # both sides are sorted and have each key once
                    at = np.minimum(np.searchsorted(old_keys, key[starts]), len(old_keys) - 1)
                    hit = old_keys[at] == key[starts]
                    hit[hit] = (old_owners[at[hit]] != first[hit]) | differs[hit]
                    differs |= hit
                    found_keys.append(key[starts][hit])
                    found_owners.append(old_owners[at[hit]])
            sizes = _sizes(starts, len(key))
            if (sizes > heavy).any():
                yield _row(OFTEN, None, key[starts[sizes > heavy]], owner[:0])
            inside = np.repeat(differs, sizes)
            found_keys.append(key[inside])
            found_owners.append(owner[inside])
            yield from reports(found_keys, found_owners)
            if insert:
                yield _row(0, part, key[starts], first)

    everything = suffixes
    for level in levels:
        everything = everything.unionByName(level)
    dealt = everything.repartition(parts, "part").sortWithinPartitions("part", "level")
    return map_batches(dealt, scan, SUFFIX_COLUMNS)


def merge_levels(left: DataFrame, right: DataFrame, rank: int, parts: int) -> DataFrame:
    """One sorted suffix array per part from two; of equal keys the first owner stays."""

    def merge(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _parts(iterator):
            key, owner, starts, _ = _grouped(np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows]))
            yield _row(rank, part, key[starts], owner[starts])

    dealt = left.unionByName(right).repartition(parts, "part").sortWithinPartitions("part", "level")
    return map_batches(dealt, merge, SUFFIX_COLUMNS)


def reported_anchors(texts: DataFrame, batches: int, parts: int, heavy: int) -> DataFrame:
    """(owner, keys, heavy): anchors that stand in two texts or more, for each text that has them.

    `heavy` has those of them that more than `heavy` texts of a task, or that many tasks, have.
    """
    spark = texts.sparkSession
    root = run_dir(spark, "suffixes")
    schema = pa.schema([("owner", pa.int64()), ("key", pa.int64())])

    def unpack(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            for keys, owners in zip(batch.column("keys").to_pylist(), batch.column("owners").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(owners, np.int64)), pa.array(np.frombuffer(keys, np.int64))], schema=schema)

    def unpack_often(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            for keys in batch.column("keys").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, np.int64))], names=["key"])

    limits = texts.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000).alias("q")).first()["q"] or []
    edges = sorted(set(limits))
    levels: dict[int, str] = {}
    reports = []
    for number in range(len(edges) + 1):
        batch = texts
        if number:
            batch = batch.filter(F.col("doc_id") > edges[number - 1])
        if number < len(edges):
            batch = batch.filter(F.col("doc_id") <= edges[number])
        known = [spark.read.schema(SUFFIX_COLUMNS).parquet(path) for path in levels.values()]
        scanned = scan_and_insert(batch_suffixes(batch, parts, heavy), known, parts, heavy, insert=number < len(edges))  # no scan follows the last batch
        # Reports are named by a null part, the batch's own suffix array by its parts.
        write_and_forget(scanned.withColumn("report", F.col("part").isNull()), f"{root}/scan-{number}", "report")
        reports.append(f"{root}/scan-{number}/report=true")
        release(spark)
        path, rank = f"{root}/scan-{number}/report=false", 0
        if not folder_exists(spark, path):  # a batch of short texts, or the last one
            continue
        while rank in levels:
            old = levels.pop(rank)
            rank += 1
            merged = f"{root}/level-{number}-{rank}"
            left, right = (spark.read.schema(SUFFIX_COLUMNS).parquet(p) for p in (old, path))
            write_and_forget(merge_levels(left, right, rank, parts), merged)
            for gone in (old, path):
                drop_folder(spark, gone)
            path = merged
        levels[rank] = path
        release(spark)
    reports = [path for path in reports if folder_exists(spark, path)]
    if reports:
        rows = spark.read.schema(SUFFIX_COLUMNS).parquet(*reports)
        found = map_batches(rows.filter("level IS NULL"), unpack, "owner long, key long")
        often = map_batches(rows.filter(F.col("level") == OFTEN), unpack_often, "key long").distinct()
        often = durable(often.withColumn("often", F.col("key")))
    else:
        found = texts.select("owner", F.lit(0).cast("long").alias("key")).limit(0)
        often = found.select("key", F.col("key").alias("often"))
    often = F.broadcast(often) if often.count() * 16 <= BROADCAST_BYTES else often
    found = found.join(often, "key", "left").groupBy("owner")
    found = durable(found.agg(F.collect_set("key").alias("keys"), F.collect_set("often").alias("heavy")))
    drop_folder(spark, root)
    return found


def write_and_forget(df: DataFrame, path: str, *by: str) -> None:
    """Write a table; Spark removes the shuffles of the write as soon as it has ended, without waiting for its cleaner."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove files of this run that later ones have replaced."""
    system, found = _path(spark, path)
    system.delete(found, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    system, found = _path(spark, path)
    return system.exists(found)


CONTEXTS = pa.schema([
    ("part", pa.int32()), ("docs", pa.binary()), ("firsts", pa.binary()), ("numbers", pa.binary()), ("bytes", pa.binary()),
])
CONTEXT_COLUMNS = "part int, docs binary, firsts binary, numbers binary, bytes binary"


Contexts = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # documents, first windows, numbers of windows, bytes
STEPS = (*range(0, LENGTH - 7, 8), LENGTH - 8)  # words of 8 bytes that make up a window


def equal_windows(hashed: np.ndarray, starts: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, heads): windows in an order where equal ones stand together, and where each group of them begins.

    The hash orders them; equality is that of all bytes. Should unlike windows have one hash, the bytes order them.
    """
    words = np.ndarray((len(joined) - 7,), "<u8", joined, strides=(1,))
    order = np.argsort(hashed)
    ordered = hashed[order]
    same = ordered[1:] == ordered[:-1]
    after = np.flatnonzero(same) + 1
    one, other = starts[order[after - 1]], starts[order[after]]
    if any((words[one + step] != words[other + step]).any() for step in STEPS):
        columns = [words[starts + step] for step in STEPS]
        order = np.lexsort(columns)
        same = np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in columns])
    return order, np.flatnonzero(np.concatenate([[True], ~same]))


def settle_windows(contexts: Contexts) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, Contexts, np.ndarray]:
    """Which windows of some contexts stand in a smaller document of these contexts too.

    Gives (documents, runs) of those that do, a run being first window * 256 + length; and of the others their runs as
    contexts again, with the context each comes from and the hash of each of their windows.
    """
    docs, firsts, numbers, joined = contexts
    offsets = np.cumsum(numbers + LENGTH - 1) - (numbers + LENGTH - 1)
    within = np.arange(numbers.sum()) - np.repeat(np.cumsum(numbers) - numbers, numbers)
    starts = np.repeat(offsets, numbers) + within
    hashed = hashing.windows(hashing.prefix_sums(joined), starts, starts + LENGTH)
    source = np.repeat(np.arange(len(docs)), numbers)
    doc, window = docs[source], firsts[source] + within
    order, heads = equal_windows(hashed, starts, joined)
    hit = np.zeros(len(doc), bool)
    hit[order] = np.repeat(np.minimum.reduceat(doc[order], heads), _sizes(heads, len(doc))) < doc[order]

    def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(mask)
        begin = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (within[at[1:]] == 0)])) if len(at) else at
        return at[begin], _sizes(begin, len(at)) if len(at) else at

    at, lengths = runs(hit)
    left, sizes = runs(~hit)
    stretch = sizes + LENGTH - 1
    places = np.arange(stretch.sum()) - np.repeat(np.cumsum(stretch) - stretch, stretch) + np.repeat(starts[left], stretch)
    rest = (doc[left], window[left], sizes, joined[places])
    return (doc[at], window[at] * 256 + lengths), source[left], rest, hashed[~hit]


def single_windows(contexts: Contexts) -> Contexts:
    """Contexts of one window each."""
    docs, firsts, numbers, joined = contexts
    offsets = np.cumsum(numbers + LENGTH - 1) - (numbers + LENGTH - 1)
    within = np.arange(numbers.sum()) - np.repeat(np.cumsum(numbers) - numbers, numbers)
    starts = np.repeat(offsets, numbers) + within
    places = starts[:, None] + np.arange(LENGTH)
    return np.repeat(docs, numbers), np.repeat(firsts, numbers) + within, np.ones(len(starts), np.int64), joined[places].ravel()


def _packed(part: np.ndarray, contexts: Contexts) -> Iterator[pa.RecordBatch]:
    """Contexts as rows, one a part."""
    docs, firsts, numbers, joined = contexts
    order, pieces = by_part(part)
    stretch = numbers + LENGTH - 1
    offsets = (np.cumsum(stretch) - stretch)[order]
    stretch = stretch[order]
    ends = np.cumsum(stretch)
    dealt = joined[np.arange(stretch.sum()) - np.repeat(ends - stretch, stretch) + np.repeat(offsets, stretch)]
    docs, firsts, numbers = docs[order], firsts[order], numbers[order].astype(np.uint8)
    for at in range(0, len(pieces), 256):
        some = pieces[at : at + 256]
        columns = [[p for p, _, _ in some], *([x[a:b].tobytes() for _, a, b in some] for x in (docs, firsts, numbers))]
        columns.append([dealt[ends[a] - stretch[a] : ends[b - 1]].tobytes() for _, a, b in some])
        yield pa.RecordBatch.from_pydict(dict(zip(CONTEXTS.names, columns, strict=True)), schema=CONTEXTS)


def suffix_contexts(texts: DataFrame, parts: int) -> DataFrame:
    """For reported anchors: document, first window, number of windows and the bytes of all of them, per part.

    Windows that a smaller document of the same slice has are matched here already: a row of documents and, in place of
    first windows, runs, without numbers and bytes.
    """

    def cut(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                found: list[list] = [[], [], [], [], [], []]
                for doc_id, text, wanted, often in zip(ids(rows), text_bytes(rows), rows.column("keys"), rows.column("heavy"), strict=True):
                    keys, firsts, numbers = anchors(text)
                    wanted, often = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (wanted, often))
                    shared = np.isin(keys, wanted)
                    own = (keys[shared], firsts[shared], numbers[shared], np.isin(keys[shared], often))
                    for column, values in zip(found, (np.full(len(own[0]), doc_id, np.int64), *own), strict=False):
                        column.append(values)
                    found[5].extend([text[f : f + n + LENGTH - 1] for f, n in zip(own[1].tolist(), own[2].tolist(), strict=True)])
                docs, keys, firsts, numbers, heavy = (np.concatenate(c) for c in found[:5])
                if not len(docs):
                    continue
                contexts = (docs, firsts, numbers, np.frombuffer(b"".join(found[5]), np.uint8))
                matched, source, rest, hashed = settle_windows(contexts)
                if len(matched[0]):  # any part will do
                    row = [part_of(keys[:1], parts).tolist(), *([x.tobytes()] for x in matched), [None], [None]]
                    yield pa.RecordBatch.from_pydict(dict(zip(CONTEXTS.names, row, strict=True)), schema=CONTEXTS)
                for chosen, kind in ((~heavy[source], False), (heavy[source], True)):
                    if not chosen.any():
                        continue
                    stretch = np.repeat(chosen, rest[2] + LENGTH - 1)
                    some = (rest[0][chosen], rest[1][chosen], rest[2][chosen], rest[3][stretch])
                    dealt = hashed[np.repeat(chosen, rest[2])] if kind else keys[source[chosen]]
                    yield from _packed(part_of(dealt, parts), single_windows(some) if kind else some)

    return map_batches(texts.select("doc_id", "text", "keys", "heavy"), cut, CONTEXT_COLUMNS)


def matched_windows(contexts: DataFrame, parts: int) -> DataFrame:
    """(doc_id, run): runs of windows that stand in a smaller document too; first window * 256 + length."""

    def match(rows: list[list]) -> Iterator[pa.RecordBatch]:
        known, rows = [r for r in rows if r[2] is None], [r for r in rows if r[2] is not None]
        found = [tuple(np.frombuffer(x, np.int64) for x in r[:2]) for r in known]
        if rows:
            docs, firsts = (np.concatenate([np.frombuffer(r[i], np.int64) for r in rows]) for i in (0, 1))
            numbers = np.concatenate([np.frombuffer(r[2], np.uint8) for r in rows]).astype(np.int64)
            joined = np.concatenate([np.frombuffer(r[3], np.uint8) for r in rows])
            found.append(settle_windows((docs, firsts, numbers, joined))[0])
        columns = [pa.array(np.concatenate(x), pa.int64()) for x in zip(*found, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "run"])

    def meet(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in iterator:
            for part, *row in zip(*(batch.column(c).to_pylist() for c in CONTEXTS.names), strict=True):
                if part != current and rows:
                    yield from match(rows)
                    rows = []
                current = part
                rows.append(row)
        if rows:
            yield from match(rows)

    dealt = contexts.repartition(parts, "part").sortWithinPartitions("part")
    return map_batches(dealt, meet, "doc_id long, run long")


def covered(runs: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal stretches of bytes that the windows of the runs cover."""
    starts = np.sort(runs)
    out: list[tuple[int, int]] = []
    for run in starts.tolist():
        a, b = run >> 8, min(size, (run >> 8) + (run & 255) + LENGTH - 1)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def repeated_passages(docs: DataFrame, batches: int | None = None, heavy: int = HEAVY) -> DataFrame:
    """(doc_id, whole, runs): whole is true for later copies of an equal text; runs as in matched_windows."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", "text", F.xxhash64(text).alias("owner"), F.octet_length(text).alias("size"))
    digest = F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")
    hashed = docs.select("doc_id", F.xxhash64(text).alias("owner"), digest, F.octet_length(text).alias("size"))
    owners = hashed.groupBy("owner", "digest").agg(F.min("doc_id").alias("first"), F.max("size").alias("size"), F.count("*").alias("times"))
    owners = durable(owners)
    size = owners.agg(F.sum("size")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // DENSITY // PART + 1)
    batches = batches or max(LEAST_BATCHES, (size // BATCH_BYTES).bit_length())
    keys = reported_anchors(named.filter(F.col("size") >= LENGTH), batches, parts, heavy)
    release(spark)
    wanted = keys.join(owners, "owner").select(F.col("first").alias("doc_id"), "owner", "keys", "heavy")
    firsts = named.join(wanted, ["doc_id", "owner"])
    runs = matched_windows(suffix_contexts(firsts, parts), parts)
    runs = durable(runs.groupBy("doc_id").agg(F.collect_set("run").alias("runs")))
    release(spark)
    several = owners.filter((F.col("times") > 1) & (F.col("size") >= LENGTH)).select("owner", "digest", "first")
    copies = hashed.drop("size").join(several, ["owner", "digest"]).filter(F.col("doc_id") > F.col("first"))
    copies = copies.select("doc_id", F.lit(True).alias("whole")).distinct()
    return runs.join(copies, "doc_id", "full").select("doc_id", F.coalesce("whole", F.lit(False)).alias("whole"), "runs")


def _cut_rows(iterator: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in iterator:
        rows = []
        for text, whole, runs in zip(text_bytes(batch), batch.column("whole").to_pylist(), batch.column("runs"), strict=True):
            spans = [(0, len(text))] if whole else covered(runs.values.to_numpy(zero_copy_only=False), len(text)) if runs.is_valid else []
            kept, at = [], 0
            for a, b in spans:
                kept.append(text[at:a])
                at = b
            rest = b"".join([*kept, text[at:]])
            row = (len(text), len(text) - len(rest), len(spans), hashlib.sha256(rest).hexdigest())
            rows.append((*row, rest) if with_text else row)
        if rows:
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])]
            columns = [batch.column("doc_id"), *(pa.array(c) for c in map(list, zip(*rows, strict=True)))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names])


def suffix_dedup(docs: DataFrame, batches: int | None = None, with_text: bool = False, heavy: int = HEAVY) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) and, on demand, `kept`: the remaining bytes."""
    found = repeated_passages(docs, batches, heavy)
    joined = docs.select("doc_id", "text").join(found, "doc_id", "left")
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text

    def cut(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _cut_rows(iterator, with_text)

    return map_batches(joined, cut, columns)


def op4_suffix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))
