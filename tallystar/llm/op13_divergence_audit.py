"""How far the sources of a language differ in their words, by bitmaps of the terms that occur a given number of times.

Terms that enough documents of a language use get dense numbers, the most used first, in blocks of BITS. For every
group (language, source) and block, the terms that occur exactly c times there form one bitset, so a block holds one
row per group and count. Two sources' bitsets, ANDed and counted, give the number of terms that occur a times in one
and b times in the other: their joint cells. A cell's terms all add the same f(p, q), so a pair's divergence is the
sum of cell size times f. Cells with a zero count follow by complement, from the sizes of the rows and of the block.

Words are counted per task before they are shuffled. A block of a language is compared in tiles of TILE sources, so
one task holds at most 2 * TILE * BITS bitsets at a time, however many sources and terms there are. The result itself
has a row for every pair of sources.

p = 1 + floor(10^9 (count + 2) / (N + 2 V)), f = floor((p - q)^2 / (p + q)), all in whole numbers.

Defined cases: null text, lang and source are ''. A group without kept terms has N = 0; a language without kept terms
gives 0 for every pair and no terms. Repeated rows count as documents of their own. Extra columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystar.llm.common import durable, map_batches, number_within, table, text_bytes

MIN_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 10**9
WORD_BITS = 64
WORDS = 4
BITS = WORDS * WORD_BITS
TILE = 64  # sources
HELD = 300_000  # different (language, source, term) a task holds before it hands them on

# Letters and everything beyond ASCII, as UTF-8 bytes.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
COUNT_SCHEMA = "lang string, source string, term string, n long, docs long"
COUNT_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _count(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term, per group, summed within the task; the empty term marks a group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in held.items():
            terms = list(times)
            columns = [
                pa.repeat(pa.scalar(lang, pa.string()), len(terms)),
                pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(times.values(), pa.int64(), size=len(terms)),
                pa.array([docs[t] for t in terms], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=COUNT_ARROW)
        held.clear()

    for batch in iterator:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, text_bytes(batch), strict=True):
            times, docs = held.setdefault((lang, source), (Counter({b"": 0}), Counter()))
            found = TERM.findall(text.lower())
            times.update(found)
            docs.update(set(found))
        if sum(len(times) for times, _ in held.values()) >= HELD:
            yield from handed_on()
    yield from handed_on()


def term_counts(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, lang_n) of the kept terms; each group also has a row of the empty term.

    Tasks have summed their rows, so those of a term are at most sources x tasks. They meet once, by (lang, term):
    the sums per group and over the language follow without another shuffle.
    """
    filled = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    met = map_batches(filled, _count, COUNT_SCHEMA).repartition("lang", "term")
    summed = met.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    everywhere = Window.partitionBy("lang", "term")
    return (
        summed.withColumns({"lang_n": F.sum("n").over(everywhere), "lang_docs": F.sum("docs").over(everywhere)})
        .filter((F.col("lang_docs") >= min_documents) | (F.col("term") == ""))
        .select("lang", "source", "term", "n", "lang_n")
    )


def probability(count: Column, total: Column, kept: Column) -> Column:
    """p of a term; the product may exceed 64 bits and is a decimal. Without kept terms p is not asked for."""
    share = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + 2), total + 2 * kept)
    return F.when(kept > 0, 1 + share).otherwise(1).cast("long")


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pairs(iterator: Iterator[pa.RecordBatch], tile: int) -> Iterator[pa.RecordBatch]:
    """Sums of f over one block's joint cells, for the pairs of one pair of tiles.

    The rows of a part come sorted by (lang, block, low, high), so a group is one run of rows.
    """
    run: list[pa.RecordBatch] = []
    known = None
    for batch in iterator:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "block", "low", "high")), strict=True))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if known is not None and keys[a] != known:
                yield _block_pairs(run, known, tile)
                run = []
            known = keys[a]
            run.append(batch.slice(a, b - a))
    if known is not None:
        yield _block_pairs(run, known, tile)


PAIR_SCHEMA = "lang string, one int, other int, value long"
PAIR_ARROW = pa.schema([("lang", pa.string()), ("one", pa.int32()), ("other", pa.int32()), ("value", pa.int64())])


def _block_pairs(run: list[pa.RecordBatch], key: tuple[str, int, int, int], tile: int) -> pa.RecordBatch:
    lang, _, low, high = key
    rows = pa.Table.from_batches(run)
    column = {c: rows.column(c).to_numpy() for c in ("number", "n", "p", "size")}
    bits = np.stack([rows.column(f"w{i}").to_numpy() for i in range(WORDS)], axis=1).view(np.uint64)
    order = np.lexsort((column["n"], column["number"]))
    column, bits = {c: v[order] for c, v in column.items()}, bits[order]
    sizes = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    numbers, first = np.unique(column["number"], return_index=True)
    ends = [*first[1:], len(bits)]
    block = int(column["size"][0])

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    found: dict[str, list] = {c: [] for c in PAIR_ARROW.names}
    for i, one in enumerate(numbers):
        # The row of count 0 comes first in each source; it has no bits, and the p of a term that is absent.
        a0, a = first[i], slice(first[i] + 1, ends[i])
        for j in range(i + 1, len(numbers)):
            other = numbers[j]
            if (one // tile, other // tile) != (low, high):
                continue
            b0, b = first[j], slice(first[j] + 1, ends[j])
            p, q, p0, q0 = column["p"][a], column["p"][b], column["p"][a0], column["p"][b0]
            joint = np.zeros((len(p), len(q)), np.int64)
            for w in range(WORDS):
                joint += np.bitwise_count(bits[a, w][:, None] & bits[b, w][None, :])
            only_a, only_b = sizes[a] - joint.sum(axis=1), sizes[b] - joint.sum(axis=0)
            neither = block - int(joint.sum()) - int(only_a.sum()) - int(only_b.sum())
            value = int((joint * f(p[:, None], q[None, :])).sum())
            value += int((only_a * f(p, q0)).sum()) + int((only_b * f(p0, q)).sum()) + neither * int(f(p0, q0))
            for name, x in zip(PAIR_ARROW.names, (lang, one, other, value), strict=True):
                found[name].append(x)
    return pa.RecordBatch.from_pydict(found, schema=PAIR_ARROW)


def vocabulary(counts: DataFrame) -> DataFrame:
    """(lang, term, n, id): kept terms with their occurrences in the language and a dense number, most used first."""
    kept = counts.filter("term <> ''").groupBy("lang", "term").agg(F.max("lang_n").alias("n"))
    return number_within(kept.withColumn("by", -F.col("n")), ["lang"], ["by", "term"], "id").drop("by")


def count_levels(of_groups: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, number, block, n, p, w0..): the bitset of the terms that occur n times in a group, per block of terms."""
    word, bit = F.floor(F.col("id") % BITS / WORD_BITS), (F.col("id") % WORD_BITS).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    sets = [F.bit_or(F.when(word == w, one).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in range(WORDS)]
    blocks = F.floor(F.col("id") / BITS).cast("int").alias("block")
    levels = of_groups.groupBy("lang", "number", blocks, "n", "p").agg(*sets)
    # Every group stands in every block, with the count 0; a language without terms has one empty block.
    last = F.greatest(F.floor((F.col("kept") - 1) / BITS), F.lit(0))
    absent = groups.select(
        "lang", "number", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("block"), F.lit(0).cast("long").alias("n"),
        probability(F.lit(0), F.col("total"), F.col("kept")).alias("p"),
        *[F.lit(0).cast("long").alias(f"w{w}") for w in range(WORDS)],
    )
    return levels.unionByName(absent)


def source_divergence(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS, tile: int = TILE
) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source of the language, and the terms a group favours."""
    counts = durable(term_counts(docs, min_documents))
    terms = durable(vocabulary(counts))
    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    numbered = number_within(counts.filter("term = ''").select("lang", "source"), ["lang"], ["source"], "number")
    used = counts.filter("term <> ''").select("lang", "source", "term", F.col("n").alias("count"), F.col("lang_n").alias("lang_count"))
    totals = used.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = durable(
        numbered.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang", "source", F.col("number").cast("int").alias("number"),
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "kept", "lang_total")],
        )
    )
    of_groups = durable(
        used.join(terms.select("lang", "term", "id"), ["lang", "term"])
        .join(groups, ["lang", "source"])
        .select(
            "lang", "source", "number", "term", "id", F.col("count").alias("n"),
            probability(F.col("count"), F.col("total"), F.col("kept")).alias("p"),
            probability(F.col("lang_count"), F.col("lang_total"), F.col("kept")).alias("q"),
        )
    )

    sizes = groups.groupBy("lang").agg((F.max("number") + 1).alias("sources"), F.max("kept").alias("kept"))
    own = F.floor(F.col("number") / tile).cast("int")
    last = F.floor((F.col("sources") - 1) / tile).cast("int")
    met = F.transform(F.sequence(F.lit(0), last), lambda t: F.struct(F.least(t, own).alias("low"), F.greatest(t, own).alias("high")))
    size = F.least(F.col("kept") - F.col("block") * BITS, F.lit(BITS)).cast("long")
    placed = (
        count_levels(of_groups, groups)
        .join(sizes, "lang")
        .select("lang", "number", "block", "n", "p", *[f"w{w}" for w in range(WORDS)], size.alias("size"), F.explode(met).alias("met"))
        .select("*", "met.*")
        .drop("met")
    )
    keys = ["lang", "block", "low", "high"]
    summed = map_batches(placed.repartition(*keys).sortWithinPartitions(*keys), partial(_pairs, tile=tile), PAIR_SCHEMA)
    sums = summed.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))
    both = sums.select(
        "lang", "value", F.explode(F.array(F.struct(F.col("one").alias("number"), F.col("other")), F.struct(F.col("other").alias("number"), F.col("one").alias("other")))).alias("pair")
    ).select("lang", "value", "pair.*")
    names = groups.select("lang", "number", "source")
    others = names.select("lang", F.col("number").alias("other"), F.col("source").alias("item"))
    pairs = both.join(names, ["lang", "number"]).join(others, ["lang", "other"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    favoured = of_groups.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value")
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    return pairs.withColumn("rank", rank).unionByName(favoured.withColumn("rank", rank).filter(F.col("rank") <= top_terms))


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))
