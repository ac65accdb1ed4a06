"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

1. Texts become tokens: words, numbers, ends of sentences. Numbers and capitalised words within a sentence become
   typed placeholders; a unit after a number belongs to the number, and a run of one placeholder (Mary Ann) is one
   slot. Other words are lower-cased.
2. Windows of WINDOW canonical tokens with at least LITERAL literal words are hashed, for benchmark items and for
   documents, and hash-joined. An item that is shorter is one window of its own length.
3. Windows of an item that stand in a document at shifts (differences of positions) within DRIFT of each other belong
   to one alignment, so words that were put in, left out or changed cut an item into pieces but do not lose it. Its
   coverage is the share of the item's tokens that lie in such windows.
4. From COVERAGE of the tokens and LEAST_TOKENS tokens on, the slots within the matched windows are compared: an
   alignment is consistent when every value that a slot has in the item stands for one value in the document. So
   copies, and questions with other numbers, names or units, are caught, while texts that share only the scaffold
   are not.

A document is contaminated when an alignment of an item is consistent. A passage of an item is found if it holds
COVERAGE of its tokens and at least LEAST_TOKENS (all of a shorter item).

The window table of the benchmark is broadcast if its counted size is below BROADCAST_BYTES; else the join is
shuffled. Defined cases: null or empty texts and items have no windows and are never contaminated or found; items
without LITERAL literal words cannot be told from chance and are never found. Items with equal texts are each
reported. Rows of one doc_id are judged together; documents with a null doc_id are judged each and have no row in
the result. Extra columns pass through; repeated rows are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.common import durable, table
from tallystar.storage import run_dir

WINDOW = 5
LITERAL = 3
COVERAGE = 0.45
LEAST_TOKENS = 10
DRIFT = 12  # tokens that may be put in or left out
RUN = 4  # tokens of a slot that are compared
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64  # of a broadcast row, generously

TOKEN = r"\p{L}[\p{L}\p{M}]*|[0-9]+(?:[.,][0-9]+)*|[.!?\n]"
ENDS = [".", "!", "?", "\n"]
# Units that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec min h hr hrs day days week weeks month months year years "
    "hour hours minute minutes second seconds meter meters metre metres kilometer kilometers mile miles gram grams "
    "kilogram kilograms liter liters litre litres dollar dollars euro euros cent cents percent usd eur gbp mph kmh"
).split()
NUMBER, NAME = "<num>", "<name>"
PLACEHOLDERS = [NUMBER, NAME]


def _is_number(w: Column) -> Column:
    return (w >= "0") & (w < ":")


def _is_name(w: Column) -> Column:
    """Capitalised, and not all capitals."""
    first = F.substring(w, 1, 1)
    capital = (w >= "A") & ((w < "[") | ((w >= "\u0080") & (first != F.lower(first))))
    return capital & (w != F.upper(w))


def canonical(docs: DataFrame, key: str) -> DataFrame:
    """(key, raw, canon): tokens in canonical form and what each stands for, without ends of sentences."""
    raw = docs.select(key, F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)).alias("every"))

    def form(w: Column, i: Column) -> Column:
        before = F.get("every", i - 1)
        unit = F.lower(w).isin(UNITS) & _is_number(before)
        name = _is_name(w) & (i > 0) & ~before.isin(ENDS)
        return (
            F.when(w.isin(ENDS), F.lit(None))
            .when(_is_number(w) | unit, F.lit(NUMBER))
            .when(name, F.lit(NAME))
            .otherwise(F.lower(w))
        )

    formed = raw.withColumn("canon", F.transform("every", form))
    words = F.filter("every", lambda w: ~w.isin(ENDS))
    kept = formed.select(key, words.alias("w"), F.filter("canon", lambda c: c.isNotNull()).alias("c"))

    def slot_starts(c: Column, i: Column) -> Column:
        return (i == 0) | ~c.isin(PLACEHOLDERS) | (c != F.get("c", i - 1))

    def said(i: Column) -> Column:
        """The token at i; of a slot its first RUN tokens."""
        own = F.get("c", i)
        same = [F.when(own == F.get("c", i + k), F.get("w", i + k)) for k in range(1, RUN)]
        run = F.concat_ws(" ", F.get("w", i), *[F.when(F.forall(F.array(*same[:k]), lambda x: x.isNotNull()), same[k - 1]) for k in range(1, RUN)])
        return F.lower(F.when(own.isin(PLACEHOLDERS), run).otherwise(F.get("w", i)))

    places = F.filter(
        F.transform("c", lambda c, i: F.when(slot_starts(c, i), i)), lambda i: i.isNotNull()
    )
    placed = kept.withColumn("at", places)
    return placed.select(
        key,
        F.transform("at", said).alias("raw"),
        F.transform("at", lambda i: F.get("c", i)).alias("canon"),
    )


def windows(tokens: DataFrame, key: str, width: int) -> DataFrame:
    """(key, pos, h) of every window of `width` tokens that has enough literal words."""
    starts = F.when(F.size("canon") >= width, F.sequence(F.lit(1), F.size("canon") - width + 1))

    def hashed(i: Column) -> Column:
        window = F.slice("canon", i, width)
        literal = F.size(F.filter(window, lambda c: ~c.isin(PLACEHOLDERS)))
        return F.when(literal >= min(LITERAL, width), F.xxhash64(window))

    return tokens.select(key, F.posexplode(F.transform(starts, hashed)).alias("pos", "h")).filter("h IS NOT NULL")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() * ROW_BYTES <= BROADCAST_BYTES else df


def alignments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, shift, width, matched, coverage): windows of an item, as (at, pos), around a shift of a document."""
    item_tokens = durable(canonical(items, "item_id").filter(F.size("canon") > 0))
    widths = [r["w"] for r in item_tokens.select(F.least(F.size("canon"), F.lit(WINDOW)).alias("w")).distinct().orderBy("w").collect()]
    doc_tokens = canonical(docs, "doc_id")
    sizes = item_tokens.select("item_id", F.size("canon").alias("tokens"))
    found = None
    for width in widths:  # one, but for items shorter than a window
        own = item_tokens.filter(F.size("canon") == width if width < WINDOW else F.size("canon") >= WINDOW)
        own = durable(windows(own, "item_id", width).withColumnRenamed("pos", "at"))
        hits = windows(doc_tokens, "doc_id", width).join(_small(own), "h")
        # Two grids of shifts, so that shifts up to DRIFT apart share a cell of one of them.
        cell = F.floor((F.col("pos") - F.col("at")) / DRIFT)
        celled = hits.select("doc_id", "item_id", "at", "pos", F.explode(F.array(cell, cell + 1)).alias("shift"))
        # Of the places of a window the first, so an alignment holds each window of the item once.
        once = celled.groupBy("doc_id", "item_id", "shift", "at").agg(F.min("pos").alias("pos"))
        aligned = once.groupBy("doc_id", "item_id", "shift").agg(F.array_sort(F.collect_list(F.struct("at", "pos"))).alias("matched"))
        aligned = aligned.withColumn("width", F.lit(width))
        found = aligned if found is None else found.unionByName(aligned)
    if found is None:
        empty = docs.select("doc_id").limit(0)
        kinds = {"item_id": "long", "shift": "long", "width": "int", "matched": "array<struct<at:int,pos:int>>", "coverage": "double"}
        return empty.select("doc_id", *[F.lit(None).cast(k).alias(c) for c, k in kinds.items()])
    # A window adds the tokens that the one before it does not hold.
    added = F.transform(
        "matched", lambda m, i: F.when(i == 0, F.col("width")).otherwise(F.least(m["at"] - F.get("matched", i - 1)["at"], F.col("width")))
    )
    covered = F.aggregate(added, F.lit(0), lambda s, x: s + x)
    judged = found.join(sizes, "item_id").withColumn("covered", covered).withColumn("coverage", F.col("covered") / F.col("tokens"))
    enough = (F.col("coverage") >= COVERAGE) & (F.col("covered") >= F.least(F.col("tokens"), F.lit(LEAST_TOKENS)))
    return judged.filter(enough).select("doc_id", "item_id", "shift", "width", "matched", "coverage")


def consistent(aligned: DataFrame, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The alignments whose slots are consistent, with `exact`: every slot has the item's own value."""
    ids = _small(aligned.select("doc_id").distinct())
    some_docs = canonical(docs.join(ids, "doc_id", "left_semi"), "doc_id").toDF("doc_id", "doc_raw", "doc_canon")
    some_items = canonical(items, "item_id")
    both = aligned.join(some_items, "item_id").join(some_docs, "doc_id")

    def of_window(m: Column) -> Column:
        """Values of the slots of a matched window, in item and document."""

        def pair(k: Column) -> Column:
            i, j = m["at"] + k, m["pos"] + k
            slot = F.get("canon", i).isin(PLACEHOLDERS)
            return F.when(slot, F.struct(F.get("raw", i).alias("item"), F.get("doc_raw", j).alias("doc")))

        return F.transform(F.sequence(F.lit(0), F.col("width") - 1), pair)

    pairs = F.filter(F.flatten(F.transform("matched", of_window)), lambda p: p.isNotNull())
    paired = both.withColumn("pairs", F.array_distinct(pairs))
    values = F.array_distinct(F.transform("pairs", lambda p: p["item"]))
    exact = F.forall("pairs", lambda p: p["item"] == p["doc"])
    judged = paired.filter(F.size(values) == F.size("pairs")).withColumn("exact", exact)
    return judged.select("doc_id", "item_id", "shift", "coverage", "exact")


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, coverage, exact) of every item that a document holds."""
    items = items.filter("item_id IS NOT NULL AND text IS NOT NULL")
    docs = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
    aligned = durable(alignments(docs, items))
    found = consistent(aligned, docs, items)
    return found.groupBy("doc_id", "item_id").agg(F.max("coverage").alias("coverage"), F.max("exact").alias("exact"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows that hold a benchmark item go, each judged by its own text, whatever its id."""
    root = run_dir(spark, "rows")
    docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)], F.monotonically_increasing_id().alias("row")).write.parquet(root)
    numbered = spark.read.parquet(root)
    own = {c: F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)}
    rows = numbered.select(F.col("row").alias("doc_id"), own["text"])
    found = durable(contaminated(rows, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("row")).distinct())
    return numbered.join(_small(found), "row", "left_anti").select(*own.values())


def op9_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = contaminated(docs, items).groupBy("doc_id").agg(
        F.count("*").alias("n_items"),
        F.array_join(F.transform(F.array_sort(F.collect_set("item_id")), lambda i: i.cast("string")), ",").alias("items"),
        F.max("coverage").alias("coverage"),
        F.max("exact").alias("exact"),
    )
    joined = docs.select("doc_id").join(found, "doc_id", "left")
    return joined.select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.lit("")).alias("items"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("exact", F.lit(False)).alias("exact"),
    )
