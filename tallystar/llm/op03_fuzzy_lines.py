"""Fuzzy line deduplication by MinHash, with DataFrame functions only.

Two lines are near-duplicates when the Jaccard similarity of their sets of SHINGLE-character shingles (a shorter
line is one shingle) is at least THRESHOLD. Of each component of such lines, the occurrence that comes first by
(doc_id, line number) is kept. Lines of white space are no candidates and stay.

1. Equal lines meet by their md5; from here on there is one row per different line.
2. Signature: each shingle of a line (of code points, whichever plane they are of) is hashed, and each hash falls into one
   of BINS bins; the smallest hash of every bin is a MinHash (one permutation). Shingles are rows that are
   aggregated as they come, so a line of any length needs a fixed amount of memory.
3. Banding: the bins stand in a square of SIDE rows and columns; the minima of each row and of each column make one key.
   Lines with a key in common are first linked with the smallest and the largest line of that key.
4. Lines with a shared key get a sketch, a bitmap of their shingles that excludes most pairs which are no near-duplicates. The
   true similarity of the others is computed from both lines' full shingle sets.
5. Union-find over the confirmed pairs. Under keys whose lines lie in several components, the lines outside the key's
   largest component are then compared in the same way with HUBS lines and with all lines of other components, so that
   no pair with a key in common is left out.
6. All occurrences but the first of a component are removed.

Banding is a filter of high recall, the steps after it are exact; pairs are left out early only by bounds that lose none.
Shingle sets are compared as sets of 64-bit hashes. Defined cases: a null text has no lines and stays
null; an empty text is one line of white space. Equal doc_ids count as one document's lines with equal numbers
and are treated alike. Extra columns pass through unchanged. Very long lines are shingled whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.common import durable, release, table
from tallystar.llm.graph import components
from tallystar.storage import run_dir

SHINGLE = 8
THRESHOLD = 0.75
CODE_POINT = 4  # bytes in UTF-32
SIDE = 4  # minima of a band key
BINS = SIDE * SIDE
BIN_SHIFT = 59  # 63 bits of hash, the upper four are the bin
DEPTH = 3
EMPTY = 4  # a line with more different shingles than DEPTH * BINS has so many empty bins once in a thousand times
WORDS = 32  # of 64 bits in a sketch
SHINGLES_PER_WORD = 16  # at most, or the sketch excludes little: a line of more shingles has a second one of fitting width
MAX_WIDE = 1 << 16  # words of a second sketch
HUBS = 8
WIDE = "wide: array<bigint>, wide_spare: int, half: array<bigint>, half_spare: int"
SKETCH = "struct<n: int, spare: int, " + ", ".join(f"w{i}: bigint" for i in range(WORDS)) + f", {WIDE}>"
BLOCK = 256  # lines of a key that meet in one place
BROADCAST_BYTES = 64 << 20  # candidate lines' ids up to this size are sent to all executors
ID_BYTES = 64  # one id in a broadcast table, generously


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, line, id): every line that is not white space."""
    every = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return every.filter(F.col("line").rlike(r"\S")).withColumn("id", F.unhex(F.md5("line")))


def _start_of_shingles(raw: Column) -> Column:
    """The byte, from 1, at which each shingle of a UTF-32 text starts; a short text is one shingle."""
    last = F.length(raw) - CODE_POINT * SHINGLE + 1
    return F.sequence(F.lit(1), F.greatest(last, F.lit(1)), F.lit(CODE_POINT))


def _hash_at(raw: Column, start: Column) -> Column:
    """The 63-bit hash of the shingle there."""
    return F.xxhash64(F.substring(raw, start, F.lit(CODE_POINT * SHINGLE))).bitwiseAND(F.lit((1 << 63) - 1))


def shingle_hashes(line: Column) -> Column:
    """The set of a line's shingles, as an array of hashes. The text is bound to a name, so that it is encoded once."""
    raw = F.array(F.encode(line, "UTF-32"))
    every = F.transform(raw, lambda x: F.transform(_start_of_shingles(x), lambda i: _hash_at(x, i)))
    return F.array_distinct(F.get(every, F.lit(0)))


def signed(lines: DataFrame, key: str, whole: bool = False) -> DataFrame:
    """(key, bands, weak) of each different line: one key of each band of bins that has a minimum.

    Of a long line only hashes in the lowest part of their bin are aggregated: so large a part that DEPTH different
    hashes of a bin are expected there. If the minimum of two lines' union lies above it, the bin is empty for both,
    which agrees as well. A line of few different shingles may have too many empty bins; it is `weak` and has to be
    signed again as a `whole`.
    """
    raw = lines.select(key, F.encode("line", "UTF-32").alias("raw"))
    starts = raw.withColumn("start", F.explode(_start_of_shingles(F.col("raw"))))
    starts = starts.withColumn("windows", F.length("raw") / CODE_POINT - SHINGLE + 1)
    hashes = starts.select(key, "start", "windows", _hash_at(F.col("raw"), F.col("start")).alias("h"))
    in_bin = F.col("h").bitwiseAND(F.lit((1 << BIN_SHIFT) - 1))
    low = F.lit(whole) | (in_bin * F.col("windows") <= float(DEPTH * BINS << BIN_SHIFT))
    # The first shingle's row stands for the line, whatever its hash is.
    rows = hashes.filter(low | (F.col("start") == 1)).select(
        key, F.when(low, F.col("h")).alias("h"), (F.col("windows") > DEPTH * BINS).cast("int").alias("cut"),
        F.when(low, F.shiftright("h", BIN_SHIFT)).alias("bin"),
    )
    names = [f"m{i}" for i in range(BINS)]
    minima = rows.groupBy(key).agg(F.max("cut").alias("cut"), *[F.min(F.when(F.col("bin") == i, F.col("h"))).alias(m) for i, m in enumerate(names)])
    across = [names[SIDE * i : SIDE * (i + 1)] for i in range(SIDE)]
    down = [list(column) for column in zip(*across)]
    keys = [
        F.when(F.coalesce(*band).isNotNull(), F.xxhash64(F.lit(i), *[F.coalesce(m, F.lit(-1)) for m in band]))
        for i, band in enumerate(across + down)
    ]
    empty = sum((F.col(m).isNull().cast("int") for m in names), F.lit(0))
    weak = ~F.lit(whole) & (F.col("cut") == 1) & (empty > EMPTY)
    return minima.select(key, F.array_compact(F.array(*keys)).alias("bands"), weak.alias("weak"))


def _near(one: str, other: str) -> Column:
    """Whether near-duplicates are possible; a bound that follows from the similarity and loses no pair.

    A bit that only one bitmap has stands for at least one shingle that only this line has. So the lines share at most
    as many shingles as bits, and the `spare` shingles of either line that found their bit set already. Long lines are then
    compared in the same way by their wide bitmaps; of two widths the larger one is halved.
    """
    x, y = F.col(one), F.col(other)

    def enough(shared: Column) -> Column:
        return F.coalesce((1 + THRESHOLD) * shared >= THRESHOLD * (x["n"] + y["n"]), F.lit(True))

    in_common = sum((F.bit_count(x[f"w{i}"].bitwiseAND(y[f"w{i}"])) for i in range(WORDS)), F.lit(0))

    def fitting(own: Column, against: Column, name: str) -> Column:
        return F.when(F.size(own["wide"]) > F.size(against["wide"]), own[f"half{name}"]).otherwise(own[f"wide{name}"])

    both = F.zip_with(fitting(x, y, ""), fitting(y, x, ""), lambda v, w: F.bit_count(v.bitwiseAND(w)))
    wide_in_common = F.aggregate(both, F.lit(0), lambda total, bits: total + bits)
    spares = F.least(fitting(x, y, "_spare"), fitting(y, x, "_spare"))
    return enough(in_common + F.least(x["spare"], y["spare"])) & enough(wide_in_common + spares)


def _popcount(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda total, word: total + F.bit_count(word))


def sketched(texts: DataFrame) -> DataFrame:
    """(num, sketch) of (num, line): the number of different shingles, WORDS * 64 bits of them, wide bitmaps of long lines."""
    place = F.shiftright("h", 40).bitwiseAND(F.lit(63).cast("long")).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    zero = F.lit(0).cast("long")

    hashed = texts.select("num", shingle_hashes(F.col("line")).alias("h"))
    rows = hashed.select("num", F.size("h").alias("n"), F.explode("h").alias("h")).withColumn("bit", bit)
    word = F.col("h").bitwiseAND(F.lit(WORDS - 1).cast("long"))
    words = {f"w{i}": F.coalesce(F.bit_or(F.when(word == i, F.col("bit"))), zero) for i in range(WORDS)}
    maps = rows.groupBy("num").agg(F.first("n").alias("n"), *[bits.alias(w) for w, bits in words.items()])
    spare = F.col("n") - sum((F.bit_count(w) for w in words), F.lit(0))

    # Width by length: shingles that occur twice only make it wider than it has to be.
    width = F.least(F.lit(MAX_WIDE), F.pow(F.lit(2), F.ceil(F.log2(F.char_length("line") / SHINGLES_PER_WORD)))).cast("long")
    long_lines = texts.filter(F.char_length("line") > WORDS * SHINGLES_PER_WORD).withColumn("width", width)
    set_bits = long_lines.select("num", "width", F.explode(shingle_hashes(F.col("line"))).alias("h"))
    set_bits = set_bits.select("num", F.col("h").bitwiseAND(F.col("width") - 1).alias("word"), bit.alias("bit"))
    no_bits = long_lines.select("num", F.explode(F.sequence(zero, F.col("width") - 1)).alias("word"), zero.alias("bit"))
    wide = set_bits.unionByName(no_bits).groupBy("num", "word").agg(F.bit_or("bit").alias("bits")).groupBy("num")
    wide = wide.agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("wide"))
    middle = (F.size("wide") / 2).cast("int")
    half = F.zip_with(F.slice("wide", 1, middle), F.slice("wide", middle + 1, middle), lambda v, w: v.bitwiseOR(w))
    wide = wide.withColumn("half", half)

    found = maps.join(wide, "num", "left")
    spares = [spare.cast("int").alias("spare"), *words]
    spares += [c for name in ("wide", "half") for c in (F.col(name), (F.col("n") - _popcount(F.col(name))).alias(f"{name}_spare"))]
    return found.select("num", F.struct("n", *spares).alias("sketch"))


def possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) that the sketches of their lines do not exclude."""
    both = pairs.join(sketches.toDF("a", "s"), "a", "left").join(sketches.toDF("b", "t"), "b", "left")
    return both.filter(_near("s", "t")).select("a", "b")


def distinct_lines(lines: DataFrame) -> DataFrame:
    """One row per different line: number, id, first occurrence, how often, bands, weak."""
    places = lines.groupBy("id").agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.count("*").alias("times"))
    return places.join(signed(lines, "id"), "id").withColumn("num", F.monotonically_increasing_id())


def shared_bands(distinct: DataFrame) -> DataFrame:
    """(key, num, low, high) of every band key that two lines have."""
    rows = distinct.select("num", F.explode("bands").alias("key"))
    ends = rows.groupBy("key").agg(F.min("num").alias("low"), F.max("num").alias("high")).filter("low < high")
    return rows.join(ends, "key")


def star_pairs(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of line numbers: each line with the smallest and the largest line of its band keys."""
    to_low = F.when(F.col("num") != F.col("low"), F.col("low"))
    to_high = F.when(F.col("num") != F.col("high"), F.col("high"))
    pairs = shared.select("num", F.explode(F.array(to_low, to_high)).alias("other")).filter("other IS NOT NULL")
    return pairs.select(F.least("num", "other").alias("a"), F.greatest("num", "other").alias("b")).distinct()


def open_rows(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, num, component, main, blocks, other_blocks) of the band keys whose lines lie in several components.

    `main` is the component with the most lines of the key; blocks are counted for all lines and for those outside it.
    """
    rows = shared.select("key", "num").join(groups.withColumnRenamed("id", "num"), "num", "left")
    rows = rows.withColumn("component", F.coalesce("component", "num"))
    sizes = rows.groupBy("key", "component").agg(F.count("*").alias("lines"))
    ends = [F.count("*").alias("parts"), F.sum("lines").alias("lines"), F.max(F.struct("lines", "component")).alias("most")]
    several = sizes.groupBy("key").agg(*ends).filter("parts > 1")
    counts = {"blocks": F.col("lines"), "other_blocks": F.col("lines") - F.col("most.lines")}
    blocks = [F.ceil(n / BLOCK).cast("int").alias(name) for name, n in counts.items()]
    return rows.join(several.select("key", F.col("most.component").alias("main"), *blocks), "key")


def hub_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of open lines outside the main component with HUBS lines of their keys, chosen by hash.

    They unite most of what belongs together.
    """
    hub = F.struct("num", "component")
    hubs = rows.groupBy("key").agg(F.array_distinct(F.array(*[F.min_by(hub, F.xxhash64("num", F.lit(i))) for i in range(HUBS)])).alias("hubs"))
    met = rows.filter("component <> main").join(hubs, "key").withColumn("hub", F.explode("hubs"))
    met = met.filter(F.col("component") != F.col("hub.component"))
    return met.select(F.least("num", "hub.num").alias("a"), F.greatest("num", "hub.num").alias("b")).distinct()


def remaining_pairs(rows: DataFrame, done: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of open lines with a band in common that are not among `done` and lie in different components.

    One line of such a pair lies outside the main component, so these lines meet all lines of their key. Both are dealt into
    blocks of BLOCK, and each pair of blocks is a join key of its own. With `known` (num, line, sketch, bands) of every line the
    pairs are confirmed where they meet, under the smallest key that they share, so that only links become rows.
    """
    open_ = rows if known is None else rows.join(known, "num")

    def dealt(lines: DataFrame, own: str, other: str, block: str, met: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("num"), F.col(own)).cast("int").alias(block)
        lines = lines.select("*", mine, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(met))
        return lines.drop("blocks", "other_blocks")

    def side(lines: DataFrame, suffix: str) -> DataFrame:
        return lines.withColumnsRenamed({c: f"{c}_{suffix}" for c in lines.columns if c not in ("key", "i", "j")})

    left = side(dealt(open_.filter("component <> main"), "other_blocks", "blocks", "i", "j"), "a")
    right = side(dealt(open_, "blocks", "other_blocks", "j", "i"), "b")
    # Two lines outside the main component meet twice.
    wanted = (F.col("component_a") != F.col("component_b")) & ((F.col("component_b") == F.col("main_b")) | (F.col("num_a") < F.col("num_b")))
    if known is not None:
        here = F.col("key") == F.array_min(F.array_intersect("bands_a", "bands_b"))
        wanted = wanted & here & _near("sketch_a", "sketch_b") & _alike("line_a", "line_b")
    met = left.join(right, ["key", "i", "j"]).filter(wanted)
    pairs = met.select(F.least("num_a", "num_b").alias("a"), F.greatest("num_a", "num_b").alias("b")).distinct()
    return pairs.join(done, ["a", "b"], "left_anti")


def texts_of(wanted: DataFrame, distinct: DataFrame, lines: DataFrame) -> DataFrame:
    """(num, line) of the wanted numbers, read again at the lines' first places."""
    wanted = durable(distinct.select("num", "id", "first").join(wanted, "num", "left_semi"))
    named = wanted.select("num", "id", F.col("first.doc_id").alias("doc_id"), F.col("first.pos").alias("pos"))
    if wanted.count() * ID_BYTES <= BROADCAST_BYTES:
        named = F.broadcast(named)
    # By place first: the hash is needed for the few lines found there.
    places = lines.select("doc_id", "pos", "line")
    same = [places["doc_id"].eqNullSafe(named["doc_id"]), places["pos"] == named["pos"]]
    texts = places.join(named, same).filter(F.unhex(F.md5("line")) == F.col("id")).select("num", "line").dropDuplicates(["num"])
    return durable(texts)


def _alike(one: str, other: str) -> Column:
    """Whether the shingle sets of two lines have the demanded Jaccard similarity."""
    # Bound to a name, so that the sets are made once for each pair.
    sets = F.array(F.struct(shingle_hashes(F.col(one)).alias("x"), shingle_hashes(F.col(other)).alias("y")))
    alike = F.transform(
        sets,
        lambda s: (1 + THRESHOLD) * F.size(F.array_intersect(s["x"], s["y"])) >= THRESHOLD * (F.size(s["x"]) + F.size(s["y"])),
    )
    return F.get(alike, F.lit(0))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose shingle sets have the demanded Jaccard similarity."""
    left, right = texts.toDF("a", "line_a"), texts.toDF("b", "line_b")
    return pairs.join(left, "a").join(right, "b").filter(_alike("line_a", "line_b")).select("a", "b")


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos) of every line that goes."""
    root = run_dir(docs.sparkSession, "lines")
    lines = lines_of(docs)
    distinct_lines(lines).write.parquet(f"{root}/distinct")
    distinct = docs.sparkSession.read.parquet(f"{root}/distinct")
    weak = texts_of(distinct.filter("weak").select("num"), distinct, lines)
    again = durable(signed(weak, "num", whole=True)).select("num", "bands")
    shared = durable(shared_bands(distinct.filter("NOT weak").select("num", "bands").unionByName(again)))
    texts = texts_of(shared.select("num"), distinct, lines)
    sketches = durable(sketched(texts))
    stars = durable(possible(star_pairs(shared), sketches))
    links = durable(confirmed(stars, texts))
    rows = durable(open_rows(shared, components(links)))
    release(docs.sparkSession)
    if not rows.isEmpty():
        hubs = durable(possible(hub_pairs(rows), sketches))
        links = links.unionByName(durable(confirmed(hubs, texts)))
        rows = open_rows(rows, components(links))
        bands = shared.groupBy("num").agg(F.collect_list("key").alias("bands"))
        known = texts.join(sketches, "num").join(bands, "num")
        links = durable(links.unionByName(remaining_pairs(rows, stars.unionByName(hubs), known)))
        release(docs.sparkSession)
    groups = components(links)
    known = distinct.select("num", "id", "first", "times").join(groups.withColumnRenamed("id", "num"), "num", "left")
    heads = known.filter("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("kept"))
    kept = known.join(heads, "component", "left").withColumn("kept", F.coalesce("kept", "first"))
    # Lines that stand once and have no near-duplicate stay, whatever else happens.
    repeated = kept.filter((F.col("times") > 1) | F.col("component").isNotNull()).select("id", "kept")
    found = lines.drop("line").join(repeated, "id")
    here = F.struct("doc_id", "pos")
    return found.filter(~here.eqNullSafe(F.col("kept"))).select("doc_id", "pos")


def fuzzy_line_dedup(docs: DataFrame) -> DataFrame:
    """`docs` with the near-duplicate lines taken out of `text`; all rows and columns stay."""
    gone = removed_lines(docs).groupBy("doc_id").agg(F.collect_set("pos").alias("_gone")).withColumnRenamed("doc_id", "_doc")
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    rest = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("_gone", i))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    return joined.withColumn("text", text).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage."""
    return fuzzy_line_dedup(docs)


def op3_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many of them go, and their numbers from 0."""
    docs = table(spark, sf_dir, "documents")
    gone = removed_lines(docs).groupBy("doc_id").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    counted = docs.select("doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    joined = counted.join(gone, "doc_id", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    numbers = F.array_join(F.col("gone").cast("array<string>"), ",")
    return joined.select("doc_id", "n_lines", F.size("gone").cast("long").alias("n_removed"), numbers.alias("removed_lines"))
