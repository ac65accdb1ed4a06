"""Sharding by balanced label propagation.

Documents with equal texts are linked. Every document starts in the shard that its place in doc_id order gives
it. Then, round after round, linked documents look at the shards their group has most members in and move
there, as far as the quota of that shard lets them; documents without links, which lose nothing by moving, make
room. At the end the shards have the same number of rows, to one.

* A group larger than half a shard is dealt by hash into parts of about that size, each a unit of its own:
  one shard could not hold it. Links within a unit are a star, never all pairs.
* A round is one aggregation (unit, shard) -> members with map-side sums, and one join of the linked documents
  with their unit's target, salted for large units. Only linked documents take part.
* Quotas: the flows between shards are summed before a round takes effect; where more documents want in than
  the shard has room for, a share of whole units, chosen by hash, may move.
* The last step puts the rows of every shard in order, linked units first; rows beyond the quota fill the
  shards below theirs. That also numbers the slots.

Law `rows`: counts differ by one at most. Defined cases: a null text is its own kind of text, of 0 bytes and crc
0, and equal to other nulls. Ties between shards go to the one smallest by hash of unit and shard. Repeated rows
are rows of their own. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.common import durable, number_within, table

SHARDS = 24
OVERHEAD = 8
ROUNDS = 6
SALT_ROWS = 10_000  # rows of a unit that meet its target in one join key


def _linked(docs: DataFrame, shards: int) -> tuple[DataFrame, int]:
    """Rows (doc_id, size, text_crc32, unit, salts, shard): unit is null without links; and their number."""
    text = F.col("text").cast("binary")
    facts = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.md5(text), F.lit("null")).alias("text_key"),
    )
    numbered = durable(number_within(facts.withColumn("_all", F.lit(0)), ["_all"], ["doc_id", "text_key"], "number"))
    rows = numbered.count()
    half = max(1, rows // shards // 2)
    groups = numbered.groupBy("text_key").agg(F.count("*").alias("members")).filter("members > 1")
    parts = F.ceil(F.col("members") / half)
    spread = F.greatest(F.lit(1), F.ceil(F.least(F.col("members"), F.lit(half)) / SALT_ROWS))
    groups = groups.select("text_key", parts.alias("parts"), spread.cast("int").alias("salts"))
    linked = numbered.join(groups, "text_key", "left").select(
        "doc_id",
        "size",
        "text_crc32",
        "number",
        F.when(F.col("parts").isNotNull(), F.xxhash64("text_key", F.pmod(F.xxhash64("number"), "parts"))).alias("unit"),
        "salts",
        F.pmod("number", F.lit(shards)).cast("int").alias("shard"),
    )
    return linked, rows


def _pick(values: dict[int, float], key: Column, default: float) -> Column:
    """A number per shard as an expression."""
    whole = F.array(*[F.lit(float(values.get(s, default))) for s in range(max(values, default=0) + 1)])
    return F.coalesce(F.get(whole, key), F.lit(float(default)))


def _share(*members: str | Column) -> Column:
    return F.pmod(F.xxhash64(*members), F.lit(1 << 20)) / float(1 << 20)


def propagate(linked: DataFrame, quota: int, rounds: int, shards: int) -> DataFrame:
    """Move linked rows towards their unit's most frequent shard, within the quotas.

    A shard takes linked rows up to `quota`, counting those that want to leave it as gone; rows without links
    make room at the end. The driver sees one sum per pair of shards.
    """
    for turn in range(rounds):
        counts = linked.groupBy("unit", "shard").agg(F.count("*").alias("members"), F.max("salts").alias("salts"))
        counts = durable(counts)
        order = F.struct(F.col("members"), F.xxhash64("unit", "shard"))
        targets = counts.groupBy("unit").agg(F.max_by("shard", order).alias("target"), F.max("salts").alias("salts"))
        flows = counts.drop("salts").join(targets, "unit").groupBy("shard", "target").agg(F.sum("members").alias("n")).collect()
        there, wanted, leaving = ({s: 0 for s in range(shards)} for _ in range(3))
        for flow in flows:
            there[flow["shard"]] += flow["n"]
            if flow["shard"] != flow["target"]:
                wanted[flow["target"]] += flow["n"]
                leaving[flow["shard"]] += flow["n"]
        if not any(wanted.values()):
            break
        room = {s: max(0, quota - there[s] + leaving[s]) for s in range(shards)}
        admit = {s: min(1.0, room[s] / wanted[s]) if wanted[s] else 1.0 for s in range(shards)}
        # Whole units are let in or not, so that none is torn by its quota.
        let_in = _share("unit", F.lit(turn)) < _pick(admit, F.col("target"), 1.0)
        chosen = targets.filter(let_in).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        salted = linked.withColumn("salt", F.pmod(F.xxhash64("number"), F.col("salts")).cast("int"))
        moved = salted.join(chosen.select("unit", "salt", "target"), ["unit", "salt"], "left")
        linked = durable(moved.withColumn("shard", F.coalesce("target", "shard")).drop("salt", "target"))
    return linked


def _fit(ranked: DataFrame, there: dict[int, int], quotas: dict[int, int]) -> DataFrame:
    """Rows beyond a shard's quota, taken from its end, fill the shards below theirs; slots stay gapless."""
    over, offset = {}, 0
    for shard, quota in quotas.items():
        over[shard] = offset
        offset += max(0, there.get(shard, 0) - quota)
    gaps = [(s, max(0, q - there.get(s, 0)), there.get(s, 0)) for s, q in quotas.items()]
    surplus = F.col("rank") - _pick(quotas, F.col("shard"), 0) + _pick(over, F.col("shard"), 0)
    new_shard, new_slot, start = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for shard, gap, filled in gaps:
        if gap:
            here = (F.col("surplus") >= start) & (F.col("surplus") < start + gap)
            new_shard = F.when(here, F.lit(shard)).otherwise(new_shard)
            new_slot = F.when(here, F.col("surplus") - start + filled).otherwise(new_slot)
            start += gap
    stays = F.col("rank") < _pick(quotas, F.col("shard"), 0)
    ranked = ranked.withColumn("surplus", surplus.cast("long"))
    return ranked.select(
        "*",
        F.when(stays, F.col("shard")).otherwise(new_shard).cast("int").alias("_shard"),
        F.when(stays, F.col("rank")).otherwise(new_slot).cast("long").alias("slot"),
    ).drop("shard", "rank", "surplus").withColumnRenamed("_shard", "shard")


def balanced_labels(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of `docs` with its shard and slot; shard sizes in rows differ by one at most."""
    prepared, rows = _linked(docs, shards)
    prepared = durable(prepared)
    linked, single = prepared.filter("unit IS NOT NULL"), prepared.filter("unit IS NULL")
    linked = propagate(linked, rows // shards, rounds, shards)
    placed = linked.select(*prepared.columns).unionByName(single).withColumn("_single", F.col("unit").isNull())
    ranked = durable(number_within(placed, ["shard"], ["_single", "unit", "number"], "rank"))
    there = {r["shard"]: r["count"] for r in ranked.groupBy("shard").count().collect()}
    # The shards that hold most take the rows that do not divide evenly.
    by_size = sorted(range(shards), key=lambda s: (-there.get(s, 0), s))
    more = set(by_size[: rows % shards])
    quotas = {s: rows // shards + (s in more) for s in range(shards)}
    return _fit(ranked, there, quotas).select("doc_id", "size", "text_crc32", "shard", "slot", "unit")


def op1_balanced_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = balanced_labels(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
