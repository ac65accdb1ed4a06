"""The raw wide feed over the TPC-H-like tables.

The published feed is not distributed with its code, so orders and their lines stand in for it: a
customer is a municipality, a nation a state, an order status a jurisdiction and a return flag a sex.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.reference import INDICATOR_DDL, Reference
from tallystar.schema import COUNT, RAW_COLUMNS, VICTIM, WEIGHT

# (indicator, family, unit, kind)
FEED_INDICATORS = (
    ("LINE ECONOMY", VICTIM, "units", "Line - Low price"),
    ("LINE LARGE", VICTIM, "units", "Line - By size"),
    ("LINE MEDIUM", VICTIM, "units", "Line - By size"),
    ("LINE PROMO", VICTIM, "units", "Line - Low price"),
    ("LINE SMALL", VICTIM, "units", "Line - By size"),
    ("LINE STANDARD", VICTIM, "units", "Plain line"),
    ("ORDER 1-URGENT", COUNT, "orders", "Fast order"),
    ("ORDER 2-HIGH", COUNT, "orders", "Fast order"),
    ("ORDER 3-MEDIUM", COUNT, "orders", "Order - Medium"),
    ("ORDER 4-NOT SPECIFIED", COUNT, "orders", "Order - Open"),
    ("ORDER 5-LOW", COUNT, "orders", "Order - Low"),
    ("VALUE PRIORITY", WEIGHT, "currency", "Value"),
    ("VALUE STANDARD", WEIGHT, "currency", "Value"),
)
FEED_GROUP_RULES = (
    ("starts", "Line", "Lines"),
    ("equals", "Fast order", "Fast orders"),
    ("starts", "Order", "Orders"),
    ("equals", "Value", "Values"),
)
FEED_OTHER_GROUP = "Other"

# How often a count is not reported, or reported as zero: by order key, as in the survey of the feed.
NOT_REPORTED_EVERY, ZERO_EVERY = 50, 7


def feed_reference(spark: SparkSession, sf_dir: str) -> Reference:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    return Reference(
        indicators=spark.createDataFrame(list(FEED_INDICATORS), INDICATOR_DDL),
        regions=nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_name").alias("state"), F.col("r_name").alias("region")
        ),
        group_rules=FEED_GROUP_RULES,
        other_group=FEED_OTHER_GROUP,
        state_code_length=None,
        year_bounds=(1900, 2100),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw columns plus `source_year`, one row per order line and two per order."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")

    placed = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            "o_orderpriority",
            "o_totalprice",
            "c_mktsegment",
            F.col("n_name").alias("state"),
            F.col("c_name").alias("municipality"),
            F.trunc("o_orderdate", "month").cast("timestamp").alias("ref_month"),
            F.col("o_orderstatus").alias("jurisdiction"),
            F.year("o_orderdate").alias("source_year"),
        )
    )

    kind, flag, quantity = F.col("p_type"), F.col("l_returnflag"), F.col("l_quantity")
    # Parts first: where they are too many to broadcast, lines are shuffled by part before the order's texts are added.
    sold = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_quantity", "l_returnflag", "l_linestatus", "p_type", "p_size"
    )
    lines = (
        sold.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumns(
            {
                "indicator": F.concat(F.lit("LINE "), kind),
                "agent": F.when(kind == "SMALL", F.col("c_mktsegment")),
                "weapon": F.when(kind == "PROMO", F.col("l_linestatus")),
                "age_band": F.when(kind == "ECONOMY", F.when(F.col("p_size") <= 25, "S").otherwise("L")),
                "female": F.when(flag == "A", quantity),
                "male": F.when(flag == "R", quantity),
                "unknown_sex": F.when(flag == "N", quantity),
                "victim_total": quantity,
                "count_value": F.lit(None).cast("double"),
                "weight_value": F.lit(None).cast("double"),
            }
        )
        .select(*RAW_COLUMNS, "source_year")
    )

    # Two rows per order from one pass: its count and its value.
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    counted = F.when(F.col("o_orderkey") % NOT_REPORTED_EVERY != 0, F.when(F.col("o_orderkey") % ZERO_EVERY == 0, 0.0).otherwise(1.0))
    nothing = F.lit(None).cast("double")
    entries = F.array(
        F.struct(
            F.concat(F.lit("ORDER "), "o_orderpriority").alias("indicator"),
            counted.alias("count_value"),
            nothing.alias("weight_value"),
        ),
        F.struct(
            F.when(urgent, "VALUE PRIORITY").otherwise("VALUE STANDARD").alias("indicator"),
            nothing.alias("count_value"),
            F.col("o_totalprice").alias("weight_value"),
        ),
    )
    absent_text = {c: F.lit(None).cast("string") for c in ("agent", "weapon", "age_band")}
    absent_number = {c: nothing for c in ("female", "male", "unknown_sex", "victim_total")}
    per_order = placed.withColumns(absent_text | absent_number).select("*", F.inline(entries)).select(*RAW_COLUMNS, "source_year")
    return lines.unionByName(per_order)
