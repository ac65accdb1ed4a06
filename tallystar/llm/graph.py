"""Connected components by alternating stars: a distributed union-find on a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import durable


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("v", "u") % 1000003).alias("s"))
    return tuple(row.first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in links (a, b); a component is named by its smallest id.

    Links are kept as (u, v), u > v. A large star links all greater neighbours of a vertex with its smallest
    neighbour, a small star does so with its smaller ones; both keep components and bring every vertex closer to
    the smallest one, until nothing changes: O(log^2) rounds at most. Each round is two aggregations with
    map-side minimum and two joins of links with these minima, whose hot keys adaptive execution splits.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = durable(edges)
    before = _digest(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = durable(large)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = durable(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        after = _digest(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    heads = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return members.unionByName(heads)
