"""Connected components by alternating large and small stars, on DataFrames; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import discard, materialize

#: Rows of an edge table for each of its partitions, so that small graphs don't run as many empty tasks.
ROWS = 50_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node that it reaches) of every node with a link. Links are pairs of longs; their
    order, repeats and links of a node with itself don't matter.

    Each join has two plain shuffled sides, which adaptive execution splits where a node has very many links. Edges
    never grow in number, and the tables of a round are deleted after the next."""
    u, v = F.col("u"), F.col("v")
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(u > v).distinct(), "edges")
    state = _state(edges)
    parts = -(-state[0] // ROWS) or 1
    while True:
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts), "least")
        large = both.join(least, "u").where(v > u).select(v.alias("u"), F.least(u, "m").alias("v"))
        large = materialize(large.where(u != v).distinct().coalesce(parts), "large")
        discard(edges, least)
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts), "least")
        small = large.join(least, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct().coalesce(parts), "small")
        discard(large, least)
        now = _state(edges)
        if now == state:
            break
        state = now
    out = edges.select(F.col("u").alias("node"), v.alias("component")).unionByName(edges.select(v.alias("node"), v.alias("component")).distinct())
    out = materialize(out.coalesce(parts), "components")
    discard(edges)
    return out
