"""Connected components by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import discard, written


def _met(rows: DataFrame, least: DataFrame, parts: int) -> DataFrame:
    """rows (u, v) with m of their u. A node with very many edges meets its m once for each part of them (of one part: at once)."""
    if parts == 1:
        return rows.join(least, "u")
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(parts)))
    return dealt.join(dealt.select("u", "part").distinct().join(least, "u"), ["u", "part"])


def _large_star(e: DataFrame, parts: int) -> DataFrame:
    """Every neighbour above a node is joined to the node's least neighbour."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _met(both.filter("v > u"), least, parts).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame, parts: int) -> DataFrame:
    """Every neighbour below a node, and the node, are joined to the least of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    lower = _met(e, least, parts).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id and component (the least id reachable) of every id that has an edge to another. A few rounds, each written; sums by node are taken before rows meet, and a node with very many edges is met in parts."""
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    e = written(edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).filter("u > v").distinct(), "edges")
    mark, parts = None, max(1, 32 * (e.count() >> 20))  # a million edges of one node are no burden
    while True:
        new = written(_small_star(_large_star(e, parts).distinct(), parts).distinct(), "edges")
        discard(e)
        e = new
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("u", "v"), 20))).first())
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
