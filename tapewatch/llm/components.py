"""Connected components by alternating large and small stars; no node's neighbours are ever gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewatch.llm.common import Scratch


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``u, v`` for every node of ``edges`` (``u, v`` longs) but the least of its component: ``v`` is that least one."""
    ordered = edges.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = scratch.put(ordered.distinct())
    state = _state(now)
    while state[0]:
        stars = scratch.put(_large_star(now).distinct())
        after = scratch.put(_small_star(stars))
        changed = _state(after)
        scratch.drop(now, stars)
        now = after
        if changed == state:
            break
        state = changed
    return now
