"""Connected components by alternating large-star and small-star rounds on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stage


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the bigint edges (u, v), root being the least node
    it reaches. Edges may repeat or be loops; only nodes with an edge are returned.
    Each round writes its edges to the shared folder; nothing is collected."""
    edges = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(edges)
    for _ in range(rounds):
        if not before[0]:
            break
        last, edges = edges, stage(_small_star(_large_star(edges)))
        discard(last)
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("connected components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
