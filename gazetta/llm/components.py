"""Connected components by alternating large-star and small-star.

Stars are built with a grouped minimum and a join, never with a list of a
node's neighbours, so a node with very many links is no single task's work.
Each step is written to the shared folder; the driver sees two numbers a step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gazetta.llm.util import materialise


def _written(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The edges, written, with their number and an order-free checksum (summed
    up while they are written)."""
    seen = Observation()
    low = F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 32) - 1))
    edges = materialise(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(low).alias("sum")), name)
    return edges, (seen.get["n"], seen.get["sum"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v) that is not its own root;
    the root is the smallest node of the component. Self links and repeated
    links are ignored; no links give an empty result."""
    edges, before = _written(links.where("u <> v").select("u", "v").distinct(), "links")
    while before[0]:
        edges, after = _written(_small_star(_large_star(edges)), "stars")
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
