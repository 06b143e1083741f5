"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.llm.common import Scratch


def _sum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every linked node, the root being the smallest node of its component.

    Alternates the large-star and the small-star step (Kiveris et al., 2014): every edge is
    replaced by one to the smallest neighbour, until nothing changes, in a number of rounds
    that grows with the logarithm of the longest path. The smallest neighbours are written
    before they are joined, so that both sides of the join are plain shuffles and AQE can
    split a node with very many links.
    """

    def star(edges: DataFrame, name: str, large: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
        joined = both.join(scratch.stored(least, f"{name}-least"), "u")
        if large:
            out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        else:
            moved = F.array(F.struct(F.col("v").alias("u"), F.col("least").alias("v")), F.struct("u", F.col("least").alias("v")))
            out = joined.select(F.explode(moved).alias("e")).select("e.*").where("u <> v")
        return scratch.stored(out.groupBy("u", "v").agg(F.lit(1).alias("one")).drop("one"), name)

    # an edge runs from the larger node u to the smaller node v
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    edges, turn = scratch.stored(edges.distinct(), "star0"), 0
    before = _sum(edges)
    while before[0]:
        turn += 1
        edges = star(star(edges, f"large{turn}", True), f"small{turn}", False)
        after = _sum(edges)
        if after == before:
            break
        before = after
    return scratch.stored(
        edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("root")), F.struct(F.col("v").alias("node"), F.col("v").alias("root")))).alias("r")).select("r.*").distinct(),
        "roots",
    )
