"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above u is linked to the smallest of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its neighbours below u are linked to the smallest of them (u > v in ``edges``)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, label of every id that occurs in the links (u, v): label is the component's smallest id.

    Links to itself and repeated ones are allowed. All steps are equi joins and minima that
    combine map-side; the number of rounds grows with the logarithm of the links.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    while True:
        edges = materialise(_small_star(_large_star(edges)), "components")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before or not now[0]:
            break
        before = now
    # a star forest: every other id points to the smallest one
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
