"""Connected components by alternating large and small stars.

Edges shrink to stars around each component's smallest node in a logarithmic
number of rounds. Every round is a partial aggregate and a join on a salted
key, written to the shared folder; nothing is collected but a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SALTS = 16


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """(u, v) rows joined with m, the least v of their u. A node may hold most
    of the edges, so the join key carries a salt of the other end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return (edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
            .join(least.withColumn("salt", salts), ["u", "salt"]))


def _large_stars(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _least_neighbour(both).filter("v > u")
    return linked.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_stars(edges: DataFrame) -> DataFrame:
    linked = _least_neighbour(edges)
    pairs = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    return pairs.unionByName(linked.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns u > v) that is not
    the smallest of its component, which is the root. No edges: no rows."""
    edges = written(edges.select("u", "v"), label)
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        edges = written(_small_stars(written(_large_stars(edges), label)), label)
