"""Connected components of an edge table by alternating large and small stars.

Each round replaces edges by edges to the smallest neighbour seen and is written to the shared folder, so a lost
executor costs that round alone. Smallest neighbours are partial minima before the shuffle; a hub's edges are
dealt out by adaptive execution. Rounds grow with the logarithm of a component's length. Nothing is collected but
two numbers that tell whether a round still changed anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import settle


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component_id (smallest node reachable) of every node on an edge (u, v); null ends are left out."""
    now = settle(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while (mark := _mark(now)) != before and mark[0]:
        before = mark
        now = settle(_small_star(_large_star(now)))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
    return settle(now.select(F.col("u").alias("node"), F.col("v").alias("component_id")).unionByName(roots))
