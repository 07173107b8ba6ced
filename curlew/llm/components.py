"""Connected components of an edge table by alternating large-star and small-star rounds, all on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.llm.workspace import Workspace


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    star = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return star.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """edges (u long, v long) -> (node, component): for every node of an edge, the smallest node it reaches.

    Each round is two grouped minima joined back to the edges; the rounds are logarithmic in the number of nodes, and each
    is written to the shared folder. Rows with a null end and loops are ignored; an empty table gives an empty table.
    """
    now = ws.write(_small_star(edges.filter("u <> v")), "star")
    seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while seen[0]:
        new = ws.write(_small_star(_large_star(now)), "star")
        ws.drop(now)
        now, last, seen = new, seen, new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
