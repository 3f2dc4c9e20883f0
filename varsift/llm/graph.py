"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varsift.llm.storage import written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hang each node's larger (large star) or smaller (small star) neighbours on its smallest one."""
    if small:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = near.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
    hung = near.join(low.hint("rebalance"), "u")  # so that a hub's neighbours can be split over tasks
    if small:
        moved = hung.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            low.select("u", F.col("low").alias("v")))
    else:
        moved = hung.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.where("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node; component is the smallest node of its component.

    Each round is written to the shared folder, so a lost executor costs one round. Rounds grow with the
    logarithm of the longest chain of links. Hot nodes: counts are partial sums, joins are skew-splittable.
    """
    edges = written(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "links")
    mark = None
    while True:
        edges = written(_star(_star(edges, False), True), "stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = now
