"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work, cut


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u > v): neighbours hook onto the least node of the neighbourhood.

    The least neighbour comes from an aggregation with map-side minima and a join, so no task gathers a
    node's neighbours. Edges in one partition are never shuffled.
    """
    both_ways = lambda u1, v1, u2, v2: F.explode(F.array(F.struct(F.col(u1).alias("u"), F.col(v1).alias("v")), F.struct(F.col(u2).alias("u"), F.col(v2).alias("v"))))
    if large:  # every neighbour above the node hooks on
        both = edges.select(both_ways("u", "v", "v", "u").alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # the neighbours below the node, and the node
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(both_ways("v", "m", "u", "m").alias("e")).select("e.*")
    return out.where("u <> v").distinct()


def components(links: DataFrame, work: Work | None = None, most_rounds: int = 60) -> DataFrame:
    """node, root (least node of its component) for every node that has links. links: u, v (long)."""
    spark = links.sparkSession
    with Work(spark, "stars") as own:
        edges, n = own.sized(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
        sign = None
        for _ in range(most_rounds):
            last, sign = sign, (n, edges.agg(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()[0])
            if sign == last or not n:
                named = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), "v").distinct())
                named = named.select(F.col("u").alias("node"), F.col("v").alias("root"))
                return work.sized(named)[0] if work else cut(named)
            before = edges
            edges, n = own.sized(star(star(edges, True), False))
            own.drop(before)
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")


def joined(roots: DataFrame, links: DataFrame, n: int, work: Work) -> DataFrame:
    """Components (node, root) after n more links (u, v), by the components of the roots that these link."""
    if not n:
        return roots
    ends = links.select("u", "v")
    for c in ("u", "v"):
        ends = ends.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")), c, "left")
    ends = work.sized(ends.select("u", "v", F.coalesce("ru", "u").alias("ru"), F.coalesce("rv", "v").alias("rv")))[0]
    merged = components(ends.select(F.col("ru").alias("u"), F.col("rv").alias("v")), work)
    nodes = roots.unionByName(ends.select(F.col("u").alias("node"), F.col("ru").alias("root"))).unionByName(ends.select(F.col("v").alias("node"), F.col("rv").alias("root"))).distinct()
    out = nodes.join(merged.select(F.col("node").alias("root"), F.col("root").alias("new")), "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    return work.sized(out)[0]
