"""Connected components by alternating star operations (DataFrame joins and group-bys)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.stage import Stages


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step on edges (u > v).

    Large: each vertex ties its larger neighbours to the least of its neighbourhood.
    Small: each vertex ties its smaller neighbours and itself to the least of them.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = tied.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame, stages: Stages) -> DataFrame:
    """``(id, root)`` for every id in ``links(a, b)`` that is not its component's least id.

    Only vertices other than the root are returned, so an unlinked id has no row.
    Every step is a group-by with map-side minimum and an equi-join; no vertex's
    neighbours are gathered.  Ends when the edge set no longer changes.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stages.cut(edges, "edges")
    seen = None
    while True:
        nxt = stages.cut(_star(_star(edges, True), False), "edges")
        stages.drop(edges)
        edges = nxt
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        seen = mark
