"""Connected components of a link table, by alternating star contractions on the cluster.

Both sides of every join are already dealt by the join key, and a graph has no
size bound, so sides are merged and never broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour; ``u`` is the larger node, also in the result."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to its smallest neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    ends = F.explode(F.array("v", "u"))
    tied = edges.join(least.hint("merge"), "u").select(ends.alias("u"), F.col("m").alias("v"))
    return tied.where("u > v").distinct()


def _written(edges: DataFrame, name: str) -> tuple[DataFrame, dict]:
    """``u, v`` as a written table, and the number and digest of its rows."""
    watched = Observation()
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return cut_lineage(edges.observe(watched, F.count(F.lit(1)).alias("n"), digest.alias("digest")), name), watched.get


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``u, v`` links; the label is the component's smallest node.

    Links with a null end or of a node with itself are ignored; repeated
    links count once; no links give no rows.  Each round is a written table,
    so a lost executor costs one round at most.  Links that are stars already,
    such as labels found before, take one round.
    """
    tied = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges, state = _written(tied.distinct(), "links")
    seen = None
    while state != seen:
        seen = state
        large = cut_lineage(_large_star(edges), "large-stars")  # both uses of it in the next step would run its joins
        edges, state = _written(_small_star(large), "stars")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
