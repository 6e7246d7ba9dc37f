"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize

FILE_LINKS = 2_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction round over (a, b) with a > b."""
    near = edges.union(edges.select("b", "a")).toDF("a", "b") if large else edges
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = near.join(least, "a")
    if large:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
    out = out.where("a <> b")
    return out if large else out.distinct()     # a small round follows each large one and drops its repeats too


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; component is its smallest reachable node.

    Each round is written to the shared folder, so the plan stays short and a lost executor costs one
    round. Links with a null end are ignored.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull()).where("a <> b").distinct()
    edges = materialize(edges, "links")
    before = None
    while True:
        sums = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before is not None and tuple(sums) == before:
            break
        before = tuple(sums)
        # a round has at most as many links as the one before; files hold a bounded number of them
        edges = materialize(_star(_star(edges, True), False).coalesce(1 + sums[0] // FILE_LINKS), "links")
    # every edge now leads from a node to its smallest one
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
