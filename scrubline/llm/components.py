"""Connected components of a link table, as Spark jobs.

Alternates the two star operations (every vertex hands its neighbours to the
smallest vertex it sees) until nothing changes. Each round is two aggregations
and joins over the links, staged under the shared folder; the driver only learns
whether it has settled. Links must be pairs of non-null longs; self-links,
repeated links and an empty table are fine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: link neighbours above a vertex to its smallest neighbour
    (itself included). Small star: the vertex and its neighbours below it."""
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = both.join(low, "a")
    if large:
        new = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        new = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("a", F.col("m").alias("b")))
    return new.filter("a <> b").distinct()


def connected(links: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """(id, component): every vertex that has a link, with the smallest id that
    it can reach. ``links`` has the columns a and b."""
    cur = links.filter("a <> b").select("a", "b")
    for _ in range(max_rounds):
        cur = stage(_star(_star(cur, large=True), large=False), label)
        # Settled when every vertex has one link, to a vertex that has none: then
        # all point at the smallest vertex of their component.
        ends = cur.select(F.col("a").alias("v"), F.lit(1).alias("up")).union(
            cur.select("b", F.lit(0)))
        count = ends.groupBy("v").agg(F.sum("up").alias("up"), F.min("up").alias("low"))
        if count.filter("up > 1 or (up = 1 and low = 0)").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        cur.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
