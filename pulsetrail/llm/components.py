"""Connected components of a graph of any size and shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.workspace import stage


def components(edges: DataFrame, label: str) -> DataFrame:
    """Each node of ``edges`` (a, b) with ``root``, the smallest node it can reach.

    Two steps take turns until nothing changes: every node hands its larger neighbours to its smallest
    one, then its smaller neighbours. Both are a minimum per node, taken before the shuffle, and a join
    that Spark splits where a node has very many neighbours. The rounds follow the logarithm of the
    longest path. Each round is written, so a lost executor costs no more than the round at work.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = stage(edges.select(high, low).filter("a <> b").distinct(), f"{label}-edges")
    seen = _state(now)
    while seen[0]:
        now = stage(_to_smaller(_to_larger(now)), f"{label}-edges")
        before, seen = seen, _state(now)
        if seen == before:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _to_larger(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _to_smaller(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    handed = edges.join(least, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return handed.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
