"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import salted_join
from tickweave.plans.session import saved


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def stars(edges: DataFrame, tag: str = "stars") -> DataFrame:
    """(u, v): v is the smallest node of u's component, for every node u that isn't it.

    edges: u, v of one ordered type, without nulls. Each round is two shuffles of the edges and a table in the
    shared folder; the rounds grow with the logarithm of the longest path. A hub's edges are salted. Nothing but
    a count and a checksum a round comes to the driver.
    """
    edges = saved(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), tag)
    before = _mark(edges)
    while before[0]:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
        large = salted_join(both, least, "u", F.col("v")).filter("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        large = saved(large, tag)
        least = large.groupBy("u").agg(F.min("v").alias("_m"))
        small = salted_join(large, least, "u", F.col("v")).select("u", "v", "_m")
        small = small.select("u", F.col("_m").alias("v")).unionByName(small.filter("v <> _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))).distinct()
        edges = saved(small, tag)
        now = _mark(edges)
        if now == before:
            break
        before = now
    return edges
