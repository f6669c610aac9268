"""Connected components of a graph given by its edges, without gathering any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrace.llm.store import Kept, keep, release


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (u, v)``: the smallest node that it reaches.

    Large and small stars in turns: every node links its neighbours to the smallest of them, until nothing
    changes. Minima are combined before their shuffle; the joins back to the edges are ordinary
    sort-merge joins, whose large partitions Spark splits when one node has most edges. The edges are
    written once a round, so a lost executor costs one round at most. An edge with a NULL end counts for
    nothing; no edges give an empty result.
    """
    now = Kept(edges.select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v"))
               .filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct(), "edges")
    before = None
    while True:
        state = now.read().agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        after = Kept(_small_star(_large_star(now.read())), "edges")
        now.drop()
        release(now.spark, 0)
        now = after
    stars = now.read()
    return keep(stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
                .unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct(), "stars")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
