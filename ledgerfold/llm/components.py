"""Connected components of an undirected graph given as edges, by alternating stars.

Each round hangs neighbours to their smallest neighbour, first the larger ones, then the
smaller ones, until nothing changes; the number of rounds grows with the logarithm of the
longest path. Every round is written to the shared folder, which cuts its lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerfold.llm.store import stored


def _least(edges: DataFrame) -> DataFrame:
    """Edges u > v with the smallest vertex among u and its listed neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    return edges.join(least, "u").withColumn("low", F.least("u", "low"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, component): the smallest vertex reachable, for each vertex that has an edge."""
    one: Column = F.greatest(a, b).alias("u")
    now = stored(edges.where(F.col(a) != F.col(b)).select(one, F.least(a, b).alias("v")).distinct())
    before = _state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").distinct()
        low = _least(large)
        now = stored(low.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(low.select("u", F.col("low").alias("v"))).where("u != v").distinct())
        after = _state(now)
        if after == before:
            break
        before = after
    found = now.groupBy("u").agg(F.min("v").alias("v"))
    roots = found.select(F.col("v").alias("u")).distinct().withColumn("v", F.col("u"))
    return found.unionByName(roots).select(F.col("u").alias("vertex"), F.col("v").alias("component"))
