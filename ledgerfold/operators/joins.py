"""Joins to a side with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_unique(left: DataFrame, right: DataFrame, on: Sequence[tuple[Column, str]],
                how: str) -> DataFrame:
    """Join to a frame that an aggregation reduced to one row per key. `on` pairs a
    left expression with a right column; the right key columns do not come along.

    The planner broadcasts the right side only while its size is known to be small.
    Otherwise both sides shuffle, and one key may hold a large part of the left rows.
    Adaptive execution splits such a partition only if both sides come straight from
    a shuffle; a right side still partitioned by its own aggregation would prevent
    that. Matching on a hash of the keys as well makes it shuffle for the join."""
    names = [name for _, name in on]
    mine = [f"_l{name}" for name in names]
    # Keys are columns before the join, so each expression is computed once.
    keyed = left.withColumns({m: expr for m, (expr, _) in zip(mine, on)})
    keyed = keyed.withColumn("_lhash", F.xxhash64(*mine))
    hashed = right.withColumn("_hash", F.xxhash64(*names))
    match = [F.col(m) == F.col(n) for m, n in zip([*mine, "_lhash"], [*names, "_hash"])]
    return keyed.join(hashed, match, how).drop(*mine, *names, "_lhash", "_hash")
