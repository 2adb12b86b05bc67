"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  last: bool = False) -> DataFrame:
    """Keep the first (or last) row of each key by `order`; the other columns break
    ties, so the result does not depend on partitioning.

    Done as min/max of a struct: every task reduces a key to one row before the
    shuffle, so a key that holds a large part of all rows costs no single task more
    than its own input. A ranking window would sort that whole key in one place."""
    rest = [c for c in df.columns if c not in keys]
    entry = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                     *[F.col(c) for c in rest])
    pick = (F.max if last else F.min)(entry).alias("_pick")
    return (df.groupBy(*keys).agg(pick)
              .select(*[F.col(c) if c in keys else F.col(f"_pick.`{c}`").alias(c)
                        for c in df.columns]))


def nulls_last(c: Column) -> list[Column]:
    """Order expressions that put null after every value."""
    return [c.isNull(), c]
