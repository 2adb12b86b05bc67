"""Keyed upsert: replace by key group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_unique


def text_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys compared as text; null and empty are the same key."""
    return df.select(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_k{i}")
                       for i, k in enumerate(keys)]).distinct()


def without_keys(df: DataFrame, keys: Sequence[str], removed: DataFrame) -> DataFrame:
    """Rows whose key is not among the removed ones."""
    match = [(F.coalesce(F.col(k).cast("string"), F.lit("")), f"_k{i}") for i, k in enumerate(keys)]
    return join_unique(df, text_keys(removed, keys), match, "left_anti")


def upsert(old: DataFrame | None, new: DataFrame, keys: Sequence[str],
           purge_keys: DataFrame | None = None) -> DataFrame:
    """Drop the stored rows whose key the batch (or `purge_keys`) holds and add the
    batch. A key may have several rows, so this is no row-by-row merge. Without a
    store, or where the store lacks a key column, the batch replaces everything."""
    if old is None or any(k not in old.columns for k in keys):
        return new
    kept = without_keys(old, keys, new if purge_keys is None else purge_keys)
    return kept.unionByName(new, allowMissingColumns=True)
