"""Business rules as rows: keys with wildcards, the most specific hit counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import norm_key
from .dedup import first_per_key
from .joins import join_unique

ANY = "*"


def given(c: Column) -> Column:
    """A key as a pattern; no value of a key looks like the wildcard."""
    return F.concat(F.lit("="), norm_key(c))


def most_specific(df: DataFrame, rules: DataFrame, on: Mapping[str, Column], values: Sequence[str]) -> DataFrame:
    """Add the values of the rule that fits a row best; null where none fits.

    `on` pairs a rule column with the row's key; both are compared trimmed and in lower case, and a null rule
    column fits every key. Of rules that fit, the one with more keys given wins, then the one whose
    earlier columns are given; of rules with the same keys the smallest values count. Only the distinct keys of
    the rows are expanded to patterns, so rows neither multiply nor lengthen the plan with the number of rules."""
    keys = [f"_key{i}" for i in range(len(on))]
    wanted = [f"_want{i}" for i in range(len(on))]
    table = first_per_key(rules.select(*[F.when(F.col(c).isNull(), ANY).otherwise(given(F.col(c))).alias(w) for c, w in zip(on, wanted)],
                                       *[F.col(v).alias(f"_{v}") for v in values]), wanted, [])
    kinds = sorted(product((True, False), repeat=len(on)), key=lambda kind: (-sum(kind), [not g for g in kind]))
    patterns = F.array(*[F.struct(F.lit(rank).alias("rank"), *[(F.col(k) if g else F.lit(ANY)).alias(f"p{i}") for i, (g, k) in enumerate(zip(kind, keys))])
                         for rank, kind in enumerate(kinds)])
    mine = df.select(*[given(c).alias(k) for c, k in zip(on.values(), keys)]).distinct()
    expanded = mine.select(*keys, F.explode(patterns).alias("_p")).select(*keys, F.col("_p.*"))
    hits = join_unique(expanded, table, [(F.col(f"p{i}"), w) for i, w in enumerate(wanted)], "inner")
    best = hits.groupBy(*keys).agg(F.min(F.struct("rank", *[f"_{v}" for v in values])).alias("_best")).select(*keys, *[F.col(f"_best._{v}").alias(v) for v in values])
    return join_unique(df, best, [(given(c), k) for c, k in zip(on.values(), keys)], "left")
