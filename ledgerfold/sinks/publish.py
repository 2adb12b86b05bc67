"""Published copies of the unified table: all text, full replace or append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import decimal_comma
from ..operators.joins import join_unique
from ..operators.quality import filter_by_ids
from ..session import settle
from .tables import append_partitioned, append_rows, ensure_partitioned, partition_text, read_partitioned, replace_table, table_exists, touched_values, write_upsert

#: Key of published rows, and the column that partitions them.
KEYS = ("Index", "AnoMes")
PARTITION = "AnoMes"


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, null as ''."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def comma_text(df: DataFrame) -> DataFrame:
    """as_text with decimal commas."""
    return df.select(*[decimal_comma(F.col(c).cast("string")).alias(c) for c in df.columns])


def publish(spark: SparkSession, df: DataFrame, path: str, mode: str = "append",
            accounts: DataFrame | None = None, ids=None) -> DataFrame:
    """Write published rows and return them. 'replace' rewrites the target with plain
    text; 'append' adds rows with decimal commas, optionally of some accounts only."""
    if mode == "replace":
        out = as_text(df)
        replace_table(spark, path, out)
        return out
    if ids is not None:
        named = df.withColumns({"operator": F.col("Operador"), "username": F.col("Login")})
        df = filter_by_ids(named, accounts, ids).select(*df.columns)
    out = comma_text(df)
    if table_exists(spark, path):
        out = out.select(*spark.read.parquet(path).columns)
    append_rows(out, path)
    return out


def fingerprints(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Each key with the number of its rows and the sum of their 64-bit content hashes, whatever their order. Reduced
    before the shuffle."""
    content = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(df.columns)])
    return df.select(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys], content.alias("_content")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("_content").cast("decimal(38,0)")).alias("content"))


def unpublished(new: DataFrame, stored: DataFrame | None, keys: Sequence[str] = KEYS) -> tuple[DataFrame, DataFrame]:
    """(rows, changed): rows of keys that are not published yet, and published keys whose rows are others now, with the
    numbers of rows then and now."""
    if stored is None:
        return new, fingerprints(new, keys).limit(0).select(*keys, F.col("n_rows").alias("n_before"), "n_rows")
    seen = fingerprints(stored.select(*new.columns), keys).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("n_rows").alias("n_before"), F.col("content").alias("before"))
    on = [(F.coalesce(F.col(k).cast("string"), F.lit("")), f"_{k}") for k in keys]
    changed = join_unique(fingerprints(new, keys), seen, on, "inner").where("n_rows <> n_before OR content <> before")
    return join_unique(new, seen.select(*[f"_{k}" for k in keys]), on, "left_anti"), changed.select(*keys, "n_before", "n_rows")


def publish_new(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Append rows of keys that are not published yet, with decimal commas; returns the published keys
    whose rows differ now, which stay as they were published. Doing it again appends nothing.

    The published table is its own ledger: it is partitioned by month, and only the batch's months are read."""
    ensure_partitioned(spark, path, PARTITION)
    out = settle(comma_text(df))
    stored = read_partitioned(spark, path, PARTITION)
    if stored is not None:
        stored = stored.where(partition_text(PARTITION).isin(touched_values(PARTITION, out)))
    new, changed = unpublished(out, stored)
    changed = settle(changed)
    new = settle(new)
    if not new.isEmpty():
        append_partitioned(new, path, PARTITION)
    return changed


def republish(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Rows of published keys in their present form; keys that are not published are left to `publish_new`."""
    if not table_exists(spark, path):
        return
    ensure_partitioned(spark, path, PARTITION)
    out = settle(comma_text(df))
    stored = read_partitioned(spark, path, PARTITION).where(partition_text(PARTITION).isin(touched_values(PARTITION, out)))
    known = stored.select(*[F.coalesce(F.col(k), F.lit("")).alias(f"_{k}") for k in KEYS]).distinct()
    write_upsert(spark, path, join_unique(out, known, [(F.col(k), f"_{k}") for k in KEYS], "left_semi"), KEYS, partition=PARTITION)
