"""Stored tables, text reports, rate feed and the rule file."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import (ACCOUNTS, RATE_FEED, RATE_HISTORY, REFERENCE, AccountRename,
                         MeasureOverride, PendingFx, Rebase, Rules, VendorKey)
from ..functions import strip
from ..sinks.tables import read_partitioned, table_exists


def read_report(spark: SparkSession, path: str, schema: T.StructType,
                multi_line: bool = True) -> DataFrame:
    """All-text CSV report with a header line. Columns are taken by position, so
    headers that differ only in case keep separate names. A missing path is an empty
    report. Cells may hold line breaks, which keeps a file in one task; without them
    (`multi_line` off) a large file is split."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
            .option("quote", '"').option("escape", '"').option("multiLine", multi_line).csv(path))


def read_stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table, or CSV where the path says so; only the schema's columns."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    if path.lower().endswith(".csv"):
        return read_report(spark, path, schema)
    return spark.read.parquet(path).select(*schema.fieldNames())


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return read_stored(spark, path, ACCOUNTS)


def read_rates(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """The rate history, or that of the given months only: of a stored table no other partition is read."""
    if table_exists(spark, path) and not path.lower().endswith(".csv"):
        found = read_partitioned(spark, path, "month").withColumn("month", F.coalesce("month", F.lit(""))).select(*RATE_HISTORY.fieldNames())
    else:
        found = read_stored(spark, path, RATE_HISTORY)
    return found if months is None else found.where(strip(F.col("month")).isin(list(months)))


def with_file_order(df: DataFrame) -> DataFrame:
    """Add `pos`, the row's place in file order. To be applied to a fresh scan: block
    offset orders the pieces of a file, the running id orders rows within a piece."""
    return df.withColumn("pos", F.struct(F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("row")))


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """The five reference columns and `pos`. A stored `pos` column is used as it is."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], T.StructType([*REFERENCE.fields, T.StructField("pos", T.LongType())]))
    if not path.lower().endswith(".csv"):
        stored = spark.read.parquet(path)
        if "pos" in stored.columns:
            return stored.select(*REFERENCE.fieldNames(), "pos")
        return with_file_order(stored).select(*REFERENCE.fieldNames(), "pos")
    return with_file_order(read_report(spark, path, REFERENCE))


def read_rate_feed(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Landed feed objects, one JSON document per file: of a folder, or of the given files."""
    if not path or (isinstance(path, str) and not table_exists(spark, path)):
        return spark.createDataFrame([], RATE_FEED)
    return spark.read.schema(RATE_FEED).option("multiLine", True).json(path)


RULE_TYPES = {"measure_overrides": MeasureOverride, "account_renames": AccountRename,
              "rebases": Rebase, "vendor_keys": VendorKey, "pending": PendingFx}
RULE_SCHEMA = T.StructType(
    [T.StructField(name, T.ArrayType(T.StructType(
        [T.StructField(f.name, T.StringType()) for f in dataclasses.fields(kind)])))
     for name, kind in RULE_TYPES.items()]
    + [T.StructField(n, T.MapType(T.StringType(), T.StringType()))
       for n in ("operator_aliases", "brand_currency", "sheet_tabs")]
    + [T.StructField("default_currency", T.StringType()),
       T.StructField("used_platforms", T.ArrayType(T.StringType()))])


def read_rules(spark: SparkSession, path: str) -> Rules:
    """The rule file: one JSON object whose keys are the fields of Rules. Absent
    fields keep their defaults."""
    row = spark.read.schema(RULE_SCHEMA).option("multiLine", True).json(path).head()
    given = {k: v for k, v in row.asDict(recursive=True).items() if v is not None}
    for name, kind in RULE_TYPES.items():
        if name in given:
            given[name] = tuple(kind(**entry) for entry in given[name])
    if "used_platforms" in given:
        given["used_platforms"] = tuple(given["used_platforms"])
    return Rules(**given)
