"""Which landed files are new: a ledger of those taken, and listing-time pruning behind a mark."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_unique
from ..sinks.tables import read_table, table_exists

#: New files of one run whose paths the driver takes; more is an error.
MAX_FILES = 10_000
#: A file may land with a time this much older than the newest one taken.
LATENESS = dt.timedelta(days=30)
LEDGER = "path string, modified timestamp, size long, choice string"


def landed_files(spark: SparkSession, folder: str, after: dt.datetime | None = None) -> DataFrame:
    """(path, modified, size) of a folder's files; contents are not read. Files not modified after `after` are left
    out when the folder is listed."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if after is not None:
        reader = reader.option("modifiedAfter", after.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
    return reader.load(folder).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def new_files(spark: SparkSession, folder: str, ledger: str, choice: str = "") -> DataFrame:
    """Files of the folder that the ledger does not hold, in ledger columns: new, rewritten (another time or size)
    and late ones. `choice` names what is taken of a file; one taken whole ('') is taken for every choice.

    Files older than the newest one taken by more than LATENESS are not looked at, so neither the listing
    nor the part of the ledger in use grows with the history. A file that lands later than that has to be touched."""
    if not table_exists(spark, folder):
        return spark.createDataFrame([], LEDGER)
    held = read_table(spark, ledger)
    if held is None:
        return landed_files(spark, folder).withColumn("choice", F.lit(choice))
    held = held.where(F.col("choice").isin("", choice))
    newest = held.agg(F.max("modified").cast("long").alias("at")).first()["at"]
    after = None if newest is None else dt.datetime.fromtimestamp(newest, dt.timezone.utc) - LATENESS
    seen = held if after is None else held.where(F.col("modified") >= F.timestamp_seconds(F.lit(int(after.timestamp()))))
    seen = seen.select(F.col("path").alias("_path"), F.col("modified").alias("_modified"), F.col("size").alias("_size")).distinct()
    found = landed_files(spark, folder, after)
    fresh = join_unique(found, seen, [(F.col("path"), "_path"), (F.col("modified"), "_modified"), (F.col("size"), "_size")], "left_anti")
    return fresh.withColumn("choice", F.lit(choice))


def file_paths(files: DataFrame) -> list[str]:
    """Paths for a reader, glob characters escaped."""
    paths = [r.path for r in files.select("path").limit(MAX_FILES + 1).collect()]
    if len(paths) > MAX_FILES:
        raise ValueError(f"more than {MAX_FILES} new files in one run")
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]
