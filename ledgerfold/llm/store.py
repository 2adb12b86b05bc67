"""Intermediate tables in the folder that all executors share, and names that cannot clash."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_own: list[str] = []
#: Whether Spark deletes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Whether Spark merges small shuffle partitions.
COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below spark.checkpoint.dir. Where that is unset, a temporary folder is
    made with a local master only; a cluster has to name its shared folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="ledgerfold-"))
        base = _own[0]
    return f"{base.rstrip('/')}/table-{uuid.uuid4().hex}"


def stored(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """The same rows, written once as Parquet and read back: lineage ends here, and the loss
    of an executor costs nothing that lies before. Nobody reads the shuffle files of the write
    again, so they go at its end, not when the driver happens to collect its garbage."""
    path, conf = shared_folder(df.sparkSession), df.sparkSession.conf
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def spread(spark: SparkSession):
    """Tables written within keep all their shuffle partitions: for rows that are small but cost much time each."""
    before = spark.conf.get(COALESCE, "true")
    spark.conf.set(COALESCE, "false")
    try:
        yield
    finally:
        spark.conf.set(COALESCE, before)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like those wanted that no column of the frame has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def beside(keep: tuple[str, ...], added: list[str]) -> list[str]:
    """Names for kept columns beside added ones: one that is taken, whatever the case, gets underscores behind it."""
    taken = {c.lower() for c in added}
    out = []
    for name in keep:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
