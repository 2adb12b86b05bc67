"""Parquet table writers: partition upsert, full replace, append."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.fx import unseen_rates
from ..operators.upsert import upsert, without_keys
from ..session import settle

#: Partition values of one batch that the driver takes; months are far fewer.
MAX_PARTITIONS = 10_000


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there are files; a table whose partitions are all gone counts as absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    return fs.getFileStatus(p).isFile() or any(s.getPath().getName()[0] not in "_." for s in fs.listStatus(p))


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if table_exists(spark, path) else None


def partition_text(column: str) -> Column:
    """A partition value as text; a null one and an empty one share a folder."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def touched_values(column: str, *frames: DataFrame) -> list[str]:
    """Distinct partition values in the frames, '' for null (months of one batch: a short list)."""
    found = None
    for frame in frames:
        part = frame.select(partition_text(column).alias("v"))
        found = part if found is None else found.unionByName(part)
    values = [r.v for r in found.distinct().limit(MAX_PARTITIONS + 1).collect()]
    if len(values) > MAX_PARTITIONS:
        raise ValueError(f"one batch touches more than {MAX_PARTITIONS} values of {column}")
    return values


def read_partitioned(spark: SparkSession, path: str, partition: str) -> DataFrame | None:
    """A stored table whose partition values are read as the texts they are: '01' is not 1."""
    if not table_exists(spark, path):
        return None
    found = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == partition else f for f in found])
    return spark.read.schema(schema).parquet(path)


def is_partitioned(spark: SparkSession, path: str, column: str) -> bool:
    """Whether the table's folders are values of the column."""
    fs, p = _fs(spark, path)
    return fs.exists(p) and any(s.getPath().getName().startswith(f"{column}=") for s in fs.listStatus(p))


def ensure_partitioned(spark: SparkSession, path: str, column: str) -> None:
    """Rewrite a table that an earlier version wrote without partitions."""
    if table_exists(spark, path) and not is_partitioned(spark, path, column):
        replace_table(spark, path, spark.read.parquet(path), column)


def append_partitioned(df: DataFrame, path: str, column: str) -> None:
    """Append, each partition written by as many tasks as its size asks for."""
    df.hint("rebalance", column).write.mode("append").partitionBy(column).parquet(path)


def write_upsert(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str],
                 purge_keys: DataFrame | None = None, partition: str = "month", counters=None) -> list[str]:
    """Upsert into a table partitioned by `partition`, a text; returns the touched partitions.

    The batch is used several times, so it is first written to the shared scratch
    folder. Only touched partitions are read and rewritten. Rows are rebalanced by partition
    value first, so a very large month is written by many tasks and a small one into
    few files; within a file they are sorted by key, so a reader of one account skips
    most of it. Dynamic overwrite leaves partitions without new rows alone, so those that
    end up empty are found before the write and removed after it. The partition column
    must be one of the keys; null and '' are the same partition and are read back as null. `counters` (see
    sinks.counters) count the batch as `new` and the rows of the touched partitions afterwards as `total`."""
    if partition not in keys:
        raise ValueError(f"{partition} must be one of the keys {list(keys)}")
    new = new.withColumn(partition, F.nullif(F.col(partition).cast("string"), F.lit("")))
    new = settle(new if counters is None else counters.watch(new, new=None))
    old = read_partitioned(spark, path, partition)
    if old is not None and any(k not in old.columns for k in keys):
        replace_table(spark, path, new, partition)
        return touched_values(partition, new)
    filled = touched_values(partition, new)
    touched = sorted({*filled, *(touched_values(partition, purge_keys) if purge_keys is not None else [])})
    emptied: list[str] = []
    if old is not None:
        old = old.where(partition_text(partition).isin(touched))
        rest = [v for v in touched if v not in filled]
        if rest:
            kept = without_keys(old.where(partition_text(partition).isin(rest)), keys, new if purge_keys is None else purge_keys)
            emptied = sorted({*rest} - {*touched_values(partition, kept)})
    merged = upsert(old, new, keys, purge_keys)
    if counters is not None:
        merged = counters.watch(merged, total=None)
    (merged.hint("rebalance", partition)
           .sortWithinPartitions(partition, *[k for k in keys if k != partition])
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition).parquet(path))
    for value in emptied:
        drop_partition(spark, path, partition, value)
    return touched


def drop_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    """Remove one partition's folder, under the name that Spark's writer gives it."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value or None)
    fs, p = _fs(spark, path)
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(p, spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(None, None, name, None))), True)


def _moved(fs, source, target) -> bool:
    """A rename that must not end inside an existing target."""
    return not fs.exists(target) and fs.rename(source, target) and fs.exists(target)


def replace_table(spark: SparkSession, path: str, df: DataFrame, partition: str | None = None) -> None:
    """Rewrite a whole table. The new data is complete in a sibling folder before the
    old one is moved aside, so a failed job leaves the old table untouched, and the table may
    be an input of `df`. If the new data cannot be moved in, the old table comes back. A crash
    between the two moves leaves the old table as <path>__old_*, which the next call takes back."""
    staged, retired = (f"{path.rstrip('/')}__{kind}_{uuid.uuid4().hex}" for kind in ("new", "old"))
    recover_table(spark, path)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(staged)
    fs, target = _fs(spark, path)
    new, old = _fs(spark, staged)[1], _fs(spark, retired)[1]
    had = fs.exists(target)
    if had and not _moved(fs, target, old):
        fs.delete(new, True)
        raise RuntimeError(f"could not move {path} aside; it is as before")
    if not _moved(fs, new, target):
        back = not had or _moved(fs, old, target)
        raise RuntimeError(f"could not move {staged} to {path}; " + ("it is as before" if back else f"the old table is {retired}"))
    if had:
        fs.delete(old, True)


def recover_table(spark: SparkSession, path: str) -> None:
    """Take back a table that a crash left moved aside."""
    fs, target = _fs(spark, path)
    if fs.exists(target):
        return
    left = fs.globStatus(_fs(spark, f"{path.rstrip('/')}__old_*")[1])
    for status in list(left or [])[:1]:
        fs.rename(status.getPath(), target)


def append_rates(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Append the rate rows the history does not hold yet; nothing is written without any. The
    history is partitioned by month, which follows from the quote time: only the batch's months are read."""
    ensure_partitioned(spark, path, "month")
    rows = settle(rows)
    history = read_partitioned(spark, path, "month")
    if history is not None:
        history = history.where(partition_text("month").isin(touched_values("month", rows)))
    new = settle(unseen_rates(rows, history))
    if not new.isEmpty():
        append_partitioned(new, path, "month")


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
