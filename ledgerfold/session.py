"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the engine is planned for. Shuffle partitions stay high and are
# coalesced at run time, so the same value suits small and very large inputs.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods beyond this size: rather no whole-stage code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole HTML pages pass through Arrow: bound a batch by rows of that size.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


def build_session(app: str = "ledgerfold", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A fresh path below spark.checkpoint.dir, which all executors must share. There is
    no other place for it: without the setting this raises, on any master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/ledgerfold-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write a result once to shared storage and read it back.

    Used by writers for frames that feed several outputs, and for lookup sides derived
    from large inputs: read back, their size is the true file size, so the planner
    broadcasts them only while they fit under its threshold and otherwise joins by
    shuffle. The written table also survives the loss of executors."""
    path = scratch_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
