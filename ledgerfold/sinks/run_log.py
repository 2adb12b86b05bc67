"""Run history: one row per step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import RUN_LOG_COLUMNS
from ..functions import duration_text, step_status
from .tables import append_rows


def render_steps(steps: DataFrame) -> DataFrame:
    """Steps (run_at, month, step, returncode, seconds) in run-history columns."""
    return (steps.withColumn("status", step_status(F.col("returncode")))
                 .withColumn("duration", duration_text(F.col("seconds")))
                 .select(*RUN_LOG_COLUMNS))


def run_summary(steps: DataFrame, *keys: str) -> DataFrame:
    """Steps that went well and steps that failed."""
    return steps.groupBy(*keys).agg(
        F.count_if(F.col("returncode") == 0).alias("n_ok"),
        F.count_if(F.col("returncode") != 0).alias("n_failed"),
        duration_text(F.sum("seconds")).alias("duration"))


def append_run_log(spark: SparkSession, path: str, steps: list[tuple]) -> DataFrame:
    """Append (run_at, month, step, returncode, seconds) tuples of one run."""
    frame = spark.createDataFrame(
        steps, "run_at string, month string, step string, returncode int, seconds double")
    out = render_steps(frame)
    append_rows(out, path)
    return out
