"""Last steps of the unified table: defaults, keys, totals, published columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import AUTOMATED_LABEL, PENDING_TEXT, PUBLISHED
from ..functions import billing_total, netting_default, origin, row_key


def add_keys(df: DataFrame) -> DataFrame:
    """Netting default, row key, origin and the constant label."""
    return (df.withColumn("netting", netting_default(F.col("netting")))
              .withColumn("row_key", row_key(*[F.col(c) for c in
                                               ("month", "ref", "platform", "username")]))
              .withColumn("origin", origin(F.col("operator"), F.col("username")))
              .withColumn("automated", F.lit(AUTOMATED_LABEL)))


def add_totals(df: DataFrame) -> DataFrame:
    """Billing totals in the row's currency and in EUR."""
    return (df.withColumn("total_amount", billing_total(F.col("netting"), F.col("cpa_amount"),
                                                        F.col("rs_amount")))
              .withColumn("total_eur", billing_total(F.col("netting"), F.col("cpa_eur"),
                                                     F.col("rs_eur"))))


def published(df: DataFrame) -> DataFrame:
    """Published names and order, all text. Pending amounts show the waiting text,
    their rate is empty; null is empty."""
    pending = F.col("pending_fx") if "pending_fx" in df.columns else F.lit(False)
    waiting = {"rs_amount", "cpa_amount", "total_amount"}
    return df.select(*[
        (F.when(pending, F.lit(PENDING_TEXT)).otherwise(F.coalesce(F.col(c).cast("string"), F.lit("")))
         if c in waiting else F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(name)
        for name, c in PUBLISHED.items()])
