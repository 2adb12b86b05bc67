"""The driver's test tables in the roles of the engine's inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CENTS = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(name: str) -> Column:
    """A two-decimal double column as an exact decimal."""
    return F.col(name).cast(CENTS)


def cents_text(name: str) -> Column:
    return cents(name).cast("string")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def day_label(name: str) -> Column:
    """The day of a time in two digits, without a formatter's parts."""
    return F.lpad(F.dayofmonth(name).cast("string"), 2, "0")


def pick(key: Column, values: dict, default=None) -> Column:
    """CASE key WHEN ... over literal values."""
    out = F.lit(default)
    for k, v in reversed(values.items()):
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


# Currency symbols by order priority, as reports would print them.
SYMBOLS = {"1-URGENT": "R$", "2-HIGH": "€", "3-MEDIUM": "USD ", "4-NOT SPECIFIED": ""}
# The currency an order is reported in; '5-LOW' has none on record.
ORDER_CURRENCY = {"1-URGENT": "purchase", "2-HIGH": "signup", "3-MEDIUM": "view",
                  "4-NOT SPECIFIED": "click"}


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as accounts: nation is the operator, region the brand, market
    segment the platform."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
             .select(text("c_custkey").alias("account_id"), F.col("c_mktsegment").alias("platform"),
                     F.col("n_name").alias("operator"), F.col("r_name").alias("brand"),
                     F.col("c_name").alias("username"), "c_custkey", "c_nationkey", "c_acctbal"))


def day_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a rate history: the day is the month label, the event type the
    currency, the value the rate."""
    e = table(spark, sf_dir, "events")
    return e.select(day_label("ts").alias("month"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("quote_ts"),
                    F.lit("EUR").alias("base_code"), F.col("event_type").alias("currency"),
                    cents_text("value").alias("rate"))


def order_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as union rows: month label is the day, currency by priority."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", day_label("o_orderdate").alias("month"),
                    pick(F.col("o_orderpriority"), ORDER_CURRENCY, "none").alias("currency"),
                    "o_orderstatus", cents("o_totalprice").alias("amount"))
