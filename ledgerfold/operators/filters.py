"""Row filters over accounts and reports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_blank, norm_key, strip

ACTIVE = ("1",)
ACTIVE_MULTILINGUAL = ("1", "4", "5")


def select_accounts(accounts: DataFrame, platform: str, operator: str | None = None,
                    ids: Iterable[str] | DataFrame | None = None,
                    active: Sequence[str] = ACTIVE) -> DataFrame:
    """Accounts of a platform with a wanted active flag, a login URL and a username;
    optionally of one operator, and of given ids (a list, or a one-column frame)."""
    out = accounts.where(
        (norm_key(F.col("platform")) == platform.strip().lower())
        & strip(F.col("active")).isin(list(active))
        & ~is_blank(F.col("url"), any_case=True)
        & ~is_blank(F.col("username")))
    if operator:
        out = out.where(norm_key(F.col("operator")) == operator.strip().lower())
    if ids is None:
        return out
    if isinstance(ids, DataFrame):
        wanted = ids.select(strip(F.col(ids.columns[0]).cast("string")).alias("_id")).distinct()
        return out.join(wanted, strip(F.col("account_id")) == F.col("_id"), "left_semi")
    return out.where(strip(F.col("account_id")).isin([str(i).strip() for i in ids]))


def drop_totals(df: DataFrame, first: str | None = None) -> DataFrame:
    """Drop rows whose first column starts with 'total'; an empty cell is kept."""
    cell = F.lower(strip(F.coalesce(F.col(f"`{first or df.columns[0]}`"), F.lit(""))))
    return df.where(~F.startswith(cell, F.lit("total")))


def detail_only(df: DataFrame) -> DataFrame:
    """Keep detail rows (rowid 1) where the report numbers its sections."""
    if "rowid" not in df.columns:
        return df
    return df.where(strip(F.col("rowid")) == "1")


def same_month(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows whose two month columns agree."""
    return df.where(strip(F.col(left)) == strip(F.col(right)))


def only_month(df: DataFrame, month: str, column: str = "month") -> DataFrame:
    """Rows of one month; on a stored table this reads that partition only."""
    return df.where(F.col(column) == month)


def in_month(df: DataFrame, month: str, column: str) -> DataFrame:
    """Rows whose timestamp lies in a month (yyyy-MM); a range that scans can use."""
    start = F.to_timestamp(F.lit(f"{month}-01"))
    return df.where((F.col(column) >= start) & (F.col(column) < F.add_months(F.lit(f"{month}-01").cast("date"), 1).cast("timestamp")))


def brand_slice(df: DataFrame, brand: str) -> DataFrame:
    return df.where(F.col("brand") == brand)


def used_platform(c: Column, platforms: Sequence[str]) -> Column:
    return norm_key(c).isin([p.strip().lower() for p in platforms])


def any_filled(columns: Sequence[str]) -> Column:
    """True when at least one of the columns holds more than white space."""
    return F.coalesce(*[F.nullif(strip(F.col(c)), F.lit("")) for c in columns]).isNotNull()


def currency_choice(feed: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of the wanted currencies, wanted currencies the feed lacks). An empty
    list wants all."""
    spark = feed.sparkSession
    names = spark.createDataFrame([(w,) for w in wanted], "currency string")
    if not wanted:
        return feed, names
    return (feed.where(F.col("currency").isin(list(wanted))),
            names.join(feed.where(F.col("currency").isin(list(wanted))).select("currency").distinct(), "currency", "left_anti"))
