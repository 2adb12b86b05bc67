"""Exchange rates: refresh, one rate per month, conversion, restatement, late rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import MONEY, RATE, RATE_COLUMNS, RAW, Rules
from ..functions import feed_timestamp, norm_key, quote_month, rate_fault, round2, strip, times_rate, to_eur
from .dedup import first_per_key, nulls_last
from .filters import currency_choice
from .joins import join_unique


def explode_feed(feed: DataFrame) -> DataFrame:
    """Rate feed records to one row per currency. An unreadable quote time is kept
    as its raw text and gets an empty month. Absent rates are left out."""
    ts = feed_timestamp(F.col("time_last_update_utc"))
    return (feed.select(quote_month(ts).alias("month"),
                        F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
                                   F.col("time_last_update_utc")).alias("quote_ts"),
                        "base_code",
                        F.explode("conversion_rates").alias("currency", "rate"))
                .where(F.col("rate").isNotNull())
                .select(*RATE_COLUMNS))


def unseen_rates(rows: DataFrame, history: DataFrame | None) -> DataFrame:
    """Rows whose (quote time, currency) the history does not hold yet, one for each of
    them: of copies inside the batch the smallest stays."""
    rows = first_per_key(rows, ["quote_ts", "currency"], [])
    if history is None:
        return rows
    seen = history.select(F.col("quote_ts").alias("_q"), F.col("currency").alias("_c")).distinct()
    return join_unique(rows, seen, [(F.col("quote_ts"), "_q"), (F.col("currency"), "_c")], "left_anti")


def refresh_rates(feed: DataFrame, history: DataFrame | None = None,
                  currencies: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(new rows to append to the history, wanted currencies the feed lacks)."""
    chosen, unknown = currency_choice(explode_feed(feed), currencies)
    return unseen_rates(chosen, history), unknown


def monthly_rates(history: DataFrame) -> DataFrame:
    """(month, currency, rate): the earliest quote of each month and currency, with
    unreadable quote times last. If the chosen rate is no number the pair has no
    rate at all; later quotes do not stand in."""
    quotes = history.select(strip(F.col("month")).alias("month"),
                            strip(F.col("currency")).alias("currency"),
                            strip(F.col("quote_ts").cast("string")).try_cast("timestamp_ntz").alias("ts"),
                            F.col("rate").cast("string").alias("rate"))
    first = first_per_key(quotes, ["month", "currency"], nulls_last(F.col("ts")))
    usable = F.when(rate_fault(F.col("rate")).isNull(), strip(F.col("rate")).try_cast(RATE))
    return first.select("month", "currency", usable.alias("rate")).where(F.col("rate").isNotNull())


def rejected_rates(history: DataFrame) -> DataFrame:
    """Quotes whose rate is a number that the rate type cannot hold, with the reason."""
    reason = rate_fault(F.col("rate").cast("string"))
    return history.select(*RATE_COLUMNS, reason.alias("reason")).where("reason IS NOT NULL")


def with_rate(df: DataFrame, rates: DataFrame, name: str = "rate") -> DataFrame:
    """Add the rate of the row's month and currency; null when there is none."""
    lookup = rates.select(F.col("month").alias("_m"), F.col("currency").alias("_c"),
                          F.col("rate").alias(name))
    return join_unique(df, lookup, [(strip(F.col("month")), "_m"), (strip(F.col("currency")), "_c")], "left")


def with_fixed_rate(df: DataFrame, rates: DataFrame, currency: str, name: str) -> DataFrame:
    """Add the rate of one currency in the row's month."""
    lookup = (rates.where(F.col("currency") == currency)
                   .select(F.col("month").alias("_m"), F.col("rate").alias(name)))
    return join_unique(df, lookup, [(strip(F.col("month")), "_m")], "left")


def add_eur(df: DataFrame) -> DataFrame:
    """EUR amounts from the row's amounts and rate."""
    return (df.withColumn("rs_eur", to_eur(F.col("rs_amount"), F.col("rate")))
              .withColumn("cpa_eur", to_eur(F.col("cpa_amount"), F.col("rate"))))


def rebase(df: DataFrame, rates: DataFrame, rules: Rules) -> DataFrame:
    """Restate amounts of a brand in its own currency (EUR amount x that rate),
    keeping the EUR amounts. Rows of a month without that rate stay as they are."""
    for rule in rules.rebases:
        df = with_fixed_rate(df, rates, rule.restated, "_local")
        hit = ((norm_key(F.col("brand")) == rule.brand.strip().lower())
               & (strip(F.col("currency")) == rule.reported)
               & F.coalesce(F.col("_local") != 0, F.lit(False)))
        local = F.col("_local")
        df = df.select(*[
            F.when(hit, round2(times_rate(F.col("rs_eur"), local))).otherwise(F.col(c)).alias(c)
            if c == "rs_amount" else
            F.when(hit, round2(times_rate(F.col("cpa_eur"), local))).otherwise(F.col(c)).alias(c)
            if c == "cpa_amount" else
            F.when(hit, F.lit(rule.restated)).otherwise(F.col(c)).alias(c)
            if c == "currency" else
            F.when(hit, local).otherwise(F.col(c)).alias(c)
            if c == "rate" else F.col(c)
            for c in df.columns if c != "_local"])
    return df


def missing_rates(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Distinct (month, currency) pairs in use that have no rate."""
    used = (df.select(strip(F.col("month")).alias("month"), strip(F.col("currency")).alias("currency"))
              .where(F.col("currency") != "").distinct())
    return used.join(rates, ["month", "currency"], "left_anti")


def is_pending(rules: Rules) -> Column:
    hit = F.lit(False)
    for rule in rules.pending:
        hit = hit | ((norm_key(F.col("platform")) == rule.platform.strip().lower())
                     & (norm_key(F.col("username")) == rule.username.strip().lower()))
    return hit


def mark_pending(df: DataFrame, rules: Rules) -> DataFrame:
    """Flag rows that wait for a rate; their own-currency amounts and rate are null
    until it arrives, their EUR amounts stay."""
    df = df.withColumn("pending_fx", is_pending(rules))
    for name, kind in (("rs_amount", MONEY), ("cpa_amount", MONEY), ("total_amount", MONEY),
                       ("rate", RATE)):
        df = df.withColumn(name, F.when(~F.col("pending_fx"), F.col(name)).cast(kind))
    return df


def resolve_pending_fx(df: DataFrame, late_rates: DataFrame) -> DataFrame:
    """Complete pending rows once their rate is known. `late_rates` has one rate per
    row_key. Amounts become EUR x rate, unrounded; other rows stay pending."""
    late = late_rates.groupBy(F.col("row_key").alias("_key")).agg(F.max(strip(F.col("rate").cast("string")).try_cast(RATE)).alias("_late"))
    df = join_unique(df, late, [(F.col("row_key"), "_key")], "left")
    done = F.col("pending_fx") & F.col("_late").isNotNull()
    for amount, eur in (("rs_amount", "rs_eur"), ("cpa_amount", "cpa_eur"),
                        ("total_amount", "total_eur")):
        value = times_rate(F.col(eur), F.col("_late"))
        df = df.withColumn(amount, F.when(done, value).otherwise(F.col(amount).cast(RAW)))
    return (df.withColumn("rate", F.when(done, F.col("_late")).otherwise(F.col("rate")))
              .withColumn("pending_fx", F.col("pending_fx") & ~done).drop("_late"))


def completed_rows(stored: DataFrame, late_rates: DataFrame, keys: Sequence[str] = ("row_key", "month")) -> tuple[DataFrame, DataFrame]:
    """(rows, found): `found` are the keys of stored rows that wait and have a late rate now, `rows` all stored rows
    of these keys, completed, in the store's own types (amounts in cents). Rates that are no number complete nothing."""
    known = late_rates.where(strip(F.col("rate").cast("string")).try_cast(RATE).isNotNull()).select(F.col("row_key").alias("_key")).distinct()
    found = join_unique(stored.where("pending_fx"), known, [(F.col("row_key"), "_key")], "left_semi").select(*keys).distinct()
    mine = found.select(*[F.col(k).alias(f"_k{k}") for k in keys])
    rows = join_unique(stored, mine, [(F.col(k), f"_k{k}") for k in keys], "left_semi")
    done = resolve_pending_fx(rows, late_rates)
    return done.select(*[F.round(F.col(c), 2).cast(stored.schema[c].dataType).alias(c) if c in ("rs_amount", "cpa_amount", "total_amount")
                         else F.col(c) for c in stored.columns]), found
