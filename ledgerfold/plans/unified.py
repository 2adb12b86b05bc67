"""The unified monthly table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import UNION_KEYS, Rules
from ..functions import amount_fault, canonical_operator, currency_default, is_blank, round2
from ..operators.adapters import ADAPTERS, union_reports
from ..operators.billing import add_keys, add_totals
from ..operators.fx import add_eur, mark_pending, missing_rates, monthly_rates, rebase, with_rate
from ..operators.quality import divergences, filter_union_by_ids, split_faults
from ..operators.reference import enrich_reference, reference_lookup, rename_accounts
from ..operators.rule_table import most_specific
from ..session import settle

UNIFIED = ["row_key", "month", "brand", "platform", "automated", "ref", "origin", "operator",
           "username", "netting", "currency", "rate", "rs_amount", "rs_eur", "cpa_amount",
           "cpa_eur", "total_amount", "total_eur", "pending_fx"]


# Amount texts of the standard reports.
AMOUNT_TEXTS = {"wide": ("rs_reward", "cpa_reward"), "long": (), "vendor": ("revshare_commission", "cpa_commission"),
                "multilingual": ("pct_commission", "cpa_commission")}


@dataclass
class UnifiedResult:
    unified: DataFrame          # rows with a reference, ready to store
    divergences: DataFrame      # rows without one
    missing_rates: DataFrame    # (month, currency) without a rate
    processed_keys: DataFrame   # keys to purge from the store, removed rows included
    rejected: DataFrame         # amounts that no number here can hold, with the reason; their rows count nowhere else
    enriched: DataFrame         # all rows, before those without a reference go


#: Columns that a currency rule may name; null fits every row.
CURRENCY_RULE_KEYS = ("platform", "operator", "brand")


def normalise_union(union: DataFrame, rules: Rules, currency_rules: DataFrame | None = None) -> DataFrame:
    """Operator aliases, cents, currency default, account renames. An empty currency is filled by the most specific of
    the `currency_rules` (CURRENCY_RULE_KEYS, `default_currency`) first, where they are given."""
    if currency_rules is not None:
        union = most_specific(union, currency_rules, {k: F.col(k) for k in CURRENCY_RULE_KEYS}, ["default_currency"])
        given = F.when(is_blank(F.col("currency"), ["0"]), F.coalesce("default_currency", "currency")).otherwise(F.col("currency"))
        union = union.withColumn("currency", given).drop("default_currency")
    out = union.withColumns({
        "operator": canonical_operator(F.col("operator"), rules.operator_aliases),
        "rs_amount": round2(F.col("rs_amount")),
        "cpa_amount": round2(F.col("cpa_amount")),
        "currency": currency_default(F.col("currency"), F.col("brand"), rules.brand_currency,
                                     rules.default_currency)})
    return rename_accounts(out, rules)


def finish(enriched: DataFrame, rules: Rules) -> DataFrame:
    """Rows with a reference, with keys, totals and pending marks, in table order."""
    kept = enriched.where(F.col("ref").isNotNull())
    return mark_pending(add_totals(add_keys(kept)), rules).select(*UNIFIED)


def convert(union: DataFrame, rates: DataFrame, rules: Rules) -> DataFrame:
    """Rates, EUR amounts and restated brands, from one rate per month and currency."""
    return rebase(add_eur(with_rate(union, rates)), rates, rules)


def build_unified(reports: Mapping[str, DataFrame], rates: DataFrame, reference: DataFrame,
                  rules: Rules = Rules(), accounts: DataFrame | None = None, ids=None,
                  store_lookups: bool = True, store_enriched: bool = True, counters=None,
                  currency_rules: DataFrame | None = None) -> UnifiedResult:
    """Standard reports (keyed by shape: wide, vendor, long, multilingual) to the
    unified table and its side reports.

    With `store_lookups` the rates and the reference are written to the shared scratch
    folder first, so that the planner knows their size. The enriched rows feed three
    outputs; with `store_enriched` they are written there too instead of being computed
    once per output, and `counters` count what passes: rows read, with a rate, converted to another
    currency by a rebase rule, and removed for lack of a reference."""
    good, rejected = {}, []
    for shape, df in reports.items():
        named = df if "username" in df.columns else df.withColumnRenamed("account_username", "username")
        texts = [*AMOUNT_TEXTS[shape], *(r.cpa_column for r in rules.measure_overrides if shape == "wide")]
        good[shape], bad = split_faults(named, {c: amount_fault(F.col(c)) for c in dict.fromkeys(texts) if c in df.columns}, *UNION_KEYS)
        rejected.append(bad)
    union = normalise_union(union_reports([ADAPTERS[k](df, rules) for k, df in good.items()]), rules, currency_rules)
    if ids is not None:
        union = filter_union_by_ids(union, accounts, ids)
    union = union.withColumn("reported_currency", F.col("currency"))
    month_rates = monthly_rates(rates)
    lookup = reference_lookup(reference)
    if store_lookups:
        month_rates, lookup = settle(month_rates), settle(lookup)
    enriched = enrich_reference(convert(union, month_rates, rules), lookup, rules)
    if store_enriched and counters is not None:
        enriched = counters.watch(enriched, read=None, with_rate=F.col("rate").isNotNull(), converted=F.col("currency") != F.col("reported_currency"),
                                  removed=F.col("ref").isNull())
    if store_enriched:
        enriched = settle(enriched)
    lost = union_reports(rejected)
    processed = enriched.select(*UNION_KEYS).unionByName(
        lost.select(*UNION_KEYS).withColumn("operator", canonical_operator(F.col("operator"), rules.operator_aliases)))
    return UnifiedResult(finish(enriched, rules), divergences(enriched),
                         missing_rates(union, month_rates),
                         processed.distinct(), lost, enriched)
