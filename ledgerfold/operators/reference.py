"""The reference table: refresh from the worksheet, and enrichment of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import COMMISSION_RANK, Rules
from ..functions import is_blank, netting_default, norm_key, strip
from .dedup import first_per_key
from .filters import used_platform
from .joins import join_unique


def commission_rank(c: Column) -> Column:
    """Revenue share before CPA; null for kinds that do not count."""
    rank = F.lit(None).cast("int")
    for kind, value in COMMISSION_RANK.items():
        rank = F.when(norm_key(c) == kind, F.lit(value)).otherwise(rank)
    return rank


def preferred_rows(sheet: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Worksheet rows of the used platforms with a counting commission kind; of rows
    that share (brand, username, ref) the best-ranked, then the first by `pos`."""
    rows = (sheet.where(used_platform(F.col("platform"), rules.used_platforms))
                 .withColumn("_rank", commission_rank(F.col("commission")))
                 .where(F.col("_rank").isNotNull()))
    return first_per_key(rows, ["brand", "username", "ref"],
                         [F.col("_rank"), F.col("pos")]).drop("_rank")


def update_netting(reference: DataFrame, sheet: DataFrame) -> DataFrame:
    """Take the netting flag from the sheet where the row's (brand, username, ref)
    is there, keep it otherwise; empty means 'No'. Of several sheet rows with the
    same normalised key the last by `pos` counts."""
    pairs = [(norm_key(F.col(c)), f"_{c}") for c in ("brand", "username", "ref")]
    keys = [k for _, k in pairs]
    lookup = first_per_key(sheet.select(*[c.alias(k) for c, k in pairs], F.col("netting").alias("_sheet"), "pos"),
                           keys, [F.col("pos")], last=True)
    lookup = lookup.select(*keys, "_sheet", F.lit(True).alias("_hit"))
    joined = join_unique(reference, lookup, pairs, "left")
    value = F.when(F.col("_hit"), F.col("_sheet")).otherwise(F.col("netting"))
    return joined.select(*[netting_default(value, any_case=True).alias(c) if c == "netting"
                           else F.col(c) for c in reference.columns])


def refresh_reference(sheet: DataFrame, reference: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The reference table with netting flags updated from the worksheet."""
    return update_netting(reference, preferred_rows(sheet, rules))


def reference_lookup(reference: DataFrame) -> DataFrame:
    """One row per normalised (operator, username, brand), the first by `pos`; a
    blank ref counts as none."""
    rows = reference.select(norm_key(F.col("operator")).alias("_k"),
                            norm_key(F.col("username")).alias("_u"),
                            norm_key(F.col("brand")).alias("_b"),
                            "pos", F.when(~is_blank(F.col("ref")), F.col("ref")).alias("ref"),
                            "netting")
    return first_per_key(rows, ["_k", "_u", "_b"], [F.col("pos")]).drop("pos")


def reference_key(rules: Rules) -> Column:
    """The operator, or the vendor name where a vendor-key rule says so."""
    key = norm_key(F.col("operator"))
    for rule in rules.vendor_keys:
        hit = ((norm_key(F.col("operator")) == rule.operator.strip().lower())
               & (norm_key(F.col("brand")) == rule.brand.strip().lower()))
        key = F.when(hit, norm_key(F.col("vendor_name"))).otherwise(key)
    return key


def enrich_reference(df: DataFrame, lookup: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add ref and netting from `reference_lookup`; both null without a match. The
    lookup has unique keys, so no row multiplies."""
    return join_unique(df, lookup, [(reference_key(rules), "_k"), (norm_key(F.col("username")), "_u"),
                                    (norm_key(F.col("brand")), "_b")], "left")


def rename_accounts(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows of an operator in a given currency move to another username."""
    username = F.col("username")
    for rule in rules.account_renames:
        hit = ((strip(F.col("operator")) == rule.operator)
               & (strip(F.col("currency")) == rule.currency))
        username = F.when(hit, F.lit(rule.username)).otherwise(username)
    return df.withColumn("username", username)
