"""Platform reports to the common column set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import COMMON, RAW, Rules
from ..functions import parse_amount, strip
from .filters import same_month


def zero() -> Column:
    return F.lit(0).cast(RAW)


def common_columns(df: DataFrame, rs: Column, cpa: Column, vendor: Column | None = None,
                   keep: Sequence[str] = ("account_id",), **replaced: Column) -> DataFrame:
    """The six common columns (absent ones empty), vendor name and both measures.
    `account_id` travels along where ingestion supplied it."""
    base = [replaced.get(c, F.col(c) if c in df.columns else F.lit("")).alias(c) for c in COMMON]
    extra = [F.col(c) for c in keep if c in df.columns]
    return df.select(*base, (F.lit("") if vendor is None else vendor).alias("vendor_name"),
                     rs.alias("rs_amount"), cpa.alias("cpa_amount"), *extra)


def adapt_wide(report: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Monthly tables: keep the period's row, read both reward columns. Operators
    with a measure override take CPA from another column and no revenue share."""
    rows = same_month(report, "row_month", "month")
    rs, cpa = F.col("rs_reward"), F.col("cpa_reward")
    overridden = F.lit(False)
    operator = strip(F.coalesce(F.col("operator"), F.lit("")))
    for rule in rules.measure_overrides:
        if rule.cpa_column not in report.columns:
            continue
        hit = operator == rule.operator
        cpa = F.when(hit, F.col(rule.cpa_column)).otherwise(cpa)
        overridden = overridden | hit
    return common_columns(rows, F.when(overridden, zero()).otherwise(parse_amount(rs)),
                          parse_amount(cpa))


def adapt_vendor(report: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Vendor breakdowns: one row per vendor; the row's own currency wins over the
    account's where the report has one."""
    replaced = {"currency": F.col("row_currency")} if "row_currency" in report.columns else {}
    return common_columns(report, parse_amount(F.col("revshare_commission")),
                          parse_amount(F.col("cpa_commission")),
                          F.coalesce(F.col("vendor_name"), F.lit("")), **replaced)


def conditional_sums(df: DataFrame, keys: Sequence[str], kind: Column, amount: Column,
                     prefixes: dict[str, str]) -> DataFrame:
    """Per key, one sum per kind prefix. Kinds with another prefix add nothing but
    still create their key; null keys form groups."""
    label = F.lower(strip(F.coalesce(kind, F.lit(""))))
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(F.startswith(label, F.lit(prefix)), amount).otherwise(zero())).alias(name)
        for name, prefix in prefixes.items()])


def adapt_long(report: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Commission lists: one row per account, CPA and revenue share summed by type."""
    keys = [c for c in [*COMMON, "account_id"] if c in report.columns]
    sums = conditional_sums(report, keys, F.col("commission_type"), parse_amount(F.col("amount")),
                            {"cpa_amount": "cpa", "rs_amount": "revshare"})
    return common_columns(sums, F.col("rs_amount"), F.col("cpa_amount"))


def adapt_multilingual(report: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Multilingual exports: detail and totals repeat the same values, so exact
    copies collapse. Copies are removed inside each task before the shuffle."""
    if "username" not in report.columns and "account_username" in report.columns:
        report = report.withColumnRenamed("account_username", "username")
    return common_columns(report, parse_amount(F.col("pct_commission")),
                          parse_amount(F.col("cpa_commission"))).dropDuplicates()


ADAPTERS = {"wide": adapt_wide, "vendor": adapt_vendor, "long": adapt_long,
            "multilingual": adapt_multilingual}


def union_reports(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing from one frame is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
