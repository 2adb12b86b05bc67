"""Raw platform exports to standard reports, for all accounts of a platform at once.

Raw frames hold text columns as exported plus `account_id`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import (CURRENCY_MARKERS, DEFAULT_COMMISSION_TYPES, HEADER_MAP, MEASURE_HEADERS, MONEY, ZERO_ROW_TEXT)
from ..functions import (bind, detect_currency, lenient_number, merchant_username, round2, row_currency,
                         strip)
from .filters import detail_only, drop_totals
from .joins import join_unique
from .layouts import BOM, value_currency

ACCOUNT_COLUMNS = ["platform", "operator", "brand", "username"]


# --- headers ---------------------------------------------------------------
def clean_headers(df: DataFrame) -> DataFrame:
    """Trim column names and drop a leading byte-order mark."""
    return df.toDF(*[c.strip().lstrip(BOM).strip() for c in df.columns])


def canonical_headers(df: DataFrame, keep: Sequence[str] = ("account_id",)) -> DataFrame:
    """Multilingual headers to canonical names. Headers of digits only (unnamed
    columns) are dropped; headers that meet in one name are coalesced in position
    order; unknown headers stay. `keep` columns are not headers."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        if c in keep:
            groups[c] = [c]
        elif not c.strip().isdigit():
            groups.setdefault(HEADER_MAP.get(c.lower(), c), []).append(c)
    return df.select(*[F.coalesce(*[F.col(f"`{c}`") for c in cols]).alias(name)
                       for name, cols in groups.items()])


def report_columns(df: DataFrame) -> DataFrame:
    """Measure headers to the column names of the standard reports."""
    return df.withColumnsRenamed(MEASURE_HEADERS)


# --- identification --------------------------------------------------------
def tag_accounts(df: DataFrame, accounts: DataFrame, month: str | Column,
                 currency: Column | None = None, stamp: bool = True) -> DataFrame:
    """Put the account's identification columns in front and the extraction time
    behind. Rows of accounts outside the registry have no identification and drop."""
    ids = accounts.select("account_id", *ACCOUNT_COLUMNS)
    out = df.join(ids, "account_id")
    front = ["account_id", *ACCOUNT_COLUMNS]
    month = F.lit(month) if isinstance(month, str) else month
    columns = [*front, month.alias("month")]
    if currency is not None:
        columns.append(F.coalesce(currency, F.lit("")).alias("currency"))
    taken = {*front, "month", *(["currency"] if currency is not None else [])}
    # A report column that differs from one of these by case only becomes row_<name>.
    columns += [F.col(f"`{c}`").alias(f"row_{c.lower()}" if c.lower() in taken else c)
                for c in df.columns if c not in taken]
    if stamp:
        columns.append(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("extracted_at"))
    return out.select(*columns)


# --- currencies ------------------------------------------------------------
CODES = sorted({code for _, code in CURRENCY_MARKERS})


def first_found(row: Column, col: Column, text: Column) -> Column:
    """Aggregate: currency of the first cell that has one, columns before rows.

    Column, row (10 and 19 digits) and currency go into one decimal, whose minimum is a
    fixed-width value: it is reduced by hash, without sorting cells."""
    codes = F.array(*[F.lit(c) for c in CODES])
    code = F.array_position(codes, detect_currency(text)).cast("decimal(2,0)")
    entry = (col.cast("decimal(10,0)") * F.lit(str(10 ** 21)).cast("decimal(22,0)")
             + row.cast("decimal(19,0)") * F.lit(100).cast("decimal(3,0)") + code).cast("decimal(38,0)")
    least = F.min(entry)
    return F.when(least.isNotNull(), F.element_at(codes, F.pmod(least, F.lit(100)).cast("int")))


def table_currency(cells: DataFrame, *groups: str) -> DataFrame:
    """First currency in each table, reading column by column. `cells` has the group
    columns, row_no, col_no and text."""
    return cells.groupBy(*groups).agg(
        first_found(F.col("row_no"), F.col("col_no"), F.col("text")).alias("currency"))


def shown_currency(cells: DataFrame, *groups: str) -> DataFrame:
    """First currency in the rows, else in the totals cells. `cells` has the group
    columns, row_no, text and is_total. All rows count: a page reader looks at the first ten
    only because it asks a browser for each one."""
    shown = F.when(~F.col("is_total"), F.col("text"))
    total = F.when(F.col("is_total"), F.col("text"))
    at = F.col("row_no")
    return cells.groupBy(*groups).agg(
        F.coalesce(first_found(at, F.lit(0), shown), first_found(at, F.lit(0), total)).alias("currency"))


def row_cells(df: DataFrame, columns: Sequence[str], *groups: str, row_no: str = "row_no") -> DataFrame:
    """Table columns to (groups, row_no, col_no, text) cells."""
    return df.select(*groups, F.col(row_no).alias("row_no"),
                     F.posexplode(F.array(*[F.col(f"`{c}`").cast("string") for c in columns]))
                     .alias("col_no", "text"))


# --- long reports ----------------------------------------------------------
def sum_by_type(df: DataFrame, *groups: str, kind: str = "commission_type",
                amount: str = "amount") -> DataFrame:
    """Sum plain numbers per commission type. Types are trimmed after grouping, so
    ' CPA' and 'CPA' stay two rows; a null type becomes ''."""
    sums = df.groupBy(*groups, F.col(f"`{kind}`").alias("_type")).agg(
        round2(F.sum(lenient_number(F.col(f"`{amount}`")))).alias("amount"))
    return sums.select(*groups, strip(F.coalesce(F.col("_type"), F.lit(""))).alias("commission_type"),
                       "amount")


def default_rows(empty_accounts: DataFrame) -> DataFrame:
    """Zero rows of every default commission type for accounts without results."""
    types = F.array(*[F.lit(t) for t in DEFAULT_COMMISSION_TYPES])
    return empty_accounts.select("account_id", F.explode(types).alias("commission_type"),
                                 F.lit(0).cast(MONEY).alias("amount"))


def zero_rows(empty_accounts: DataFrame, headers: Sequence[str]) -> DataFrame:
    """One zero row per account in the shape of a multilingual export."""
    value = lambda h: ("1" if h.lower() == "rowid"                       # noqa: E731
                       else "" if h.lower() in ZERO_ROW_TEXT else "0")
    return empty_accounts.select("account_id", *[F.lit(value(h)).alias(h) for h in headers])


# --- one standardiser per report shape -------------------------------------
def standardize_wide(raw: DataFrame, accounts: DataFrame, month: str) -> DataFrame:
    """Monthly tables: no totals rows, currency from each row's value cells."""
    df = clean_headers(raw)
    headers = [c for c in df.columns if c != "account_id"]
    df = drop_totals(df, headers[0])
    values = [F.col(f"`{c}`") for c in headers if c.lower() != "month"]
    coded = report_columns(df.withColumn("currency", row_currency(values)))
    return tag_accounts(coded, accounts, month, F.col("currency"))


def standardize_multilingual(raw: DataFrame, accounts: DataFrame, month: str) -> DataFrame:
    """Multilingual exports: canonical headers, detail rows only, the merchant's last
    word in front of the username."""
    df = clean_headers(raw)
    headers = [c for c in df.columns if c != "account_id"]
    df = detail_only(canonical_headers(drop_totals(df, headers[0])))
    out = tag_accounts(df, accounts, month)
    if "merchant" in out.columns:
        out = out.withColumn("username", merchant_username(F.col("merchant"), F.col("username"))).drop("merchant")
    return out.withColumnRenamed("username", "account_username")


def standardize_long(raw: DataFrame, shown: DataFrame, accounts: DataFrame, month: str,
                     empty_accounts: DataFrame | None = None) -> DataFrame:
    """Commission lists: sums per type, currency as shown on screen, zero rows for
    accounts that were read but have no results."""
    df = clean_headers(raw)
    sums = sum_by_type(df, "account_id", kind="Commission Type", amount="Amount")
    if empty_accounts is not None:
        sums = sums.unionByName(default_rows(empty_accounts))
    seen = shown_currency(shown, "account_id").withColumnRenamed("account_id", "_a")
    coded = join_unique(sums, seen, [(F.col("account_id"), "_a")], "left")
    return tag_accounts(coded, accounts, month, F.col("currency"))


def standardize_vendor(raw: DataFrame, scraped: DataFrame, accounts: DataFrame, month: str) -> DataFrame:
    """Vendor breakdowns: currency from the scraped table (`scraped` holds its cells),
    else from the export itself; rows from the export."""
    df = clean_headers(raw)
    headers = [c for c in df.columns if c not in ("account_id", "row_no")]
    first_row = lambda c: F.min(F.when(detect_currency(c).isNotNull(), F.struct(            # noqa: E731
        F.col("row_no"), detect_currency(c).alias("code"))))["code"]
    own = df.groupBy(F.col("account_id").alias("_a")).agg(
        F.coalesce(*[first_row(F.col(f"`{c}`")) for c in headers]).alias("_own"))
    seen = table_currency(scraped, "account_id").select(F.col("account_id").alias("_a"),
                                                        F.col("currency").alias("_seen"))
    coded = join_unique(df.drop("row_no"), seen, [(F.col("account_id"), "_a")], "left")
    coded = join_unique(coded, own, [(F.col("account_id"), "_a")], "left")
    tagged = tag_accounts(report_columns(coded), accounts, month, F.coalesce(F.col("_seen"), F.col("_own")))
    return tagged.drop("_seen", "_own")


# --- the same from landed reports of any layout ------------------------------
# Frames of `sources.exports.account_reports`: a column for each name of any layout, beside account_id,
# row_no, and each line's cells, its header and the names its layout has.
INNER_COLUMNS = ("row_no", "layout", "cells", "header", "names", "source")


def _report_rows(df: DataFrame) -> DataFrame:
    """Without totals rows: their first cell starts with 'total'."""
    first = F.lower(strip(F.coalesce(F.get("cells", F.lit(0)), F.lit(""))))
    return df.where(~F.startswith(first, F.lit("total")))


def _without_inner(df: DataFrame) -> DataFrame:
    return df.drop(*INNER_COLUMNS)


def landed_wide(reports: DataFrame, accounts: DataFrame, month: str) -> DataFrame:
    df = _report_rows(reports).withColumn("_currency", value_currency(F.col("cells"), F.col("header")))
    return tag_accounts(_without_inner(df), accounts, month, F.col("_currency")).drop("_currency")


def landed_multilingual(reports: DataFrame, accounts: DataFrame, month: str, files: DataFrame | None = None) -> DataFrame:
    """Detail rows of layouts that number their sections, all rows of others. `files` (account_id, header) of
    accounts whose export has a header only give a zero row in its shape."""
    df = _report_rows(reports)
    if "rowid" in df.columns:
        df = df.where(~F.array_contains("names", "rowid") | (strip(F.col("rowid")) == "1"))
    out = tag_accounts(_without_inner(df), accounts, month)
    if "merchant" in out.columns:
        out = out.withColumn("username", merchant_username(F.col("merchant"), F.col("username"))).drop("merchant")
    return out.withColumnRenamed("username", "account_username")


def zero_cells(header: Column) -> Column:
    """The cells of a zero row under a multilingual header."""
    return F.transform(header, lambda h: F.when(F.lower(h) == "rowid", "1").when(F.lower(h).isin(ZERO_ROW_TEXT), "").otherwise("0"))


def landed_long(reports: DataFrame, shown: DataFrame, accounts: DataFrame, month: str, empty_accounts: DataFrame) -> DataFrame:
    for name in ("Commission Type", "Amount"):
        if name not in reports.columns:
            reports = reports.withColumn(name, F.lit(None).cast("string"))
    return standardize_long(reports.select("account_id", "Commission Type", "Amount"), shown, accounts, month, empty_accounts)


def landed_vendor(reports: DataFrame, scraped: DataFrame, accounts: DataFrame, month: str) -> DataFrame:
    """Currency from the scraped table, else the first one of the export's cells, columns before rows."""
    codes = F.posexplode(F.transform("cells", detect_currency)).alias("at", "code")
    own = (reports.select(F.col("account_id").alias("_a"), "row_no", codes).where("code is not null")
           .groupBy("_a").agg(F.min(F.struct("at", "row_no", "code"))["code"].alias("_own")))
    seen = table_currency(scraped, "account_id").select(F.col("account_id").alias("_a"), F.col("currency").alias("_seen"))
    coded = join_unique(_without_inner(reports), seen, [(F.col("account_id"), "_a")], "left")
    coded = join_unique(coded, own, [(F.col("account_id"), "_a")], "left")
    return tag_accounts(coded, accounts, month, F.coalesce("_seen", "_own")).drop("_seen", "_own")


# --- ragged tables ---------------------------------------------------------
def pad_rows(rows: Column, headers: Column | None = None) -> Column:
    """Rows of one scraped table (array of cell arrays) padded with '' to the widest
    of its rows and its header."""
    def pad(table: Column) -> Column:
        widest = F.array_max(F.transform(table, F.size))
        if headers is not None:
            widest = F.greatest(widest, F.size(headers))
        return bind(widest, lambda width: F.transform(
            table, lambda r: F.concat(r, F.array_repeat(F.lit(""), width - F.size(r)))))
    return bind(rows, pad)


def pad_headers(headers: Column, width: Column) -> Column:
    """Header cells extended to `width` with invented names col_<position from 0>."""
    have = F.size(headers)
    extra = F.when(width > have, F.transform(F.sequence(have, F.greatest(width - F.lit(1), have)),
                                             lambda i: F.concat(F.lit("col_"), i.cast("string"))))
    return F.concat(headers, F.coalesce(extra, F.array().cast("array<string>")))


def scraped_table(table: DataFrame) -> DataFrame:
    """Scraped tables (account_id, headers, rows) to cells (account_id, row_no,
    col_no, header, text); tables without rows yield none. One record is one page's
    table, so padding needs no shuffle."""
    rows = table.where(F.size("rows") > 0).select(
        "account_id", pad_rows(F.col("rows"), F.col("headers")).alias("rows"), "headers")
    rows = rows.withColumn("headers", pad_headers(F.col("headers"), F.size(F.col("rows")[0])))
    lines = rows.select("account_id", "headers", F.posexplode("rows").alias("row_no", "cells"))
    return lines.select("account_id", "headers", "row_no", F.posexplode("cells").alias("col_no", "text")).select(
        "account_id", "row_no", "col_no", F.get("headers", F.col("col_no")).alias("header"), "text")
