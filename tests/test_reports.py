"""Adapters, standardisers and the scans that feed them."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerfold.contracts import LONG_REPORT, MULTILINGUAL_REPORT, VENDOR_REPORT, WIDE_REPORT, MeasureOverride, Rules
from ledgerfold.operators import adapters as ad
from ledgerfold.operators import standardize as st
from ledgerfold.operators.filters import drop_totals, select_accounts
from ledgerfold.sources.html_rows import html_rows

ACCOUNTS = [("1", "Wide", "OpA", "BrandA", "userA"), ("2", "Wide", "OpB", "BrandB", "userB")]


def accounts(spark):
    return spark.createDataFrame(ACCOUNTS, "account_id string, platform string, operator string, brand string, username string")


def test_wide_keeps_the_period_row(spark, rows):
    head = ("Wide", "OpA", "BrandA", "userA", "2026-05", "BRL")
    df = spark.createDataFrame([(*head, "2026-05", "R$379.71", "R$0.00", "R$5"), (*head, "2026-04", "R$10", "R$0", "R$5")], WIDE_REPORT)
    assert rows(ad.adapt_wide(df), "rs_amount", "cpa_amount") == [(D("379.71"), D(0))]
    override = Rules(measure_overrides=(MeasureOverride("OpA", "reward_due"),))
    assert rows(ad.adapt_wide(df, override), "rs_amount", "cpa_amount") == [(D(0), D(5))]


def test_long_sums_by_type(spark, rows):
    head = ("Long", "OpA", "BrandA", "userA", "2026-05", "EUR")
    data = [(*head, "CPA (x)", "40.0"), (*head, "Revshare y", "2.79"), (*head, "Fee", "5.0"),
            ("Long", "OpA", None, "u2", "2026-05", None, "Fee", "5.0")]
    out = ad.adapt_long(spark.createDataFrame(data, LONG_REPORT))
    assert rows(out, "brand", "username", "cpa_amount", "rs_amount") == sorted(
        [("BrandA", "userA", D(40), D("2.79")), (None, "u2", D(0), D(0))], key=repr)


def test_multilingual_drops_exact_copies(spark, rows):
    row = ("Lingual", "OpA", "BrandA", "userA", "2026-05", "EUR", "0.0", "7440.0")
    out = ad.adapt_multilingual(spark.createDataFrame([row, row], MULTILINGUAL_REPORT))
    assert rows(out, "username", "cpa_amount") == [("userA", D(7440))]


def test_vendor_takes_the_row_currency(spark, rows):
    row = ("V", "OpA", "BrandA", "userA", "2026-05", "USD", "MXN", None, "$1", "$2")
    out = ad.adapt_vendor(spark.createDataFrame([row], VENDOR_REPORT))
    assert rows(out, "currency", "vendor_name", "rs_amount", "cpa_amount") == [("MXN", "", D(1), D(2))]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([("x",)], "a string")
    b = spark.createDataFrame([("y", 1)], "a string, b int")
    assert [(r.a, r.b) for r in ad.union_reports([a, b]).orderBy("a").collect()] == [("x", None), ("y", 1)]


def test_standardize_wide(spark, rows):
    raw = spark.createDataFrame([("1", "May", "€1", "2"), ("1", " TOTAL", "€1", "2"), ("2", None, "1", "2"), ("9", "x", "1", "2")],
                                "account_id string, ` Month ` string, `Revenue Share Reward` string, Other string")
    out = st.standardize_wide(raw, accounts(spark), "2026-05")
    assert out.columns == ["account_id", "platform", "operator", "brand", "username", "month", "currency", "row_month",
                           "rs_reward", "Other", "extracted_at"]
    assert rows(out.select("account_id", "month", "currency", "row_month", "rs_reward")) == [
        ("1", "2026-05", "EUR", "May", "€1"), ("2", "2026-05", "", None, "1")]


def test_standardize_multilingual(spark, rows):
    raw = spark.createDataFrame(
        [("1", "1", "€", "10", None, "Some AR CABA"), ("1", "2", "€", "10", None, "x"), ("2", "1", "£", None, "7", None)],
        "account_id string, RowID string, `Símbolo da moeda` string, `Receita liquida` string, NetRev string, Merchant string")
    out = st.standardize_multilingual(raw, accounts(spark), "2026-05")
    assert rows(out.select("account_username", "month", "currency", "net_revenue")) == [
        ("CABA_userA", "2026-05", "€", "10"), ("userB", "2026-05", "£", "7")]


def test_standardize_long(spark, rows):
    raw = spark.createDataFrame([("1", " CPA", "5"), ("1", "CPA", "1"), ("1", None, "x"), ("1", "CPA", "2.005")],
                                "account_id string, `Commission Type` string, `﻿Amount` string")
    shown = spark.createDataFrame([("1", 11, "€5", False), ("1", 1, "5", False), ("1", 12, "£9", True)],
                                  "account_id string, row_no int, text string, is_total boolean")
    empty = spark.createDataFrame([("2",)], "account_id string")
    out = st.standardize_long(raw, shown, accounts(spark), "2026-05", empty)
    assert rows(out.select("account_id", "currency", "commission_type", "amount")) == sorted([
        ("1", "EUR", "CPA", D("5.00")), ("1", "EUR", "CPA", D("3.01")), ("1", "EUR", "", D("0.00")),
        ("2", "", "CPA", D("0.00")), ("2", "", "Revshare Ongoing PL", D("0.00"))], key=repr)


def test_standardize_vendor(spark, rows):
    raw = spark.createDataFrame([("1", 1, "V1", "$5"), ("2", 1, "V2", "£5")],
                                "account_id string, row_no int, `Vendor Name` string, Paid string")
    scraped = spark.createDataFrame([("1", 1, 0, "V1"), ("1", 2, 1, "$ 5"), ("1", 1, 2, "€ 5")],
                                    "account_id string, row_no int, col_no int, text string")
    out = st.standardize_vendor(raw, scraped, accounts(spark), "2026-05")
    assert rows(out.select("account_id", "currency", "vendor_name")) == [("1", "USD", "V1"), ("2", "GBP", "V2")]


def test_zero_rows(spark, rows):
    ids = spark.createDataFrame([("1",)], "account_id string")
    assert rows(st.zero_rows(ids, ["RowID", "Country", "Clicks"])) == [("1", "1", "", "0")]
    cells = spark.createDataFrame([(["RowID", "Country", "Clicks"],)], "header array<string>").select(st.zero_cells(F.col("header")))
    assert cells.head()[0] == ["1", "", "0"]


def test_ragged_table(spark, rows):
    df = spark.createDataFrame([("1", ["h"], [["a", "b", "c"], ["d"]]), ("2", ["h"], [])],
                               "account_id string, headers array<string>, rows array<array<string>>")
    cells = st.scraped_table(df)
    assert rows(cells) == sorted([
        ("1", 0, 0, "h", "a"), ("1", 0, 1, "col_1", "b"), ("1", 0, 2, "col_2", "c"), ("1", 1, 0, "h", "d"),
        ("1", 1, 1, "col_1", ""), ("1", 1, 2, "col_2", "")], key=repr)


def test_html_rows_take_the_largest_table(spark, rows):
    html = ("<table><tr><th>a</th></tr></table><table><thead><tr><th> h1 </th><th>h2</th></tr></thead>"
            "<tr><td>x &amp; y</td><td><b>1</b></td></tr><tr><td>z</td></tr></table>")
    pages = spark.createDataFrame([(1, html), (2, "<p>none</p>"), (3, None)], "page_id long, html string")
    assert rows(html_rows(pages)) == [(1, 1, 0, ["h1", "h2"]), (1, 1, 1, ["x & y", "1"]), (1, 1, 2, ["z"])]


def test_account_selection(spark, rows):
    data = [("1", " wide ", "OpA", "u", "http://x", "1"), ("2", "WIDE", "OpB", "u", "nan", "1"), ("3", "Wide", "opa", "u", "http://x", "4"),
            ("4", "Wide", "OpA", " ", "http://x", "1"), ("5", "Other", "OpA", "u", "http://x", "1"), ("6", "Wide", "OpB", "u", "http://x", "1 ")]
    a = spark.createDataFrame(data, "account_id string, platform string, operator string, username string, url string, active string")
    ids = lambda df: [r[0] for r in rows(df, "account_id")]
    assert ids(select_accounts(a, "wide")) == ["1", "6"]
    assert ids(select_accounts(a, "wide", active=("1", "4", "5"))) == ["1", "3", "6"]
    assert ids(select_accounts(a, "wide", operator=" OPA ")) == ["1"]
    assert ids(select_accounts(a, "wide", ids=[6, "x"])) == ["6"]
    assert ids(select_accounts(a, "wide", ids=spark.createDataFrame([(1,)], "i int"))) == ["1"]


def test_totals_rows_keep_null(spark):
    df = spark.createDataFrame([("Total x",), (None,), ("a total",)], "first string")
    assert drop_totals(df).count() == 2
    assert drop_totals(df.select(F.upper("first").alias("A b"))).count() == 2
