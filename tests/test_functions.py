"""Column functions, case by case."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerfold import functions as fn


def apply(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def check(spark, expr, cases, kind="string"):
    got = apply(spark, expr, list(cases), kind)
    assert dict(zip(cases, got)) == cases


def test_parse_amount(spark):
    cases = {"€1,234.56": "1234.56", "R$379.71": "379.71", "250477.99": "250477.99", "-13.84": "-13.84", "": "0",
             "nan": "0", None: "0", "N/A": "0", "-": "0", ".": "0", "-.": "0", "1.2.3": "0", "5-": "0", "-.5": "-0.5",
             "7.": "7", "1e5": "15", "(12)": "12", "1.00495": "1.00495"}
    check(spark, fn.parse_amount, {k: Decimal(v) for k, v in cases.items()})


def test_lenient_number(spark):
    cases = {"1234.56": "1234.56", "1,234.56": "0", " 7 ": "7", "x": "0", None: "0", "": "0", "-3.5": "-3.5"}
    check(spark, fn.lenient_number, {k: Decimal(v) for k, v in cases.items()})


def test_detect_currency(spark):
    check(spark, fn.detect_currency, {
        "€21.47": "EUR", "R$379.71": "BRL", "£10": "GBP", "$5": "USD", "MXN 100": "MXN", "1234.56": None, None: None,
        "": None, "100 COP": "COP", "PEN1": "PEN", "ARS": "ARS", "CLP 9": "CLP", "usd": None, "US$ R$": "BRL"})


def test_row_currency_takes_the_first_cell(spark):
    df = spark.createDataFrame([("1", "€2", "$3"), ("1", "2", None)], "a string, b string, c string")
    got = [r[0] for r in df.select(fn.row_currency([F.col(c) for c in "abc"])).collect()]
    assert got == ["EUR", None]


def test_normalize_login(spark):
    check(spark, fn.normalize_login, {
        "owner@gmail.com": "owner", "info@brand-one.com": "infobrand-one", "a@GMail.co.uk": "a", "a@gmailx.com": "agmailx",
        "Plain": "Plain", " Some_Panama ": "Some_Panama", "a@b": "ab", "@x.y": "x", "a@b@c.d": "ab@c", "a@gmail": "a",
        None: ""})


def test_keys_and_names(spark):
    check(spark, fn.norm_key, {"  BrandA ": "branda", "X": "x", None: "", " Y\t": "y"})
    check(spark, fn.platform_key, {" Income Access ": "incomeaccess", "IncomeAccess": "incomeaccess", None: ""})
    check(spark, lambda c: fn.canonical_operator(c, {"sportium": "SportiumBet"}), {
        "Sportium": "SportiumBet", " sportium ": "SportiumBet", "Other ": "Other ", None: ""})
    check(spark, fn.safe_name, {"A / b": "A___b", "a:b*c": "a_b_c", "": "report", "___": "report", "x.y-z": "x.y-z"})
    check(spark, fn.sanitize, {"BetsX": "BETSX", "info@b.com": "INFO_B_COM", "Tip page-BR": "TIP_PAGE_BR"})
    check(spark, fn.base_url, {"https://a.b:8080/x?y": "https://a.b:8080", "HTTP://h#t": "http://h", "//h/x": "://h",
                               "h/x": "://"})


def test_is_blank(spark):
    check(spark, fn.is_blank, {"": True, " ": True, "nan": True, "NaN": True, "None": True, None: True, "0": False,
                               "NONE": False, "x": False})
    check(spark, lambda c: fn.is_blank(c, ["0"], any_case=True), {"0": True, "NONE": True, "x": False})


@pytest.mark.parametrize("sheet, login, expected", [
    ("a", "a", True), ("a_north", "a", True), ("eu_a", "a", True), ("x_a_y", "a", True), ("ab_c", "a", False),
    ("a", "a_north", False), ("x", "", False), ("x_a_b_y", "a_b", True), ("xa_b", "a_b", False)])
def test_is_base_login(spark, sheet, login, expected):
    assert spark.range(1).select(fn.is_base_login(F.lit(sheet), F.lit(login))).head()[0] is expected


def test_merchant_username(spark):
    check(spark, lambda c: fn.merchant_username(c, F.lit("User")), {
        "Some AR CABA": "CABA_User", " One ": "One_User", "": "User", "  ": "User", None: "User"})


def test_decimal_comma(spark):
    check(spark, fn.decimal_comma, {"123.45": "123,45", "-1.5": "-1,5", "text": "text", "v1.2": "v1.2", "10": "10",
                                    "nan": "", "None": "", None: "", " 1.5 ": "1,5", "1.2.3": "1,2,3"})


def test_currency_and_netting_defaults(spark):
    pick = lambda brand: (lambda c: fn.currency_default(c, F.lit(brand), {"brasil": "BRL"}, "EUR"))
    check(spark, pick(" Brasil "), {"": "BRL", "0": "BRL", None: "BRL", "nan": "BRL", " USD ": "USD"})
    check(spark, pick("Other"), {"": "EUR", "0": "EUR", "GBP": "GBP"})
    check(spark, fn.netting_default, {"": "No", None: "No", "nan": "No", " Sí ": "Sí", "x": "x"})


@pytest.mark.parametrize("netting, cpa, rs, expected", [
    ("No", "6440.0", "-1601.38", "6440"), ("No", "0", "379.71", "379.71"), ("No", "0", "-2.96", "0"),
    ("No", "35", "0", "35"), ("Sí", "8710", "-126.34", "8583.66"), ("Sí", "10", "-50", "0"), ("Sí", "0", "-5", "0"),
    ("Sí", "100", "50", "150"), ("", "10", "-3", "7"), ("other", "10", "20", "30"), ("No", None, "5", "0"),
    ("Sí", None, None, "0"), (None, "1", "2", "3")])
def test_billing_total(spark, netting, cpa, rs, expected):
    money = lambda v: F.lit(v).cast("decimal(20,2)")
    got = spark.range(1).select(fn.billing_total(F.lit(netting).cast("string"), money(cpa), money(rs))).head()[0]
    assert got == Decimal(expected)


@pytest.mark.parametrize("value, rate, expected", [
    ("379.71", "5.8872", "64.50"), ("100", "1.0", "100.00"), ("10", "0", None), ("10", None, None), ("10.05", "2", "5.03"),
    ("-10.05", "2", "-5.03")])
def test_to_eur(spark, value, rate, expected):
    got = spark.range(1).select(fn.to_eur(F.lit(value).cast("decimal(20,2)"), F.lit(rate).cast("decimal(18,8)"))).head()[0]
    assert got == (None if expected is None else Decimal(expected))


def test_previous_month(spark):
    check(spark, fn.previous_month, {dt.date(2026, 6, 11): "2026-05", dt.date(2026, 1, 5): "2025-12",
                                     dt.date(2026, 3, 1): "2026-02"}, "date")
    assert [fn.closed_month(dt.date(*d)) for d in ((2026, 6, 11), (2026, 1, 5), (2026, 3, 1))] == ["2026-05", "2025-12", "2026-02"]
    check(spark, fn.is_month_label, {"2026-05": True, "2026-5": False, "2026-05-01": False})


def test_feed_timestamp_and_quote_month(spark):
    check(spark, fn.feed_timestamp, {
        "Mon, 01 Jun 2026 00:00:01 +0000": dt.datetime(2026, 6, 1, 0, 0, 1),
        "Thu, 31 Dec 2026 23:00:00 -0300": dt.datetime(2026, 12, 31, 23), "Mon, 31 Feb 2026 00:00:00 +0000": None,
        "2026-06-01 00:00:01": None, None: None})
    check(spark, lambda c: fn.quote_month(fn.feed_timestamp(c)), {"Mon, 01 Jun 2026 00:00:01 +0000": "2026-05", "x": ""})


def test_duration_and_status(spark):
    check(spark, fn.duration_text, {0.0: "00:00:00", 3661.4: "01:01:01", 59.5: "00:01:00", 2.5: "00:00:02",
                                    360000.0: "100:00:00"}, "double")
    check(spark, fn.step_status, {0: "OK", -1: "TIMEOUT", 2: "ERRO"}, "int")
