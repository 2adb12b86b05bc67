"""Rates, reference, quality checks, upserts and the skew-safe join."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerfold.contracts import (RATE_FEED, RATE_HISTORY, AccountRename, PendingFx, Rebase, Rules, VendorKey)
from ledgerfold.operators import fx
from ledgerfold.operators import quality as q
from ledgerfold.operators import reference as ref
from ledgerfold.operators.upsert import upsert

UNION = "platform string, operator string, brand string, username string, month string, currency string, vendor_name string"


def rates(spark, *data):
    return fx.monthly_rates(spark.createDataFrame([("2026-05", ts, "EUR", c, r) for ts, c, r in data], RATE_HISTORY))


def test_earliest_quote(spark, rows):
    out = rates(spark, ("2026-06-02 00:00:00", "BRL", "6"), ("2026-06-01 00:00:00", "BRL ", "5.8872"), ("x", "USD", "1"),
                ("2026-06-09 00:00:00", "USD", "1.1"), ("2026-06-01 00:00:00", "GBP", "n/a"), ("2026-06-02 00:00:00", "GBP", "0.8"),
                ("2026-06-01 00:00:00", "MXN", "21"), ("2026-06-01 00:00:00", "MXN", "20"), ("bad", "COP", "4000"))
    assert rows(out) == [("2026-05", "BRL", D("5.88720000")), ("2026-05", "COP", D("4000.00000000")),
                         ("2026-05", "MXN", D("20.00000000")), ("2026-05", "USD", D("1.10000000"))]


def test_refresh_rates(spark, rows):
    feed = spark.createDataFrame([("Mon, 01 Jun 2026 00:00:01 +0000", "EUR", {"BRL": 5.5, "USD": 1.1, "GBP": None})], RATE_FEED)
    new, unknown = fx.refresh_rates(feed, None, ["BRL", "ZZZ"])
    assert rows(new) == [("2026-05", "2026-06-01 00:00:01", "EUR", "BRL", 5.5)]
    assert rows(unknown) == [("ZZZ",)]
    again, _ = fx.refresh_rates(feed, new)
    assert rows(again, "currency") == [("USD",)]


def test_conversion_and_restatement(spark, rows):
    r = rates(spark, ("2026-06-01 00:00:00", "BRL", "5"), ("2026-06-01 00:00:00", "EUR", "1"), ("2026-06-01 00:00:00", "ZER", "0"))
    df = spark.createDataFrame([("1", "2026-05", "EUR", "Brasil"), ("2", "2026-05", "EUR", "x"), ("3", " 2026-05", "BRL", "Brasil"),
                                ("4", "2026-04", "EUR", "Brasil"), ("5", "2026-05", "ZER", "x")],
                               "id string, month string, currency string, brand string")
    df = df.select("*", F.lit(10).cast("decimal(20,2)").alias("rs_amount"), F.lit(-3).cast("decimal(20,2)").alias("cpa_amount"))
    out = fx.rebase(fx.add_eur(fx.with_rate(df, r)), r, Rules(rebases=(Rebase("brasil", "EUR", "BRL"),)))
    got = {x.id: (x.currency, x.rs_amount, x.cpa_amount, x.rs_eur, x.rate) for x in out.collect()}
    assert got["1"] == ("BRL", D(50), D(-15), D(10), D(5))
    assert got["2"] == ("EUR", D(10), D(-3), D(10), D(1))
    assert got["3"] == ("BRL", D(10), D(-3), D(2), D(5))
    assert got["4"] == ("EUR", D(10), D(-3), None, None)
    assert got["5"] == ("ZER", D(10), D(-3), None, D(0))
    assert rows(fx.missing_rates(df, r)) == [("2026-04", "EUR")]


def test_pending_rows(spark, rows):
    df = spark.createDataFrame([("k1", " vendors", "A@b.c"), ("k2", "Vendors", "a@b.c"), ("k3", "Vendors", "z")],
                               "row_key string, platform string, username string")
    for c, v in (("rs_amount", 9), ("cpa_amount", 8), ("total_amount", 17), ("rs_eur", 2), ("cpa_eur", 1), ("total_eur", 3), ("rate", 7)):
        df = df.withColumn(c, F.lit(v).cast("decimal(20,2)"))
    marked = fx.mark_pending(df, Rules(pending=(PendingFx("Vendors", "a@B.c"),)))
    assert rows(marked, "row_key", "pending_fx", "rs_amount", "rate", "rs_eur") == [
        ("k1", True, None, None, D(2)), ("k2", True, None, None, D(2)), ("k3", False, D(9), D(7), D(2))]
    late = spark.createDataFrame([("k1", "5.5")], "row_key string, rate string")
    done = fx.resolve_pending_fx(marked, late)
    assert rows(done, "row_key", "pending_fx", "rs_amount", "total_amount", "rate") == [
        ("k1", False, D(11), D("16.5"), D("5.5")), ("k2", True, None, None, None), ("k3", False, D(9), D(17), D(7))]


def test_reference_join_and_vendor_key(spark, rows):
    r = spark.createDataFrame([("Betx", "AG1", "BrandA", "BETX EC", "No", 1), ("betx ", "ag1", "branda", "later", "Sí", 2),
                               ("Novi Mexico", "i@x.com", "BrandA", "NOVI MX", "Sí", 3), ("blank", "u", "BrandA", " ", "No", 4)],
                              "operator string, username string, brand string, ref string, netting string, pos int")
    u = spark.createDataFrame([("p", "Betx", "BrandA", "AG1", "m", "EUR", ""), ("p", "Novi", "BrandA", "i@x.com", "m", "EUR", "Novi Mexico"),
                               ("p", "blank", "BrandA", "u", "m", "EUR", ""), ("p", "none", "BrandA", None, "m", "EUR", "")], UNION)
    rules = Rules(vendor_keys=(VendorKey("novi", "branda"),))
    out = ref.enrich_reference(u, ref.reference_lookup(r), rules)
    assert rows(out, "operator", "ref", "netting") == sorted([
        ("Betx", "BETX EC", "No"), ("Novi", "NOVI MX", "Sí"), ("blank", None, "No"), ("none", None, None)], key=repr)
    assert rows(q.divergences(out), "operator") == [("blank",), ("none",)]


def test_account_rename(spark, rows):
    u = spark.createDataFrame([("p", " Op ", "b", "u", "m", "USD", ""), ("p", "Op", "b", "u", "m", "EUR", "")], UNION)
    out = ref.rename_accounts(u, Rules(account_renames=(AccountRename("Op", "USD", "u_panama"),)))
    assert rows(out, "currency", "username") == [("EUR", "u"), ("USD", "u_panama")]


SHEET = "brand string, platform string, username string, ref string, commission string, netting string, pos int"


def test_sheet_preference_and_netting(spark, rows):
    sheet = spark.createDataFrame([
        ("B", "Netrefer", "u1", "R", "CPA", "No", 1), ("B", "netrefer ", "u1", "R", " rs", "Sí", 2), ("B", "Netrefer", "u1", "R", "RS", "x", 3),
        ("B", "Netrefer", "u2", "R", "Fijo", "Sí", 4), ("B", "Elsewhere", "u3", "R", "RS", "Sí", 5), ("B", "Income Access", "u4", "R", "CPA", " ", 6),
        ("b", "Netrefer", "U5", "r", "RS", "No", 7), ("B", "Netrefer", "u5", "R", "RS", "Sí", 8)], SHEET)
    kept = ref.preferred_rows(sheet)
    assert rows(kept, "username", "pos") == [("U5", 7), ("u1", 2), ("u4", 6), ("u5", 8)]
    r = spark.createDataFrame([("o", "u1", "b", "r", "No"), ("o", "u2", "b", "r", " Old "), ("o", "u4", "B", "R", "Sí"),
                               ("o", "u5", "B", "R", "No"), ("o", "u6", "B", "R", "None")],
                              "operator string, username string, brand string, ref string, netting string")
    assert rows(ref.update_netting(r, kept), "username", "netting") == [
        ("u1", "Sí"), ("u2", "Old"), ("u4", "No"), ("u5", "Sí"), ("u6", "No")]


def test_missing_accounts_matches_brute_force(spark, rows):
    users = ["a", "a_b", "b_a", "x_a_y", "ab", "_a", "a_", "a__b", "", "A_B_C", "c", "_", "b_c_a"]
    logins = ["a", "b_c", "", "_b", "ab"]
    sheet = spark.createDataFrame([("B ", "Wide Net", u, i) for i, u in enumerate(users)], "brand string, platform string, username string, i int")
    accounts = spark.createDataFrame([("b", "widenet", x) for x in logins] + [("c", "widenet", "c")],
                                     "brand string, platform string, username string")
    base = lambda s, x: bool(x) and (s == x or s.startswith(x + "_") or s.endswith("_" + x) or f"_{x}_" in s)
    expected = [(u,) for u in users if not (u.lower() in logins or any(base(u.lower(), x) for x in logins))]
    assert rows(q.missing_accounts(sheet, accounts), "username") == sorted(expected, key=repr)


def test_ids_and_outcomes(spark, rows):
    accounts = spark.createDataFrame([("1", "Op", "u"), ("2", "Op", "v")], "account_id string, operator string, username string")
    df = spark.createDataFrame([("op ", "U"), ("Op", "v"), ("Op", "w")], "operator string, username string")
    assert rows(q.filter_by_ids(df, accounts, ["1"])) == [("op ", "U")]
    try:
        q.filter_by_ids(df, accounts, ["9"])
        raise AssertionError("unknown ids must fail")
    except ValueError:
        pass
    reports = spark.createDataFrame([("1",), ("1",)], "account_id string")
    log = spark.createDataFrame([("1", True), ("2", True)], "account_id string, ok boolean")
    assert rows(q.account_outcomes(accounts, reports, log), "account_id", "outcome", "n_rows") == [("1", "data", 2), ("2", "no data", 0)]
    assert rows(q.account_outcomes(accounts, reports), "account_id", "outcome") == [("1", "data"), ("2", "error")]


def test_upsert(spark, rows):
    old = spark.createDataFrame([("A", "2026-04", 10), ("A", "2026-05", 20), ("A", "2026-05", 21), ("B", "2026-05", 2), (None, "2026-05", 3)],
                                "operator string, month string, v int")
    new = spark.createDataFrame([("A", "2026-05", 99), ("", "2026-05", 4)], "operator string, month string, v int")
    keys = ["operator", "month"]
    once = upsert(old, new, keys)
    assert rows(once) == sorted([("A", "2026-04", 10), ("A", "2026-05", 99), ("B", "2026-05", 2), ("", "2026-05", 4)], key=repr)
    assert rows(upsert(once, new, keys)) == rows(once)
    purge = old.select(*keys)
    assert rows(upsert(old, new, keys, purge)) == rows(new)
    assert rows(upsert(None, new, keys)) == rows(new)
    assert rows(upsert(old.drop("month"), new, keys)) == rows(new)


def test_hot_key_is_split(spark):
    """A key with a third of the stored rows: its join partition is divided."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ids = spark.range(600000)
        old = ids.select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("k"),
                         F.sha2(F.col("id").cast("string"), 256).alias("v"))
        out = upsert(old, old.where("k like 'k1%'"), ["k"])
        assert out.agg(F.count("v")).head()[0] == 600000
        out.foreach(lambda _: None)
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_long_numbers_are_rejected_not_lost(spark, rows):
    from ledgerfold.functions import amount_fault, number_fault, rate_fault, round2, parse_amount, to_eur
    big = "1" * 29
    df = spark.createDataFrame([(f"€{big}", big, "0.000000001"), ("1" * 28, "1e40", "12000000000"), ("n/a", "1,5", "x"), (None, None, "0"), ("-.5", " 7 ", "1e-9")],
                               "money string, plain string, rate string")
    assert [tuple(r) for r in df.select(amount_fault(F.col("money")), number_fault(F.col("plain")), rate_fault(F.col("rate"))).collect()] == [
        ("too large", "too large", "too small"), (None, "too large", None), (None, None, None), (None, None, None), (None, None, "too small")]
    long = df.where("money = repeat('1', 28)").select(round2(parse_amount(F.col("money"))).alias("m"))
    assert rows(long.select("m", to_eur(F.col("m"), F.lit("12000000000").cast("decimal(28,8)")))) == [(D("1" * 28 + ".00"), D("92592592592592592.59"))]
    history = spark.createDataFrame([("2026-05", "t1", "EUR", "A", "0.000000001"), ("2026-05", "t1", "EUR", "B", "12000000000"), ("2026-05", "t1", "EUR", "C", "1" * 21)],
                                    "month string, quote_ts string, base_code string, currency string, rate string")
    assert rows(fx.monthly_rates(history)) == [("2026-05", "B", D("12000000000"))]
    assert rows(fx.rejected_rates(history), "currency", "reason") == [("A", "too small"), ("C", "too large")]


def test_rejected_amounts_leave_the_union(spark, rows):
    from ledgerfold.plans.unified import build_unified
    wide = spark.createDataFrame([("p", "o", "b", "u", "2026-05", "EUR", "2026-05", "1" * 30, "2"), ("p", "o", "b", "v", "2026-05", "EUR", "2026-05", "3", "4")],
                                 "platform string, operator string, brand string, username string, month string, currency string, row_month string, rs_reward string, cpa_reward string")
    rates = spark.createDataFrame([("2026-05", "2026-06-01 00:00:00", "EUR", "EUR", "1")], "month string, quote_ts string, base_code string, currency string, rate string")
    reference = spark.createDataFrame([("o", "u", "b", "R", "No", 1), ("o", "v", "b", "R", "No", 2)], "operator string, username string, brand string, ref string, netting string, pos int")
    built = build_unified({"wide": wide}, rates, reference)
    assert rows(built.unified, "username", "total_eur") == [("v", D("7.00"))]
    assert rows(built.rejected, "username", "column", "value", "reason") == [("u", "rs_reward", "1" * 30, "too large")]


def test_the_most_specific_rule_counts(spark, rows):
    from ledgerfold.operators.rule_table import most_specific
    keys = "platform string, operator string, brand string, default_currency string"
    rules = spark.createDataFrame([(None, None, None, "EUR"), ("p", None, None, "USD"), (None, "O ", "b", "BRL"), (None, "o", "b", "ZZZ"), ("P", None, "*", "GBP"), ("", None, None, "COP")], keys)
    df = spark.createDataFrame([("p", "x", "y", 1), (" P", "o", "B", 2), ("q", "o", "b", 3), ("q", None, "b", 4), ("p", "x", "*", 5), (None, "x", "y", 6), ("p", "x", "y", 1)],
                               "platform string, operator string, brand string, id int")
    on = {k: F.col(k) for k in ("platform", "operator", "brand")}
    out = most_specific(df, rules, on, ["default_currency"])
    assert rows(out, "id", "default_currency") == [(1, "USD"), (1, "USD"), (2, "BRL"), (3, "BRL"), (4, "EUR"), (5, "GBP"), (6, "COP")]
    assert rows(most_specific(df, rules.where("false"), on, ["default_currency"]), "default_currency") == [(None,)] * 7
    many = spark.createDataFrame([("p", f"o{i}", None, "USD") for i in range(100)], keys)
    plan = lambda r: most_specific(df, r, on, ["default_currency"])._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan(many).splitlines()) == len(plan(rules).splitlines())     # a hundred rules, the same plan


def test_currency_rules_fill_empty_currencies(spark, rows):
    from ledgerfold.plans.unified import normalise_union
    union = spark.createDataFrame([("p", "o", "b", "u", "2026-05", None, "", 1, 1), ("p", "o", "c", "v", "2026-05", "0", "", 1, 1), ("p", "o", "b", "w", "2026-05", "GBP", "", 1, 1), ("q", "o", "b", "x", "2026-05", "", "", 1, 1)],
                                  UNION + ", rs_amount int, cpa_amount int")
    table = spark.createDataFrame([("p", None, None, "USD"), ("p", None, "b", "BRL")], "platform string, operator string, brand string, default_currency string")
    assert rows(normalise_union(union, Rules(), table), "username", "currency") == [("u", "BRL"), ("v", "USD"), ("w", "GBP"), ("x", "EUR")]
