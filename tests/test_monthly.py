"""One month end to end, with a hand-computed result."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerfold.contracts import (ACCOUNTS, RATE_FEED, REFERENCE, AccountRename, MeasureOverride, PendingFx, Rebase, Rules, VendorKey)
from ledgerfold.operators import standardize as st
from ledgerfold.plans.monthly import MonthParams, run_month
from ledgerfold.sinks.tables import replace_table

MONTH = "2026-05"
RULES = Rules(
    operator_aliases={"sportium": "SportiumBet"}, brand_currency={"brasil": "BRL"}, rebases=(Rebase("brasil", "EUR", "BRL"),),
    measure_overrides=(MeasureOverride("OpOver", "reward_due"),),
    account_renames=(AccountRename("SportiumBet", "USD", "sport_panama"),),
    vendor_keys=(VendorKey("novi", "branda"),), pending=(PendingFx("Raventrack", "wait@example.com"),),
    sheet_tabs={"RS/CPA_A": "BrandA"})

ACCOUNT_ROWS = [
    ("1", "Netrefer", "OpA", "BrandA", "userA", "http://x", "f1", "1"),
    ("2", "Netrefer", "OpOver", "BrandA", "userB", "http://x", "f2", "1"),
    ("3", "Cellxpert", "Sportium", "BrandA", "sport", "http://x", "f3", "1"),
    ("4", "Cellxpert", "OpEmpty", "Brasil", "idle", "http://x", "f4", "1"),
    ("5", "Raventrack", "Novi", "BrandA", "info@example.com", "http://x", "f5", "1"),
    ("6", "Raventrack", "OpR", "BrandA", "wait@example.com", "http://x", "f6", "1"),
    ("7", "IncomeAccess", "OpI", "BrandA", "multi", "http://x", "f7", "1"),
]
REFERENCE_ROWS = [
    ("OpA", "userA", "BrandA", "REF A", "No", 1), ("OpOver", "userB", "BrandA", "REF B", None, 2),
    ("SportiumBet", "sport_panama", "BrandA", "REF S", "Sí", 3), ("OpEmpty", "idle", "Brasil", "REF E", "No", 4),
    ("Novi Mexico", "info@example.com", "BrandA", "REF N", "Sí", 5), ("OpR", "wait@example.com", "BrandA", "REF W", "No", 6),
    ("OpI", "CABA_multi", "BrandA", "REF I", "No", 7),
]
SHEET_HEAD = ["Plataforma", "Usuario Referencia", "Operador Referencia", "RS / CPA / Fijo", "Resta"]
SHEET_ROWS = [["Netrefer", "userA", "REF A", "RS", "Sí"], ["Netrefer", "ghost", "REF G", "CPA", "No"],
              ["Income Access", "CABA_multi", "REF I", "RS", ""]]


def standardised(spark):
    accounts = spark.createDataFrame(ACCOUNT_ROWS, ACCOUNTS)
    wide = spark.createDataFrame(
        [("1", MONTH, "€10.50", "€-2.25", "€9"), ("1", "2026-04", "€99", "€99", "€99"), ("1", "Total", "€1", "€1", "€1"),
         ("2", MONTH, "€100", "€200", "€1,300.10")],
        "account_id string, Month string, `Revenue Share Reward` string, `CPA Reward` string, `Reward Due` string")
    long = spark.createDataFrame([("3", "CPA (x)", "40"), ("3", "Revshare y", "-50.5"), ("3", "Fee", "7")],
                                 "account_id string, `Commission Type` string, Amount string")
    shown = spark.createDataFrame([("3", 1, "$40", False)], "account_id string, row_no int, text string, is_total boolean")
    empty = spark.createDataFrame([("4",)], "account_id string")
    vendor = spark.createDataFrame([("5", 1, "USD", "Novi Mexico", "11", "0"), ("5", 2, "USD", "Novi Peru", "5", "0"), ("6", 3, "EUR", "V", "3", "4")],
                                   "account_id string, row_no int, Currency string, `Vendor Name` string, `RevShare Commission` string, `CPA Commission` string")
    scraped = spark.createDataFrame([("5", 1, 0, "€1")], "account_id string, row_no int, col_no int, text string")
    lingual = spark.createDataFrame(
        [("7", "1", "", "8", "2", "Some CABA"), ("7", "2", "", "8", "2", "Some CABA")],
        "account_id string, RowID string, `Currency Symbol` string, `% Commission` string, `CPA Commission` string, Merchant string")
    return {"wide": st.standardize_wide(wide, accounts, MONTH),
            "long": st.standardize_long(long, shown, accounts, MONTH, empty),
            "vendor": st.standardize_vendor(vendor, scraped, accounts, MONTH),
            "multilingual": st.standardize_multilingual(lingual, accounts, MONTH)}


def prepare(spark, root):
    replace_table(spark, f"{root}/accounts", spark.createDataFrame(ACCOUNT_ROWS, ACCOUNTS))
    replace_table(spark, f"{root}/reference", spark.createDataFrame(
        REFERENCE_ROWS, ", ".join(f"{f.name} string" for f in REFERENCE) + ", pos int"))
    feed = spark.createDataFrame([("Mon, 01 Jun 2026 00:00:01 +0000", "EUR", {"EUR": 1.0, "BRL": 5.0, "USD": 1.25})], RATE_FEED)
    feed.coalesce(1).write.json(f"{root}/rate_feed")
    cells = [("RS/CPA_A", i + 1, row) for i, row in enumerate([["x"]] * 8 + [SHEET_HEAD] + SHEET_ROWS)]
    replace_table(spark, f"{root}/sheet_cells", spark.createDataFrame(cells, "tab string, row_no int, cells array<string>"))


def test_month(spark, tmp_path, rows):
    root = str(tmp_path)
    prepare(spark, root)
    log = run_month(spark, MonthParams(MONTH, root, rules=RULES), standardised(spark))
    assert [(step, code) for _, _, step, code, _ in log] == [
        (s, 0) for s in ("rates", "wide", "long", "vendor", "multilingual", "reference", "unified", "publish")]
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    got = {r.ref: r for r in read("unified").collect()}
    assert sorted(got) == ["REF A", "REF B", "REF E", "REF I", "REF N", "REF S", "REF W"]
    money = lambda r: (r.currency, r.rate, r.rs_amount, r.cpa_amount, r.rs_eur, r.cpa_eur, r.total_amount, r.total_eur)
    assert money(got["REF A"]) == ("EUR", D(1), D("10.50"), D("-2.25"), D("10.50"), D("-2.25"), D("8.25"), D("8.25"))
    assert got["REF A"].netting == "Sí" and got["REF A"].row_key == "2026-05REF ANetreferuserA"
    assert money(got["REF B"]) == ("EUR", D(1), D(0), D("1300.10"), D(0), D("1300.10"), D("1300.10"), D("1300.10"))
    assert got["REF B"].netting == "No"
    assert money(got["REF S"]) == ("USD", D("1.25"), D("-50.50"), D(40), D("-40.40"), D(32), D(0), D(0))
    assert (got["REF S"].operator, got["REF S"].username) == ("SportiumBet", "sport_panama")
    assert money(got["REF E"]) == ("BRL", D(5), D(0), D(0), D(0), D(0), D(0), D(0))
    assert money(got["REF N"]) == ("USD", D("1.25"), D(11), D(0), D("8.80"), D(0), D(11), D("8.80"))
    assert got["REF N"].origin == "Novi_infoexample"
    assert money(got["REF W"]) == ("EUR", None, None, None, D(3), D(4), None, D(7)) and got["REF W"].pending_fx
    assert money(got["REF I"]) == ("EUR", D(1), D(8), D(2), D(8), D(2), D(10), D(10))
    assert rows(read("divergences")) == [("Raventrack", "Novi", "info@example.com", "BrandA")]
    assert rows(read("missing_accounts"), "usuario_referencia") == [("ghost",)]
    assert read("missing_rates").count() == 0
    texts = {r.ReferenciaFacturacion: r for r in read("published").collect()}
    assert texts["REF A"].RS_Operador == "10,50" and texts["REF W"].RS_Operador == "Esperar cambio"
    assert texts["REF W"].ValorMoneda_XE == "" and texts["REF W"].TotalFacturacion_EUR == "7,00"
    assert {r.status for r in read("run_log").collect()} == {"OK"}

    # The same month again: nothing doubles, and an account without reference leaves the store.
    kept = spark.read.parquet(f"{root}/reference").where("ref <> 'REF I'")
    replace_table(spark, f"{root}/reference", kept)
    run_month(spark, MonthParams(MONTH, root, rules=RULES, skip=frozenset({"rates", "reference", "publish"})), standardised(spark))
    assert sorted(r.ref for r in read("unified").collect()) == ["REF A", "REF B", "REF E", "REF N", "REF S", "REF W"]
    assert read("rates").count() == 3

    # One account only: the others stay as stored.
    run_month(spark, MonthParams(MONTH, root, rules=RULES, ids=["1"], skip=frozenset({"rates", "reference", "publish"})), standardised(spark))
    assert read("unified").count() == 6


def test_bad_month_is_refused(spark, tmp_path):
    try:
        run_month(spark, MonthParams("2026-5", str(tmp_path)), {})
        raise AssertionError("must fail")
    except ValueError:
        pass


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_from_landed_files_to_published_rows(spark, tmp_path, rows):
    root = str(tmp_path)
    inactive = ("8", "Netrefer", "OpZ", "BrandA", "userZ", "http://x", "f8", "0")
    prepare(spark, root)
    replace_table(spark, f"{root}/accounts", spark.createDataFrame([*ACCOUNT_ROWS, inactive], ACCOUNTS))
    put(tmp_path / "landing_wide/f1.csv", "\ufeffMonth,Revenue Share Reward,CPA Reward,Reward Due\n2026-05,€10.50,€-2.25,€9\n2026-04,€99,€99,€99\nTotal,€1,€1,€1\n")
    put(tmp_path / "landing_wide/f2.csv", 'Month,Reward Due,CPA Reward,Revenue Share Reward\n2026-05,"€1,300.10",€200,€100\n')
    put(tmp_path / "landing_wide/f8.csv", "Month,Revenue Share Reward,CPA Reward,Reward Due\n2026-05,€5,€5,€5\n")
    put(tmp_path / "landing_wide/stranger.csv", "Month,Revenue Share Reward,CPA Reward,Reward Due\n2026-05,€7,€7,€7\n")
    put(tmp_path / "landing_long/f3.csv", "Commission Type,Amount\nCPA (x),40\nRevshare y,-50.5\nFee,7\n")
    put(tmp_path / "landing_long/f4.csv", "Commission Type,Amount\n")
    put(tmp_path / "landing_vendor/f5.csv", "Currency,Vendor Name,RevShare Commission,CPA Commission\nUSD,Novi Mexico,11,0\nUSD,Novi Peru,5,0\n")
    put(tmp_path / "landing_vendor/f6.csv", "Currency,Vendor Name,RevShare Commission,CPA Commission\nEUR,V,3,4\n")
    put(tmp_path / "landing_multilingual/f7.csv", "RowID,Currency Symbol,% Commission,CPA Commission,Merchant\n1,,8,2,Some CABA\n2,,8,2,Some CABA\n")
    replace_table(spark, f"{root}/shown_long", spark.createDataFrame([("3", 1, "$40", False)], "account_id string, row_no int, text string, is_total boolean"))
    replace_table(spark, f"{root}/scraped_vendor", spark.createDataFrame([("5", 1, 0, "€1")], "account_id string, row_no int, col_no int, text string"))
    log = run_month(spark, MonthParams(MONTH, root, rules=RULES))
    assert {(step, code) for _, _, step, code, _ in log} == {(s, 0) for s in ("rates", "wide", "long", "vendor", "multilingual", "reference", "unified", "publish")}
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    got = {r.ReferenciaFacturacion: (r.RS_Operador, r.CPA_Operador, r.TotalFacturacion_EUR) for r in read("published").collect()}
    assert sorted(got) == ["REF A", "REF B", "REF E", "REF I", "REF N", "REF S", "REF W"]
    assert got["REF A"] == ("10,50", "-2,25", "8,25") and got["REF B"][1] == "1300,10" and got["REF E"][2] == "0,00"
    assert rows(read("unregistered_wide")) == [("stranger",)]
    counted = {(r.step, r.counter): r.value for r in read("step_counters").collect()}
    assert {k: v for k, v in counted.items() if k[0] in ("rates", "wide", "long", "unified")} == {
        ("rates", "files"): 1, ("wide", "read"): 4, ("wide", "new"): 3, ("wide", "total"): 3, ("long", "read"): 3, ("long", "new"): 5, ("long", "total"): 5,
        ("unified", "read"): 8, ("unified", "with_rate"): 8, ("unified", "converted"): 0, ("unified", "removed"): 1, ("unified", "new"): 7, ("unified", "total"): 7}
    outcomes = {r.account_id: (r.outcome, r.n_rows) for shape in ("wide", "long", "vendor", "multilingual") for r in read(f"outcomes_{shape}").collect()}
    assert outcomes == {"1": ("data", 3), "2": ("data", 1), "3": ("data", 3), "4": ("no data", 0), "5": ("data", 2), "6": ("data", 1), "7": ("data", 2)}
    assert {r.platform: r.n_rows for r in read("load_counters").collect()} == {"Netrefer": 2, "Cellxpert": 2, "Raventrack": 3, "IncomeAccess": 1}

    # A unified step that fails leaves the published rows alone.
    before = read("published").count()
    replace_table(spark, f"{root}/accounts", spark.createDataFrame([], ACCOUNTS))
    log = run_month(spark, MonthParams(MONTH, root, rules=RULES, ids=["404"], skip=frozenset({"rates", "reference"})))
    assert {step: code for _, _, step, code, _ in log}["unified"] == 1 and "publish" not in {step for _, _, step, _, _ in log}
    assert read("published").count() == before


def test_late_rates_and_a_second_run(spark, tmp_path, rows):
    root = str(tmp_path)
    prepare(spark, root)
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    params = MonthParams(MONTH, root, rules=RULES)
    put(tmp_path / "landing_vendor/f6.csv", "Currency,Vendor Name,RevShare Commission,CPA Commission\nEUR,V,3,4\n")
    put(tmp_path / "landing_wide/f1.csv", "Month,Revenue Share Reward,CPA Reward,Reward Due\n2026-05,€10.50,€-2.25,€9\n")
    put(tmp_path / "landing_long/f3.csv", "Commission,Amount\nCPA,40\n")
    run_month(spark, params)
    assert rows(read("published"), "ReferenciaFacturacion", "RS_Operador", "ValorMoneda_XE") == [("REF A", "10,50", "1,00000000"), ("REF W", "Esperar cambio", "")]
    # A long report without its columns costs its account, not the shape.
    assert rows(read("rejected_long"), "file_name", "reason") == [("f3", "lacks commission type")]
    assert {r.account_id: r.outcome for r in read("outcomes_long").collect()} == {"3": "error", "4": "error"}

    # Again: nothing is published twice and no rate file is read again. A later month does not touch this one.
    run_month(spark, params)
    assert read("published").count() == 2 and read("publish_changes").count() == 0
    assert [r.value for r in read("step_counters").where("counter = 'files'").orderBy("run_at", "value").collect()] == [1, 0] or \
        sorted(r.value for r in read("step_counters").where("counter = 'files'").collect()) == [0, 1]

    # The late rate completes the stored month and its published form; other rows and months stay as they are.
    key = next(r.row_key for r in read("unified").collect() if r.ref == "REF W")
    replace_table(spark, f"{root}/late_rates", spark.createDataFrame([(key, "2.125"), ("other", "9"), ("bad", "x")], "row_key string, rate string"))
    put(tmp_path / "rate_feed/rewritten.json", '{"time_last_update_utc": "Wed, 01 Jul 2026 00:00:01 +0000", "base_code": "EUR", "conversion_rates": {"USD": 1.5}}')
    log = run_month(spark, MonthParams("2026-06", root, rules=RULES, shapes=(), skip=frozenset({"reference", "unified"})))
    assert {(s, c) for _, _, s, c, _ in log} == {("rates", 0), ("late_rates", 0)}
    done = {r.ref: r for r in read("unified").collect()}
    assert (done["REF W"].pending_fx, done["REF W"].rate, done["REF W"].rs_amount, done["REF W"].cpa_amount, done["REF W"].total_amount) == (False, D("2.125"), D("6.38"), D("8.50"), D("14.88"))
    assert done["REF A"].rs_amount == D("10.50") and len(done) == 2
    assert rows(read("published"), "ReferenciaFacturacion", "RS_Operador", "TotalFacturacion_Operador") == [("REF A", "10,50", "8,25"), ("REF W", "6,38", "14,88")]
    assert read("rates").count() == 4 and sorted(p.name for p in (tmp_path / "rates").iterdir() if p.is_dir()) == ["month=2026-05", "month=2026-06"]

    # Changed rows are named and stay as published.
    put(tmp_path / "landing_wide/f1.csv", "Month,Revenue Share Reward,CPA Reward,Reward Due\n2026-05,€11,€-2.25,€9\n")
    run_month(spark, params)
    assert rows(read("publish_changes"), "Index", "n_before", "n_rows") == [(done["REF A"].row_key, 1, 1)]
    assert rows(read("published"), "ReferenciaFacturacion", "RS_Operador") == [("REF A", "10,50"), ("REF W", "6,38")]


def test_converted_rows_are_counted(spark, tmp_path):
    root = str(tmp_path)
    prepare(spark, root)
    put(tmp_path / "landing_long/f4.csv", "Commission Type,Amount\nCPA,8\n")
    replace_table(spark, f"{root}/shown_long", spark.createDataFrame([("4", 1, "€8", False)], "account_id string, row_no int, text string, is_total boolean"))
    run_month(spark, MonthParams(MONTH, root, rules=RULES, shapes=("long",), skip=frozenset({"reference"})))
    (row,) = spark.read.parquet(f"{root}/unified").collect()
    assert (row.currency, row.cpa_amount, row.cpa_eur) == ("BRL", D(40), D(8))
    counted = {r.counter: r.value for r in spark.read.parquet(f"{root}/step_counters").where("step = 'unified'").collect()}
    assert counted == {"read": 1, "with_rate": 1, "converted": 1, "removed": 0, "new": 1, "total": 1}


def test_only_the_run_months_rates_are_read(spark, tmp_path):
    from ledgerfold.contracts import RATE_HISTORY
    from ledgerfold.sinks.tables import append_rates
    from ledgerfold.sources.tables import read_rates
    path = f"{tmp_path}/rates"
    rate = lambda m, c: (m, f"{m}-01 00:00:01", "EUR", c, "5")
    # A history that an earlier version wrote in one piece is partitioned first.
    spark.createDataFrame([rate("2026-03", "USD"), rate("", "ODD")], RATE_HISTORY).write.parquet(path)
    append_rates(spark, path, spark.createDataFrame([rate("2026-04", "USD"), rate("2026-03", "USD"), rate("", "ODD")], RATE_HISTORY))
    assert sorted((r.month, r.currency) for r in read_rates(spark, path).collect()) == [("", "ODD"), ("2026-03", "USD"), ("2026-04", "USD")]
    month = read_rates(spark, path, ["2026-04"])
    assert month.count() == 1 and len(month.inputFiles()) == 1 or "PartitionFilters: [" in month._jdf.queryExecution().executedPlan().toString()
    plan = month._jdf.queryExecution().executedPlan()
    plan.execute().count()
    assert "2026-04" in plan.toString().split("PartitionFilters")[1].split("PushedFilters")[0]


def test_feed_files_are_taken_once(spark, tmp_path):
    import os
    from ledgerfold.sinks.tables import append_rows
    from ledgerfold.sources.intake import LATENESS, file_paths, new_files
    feed, ledger = tmp_path / "feed", f"{tmp_path}/taken"
    now = 1_780_000_000
    at = lambda name, seconds: os.utime(feed / name, (now + seconds,) * 2)
    take = lambda choice="": new_files(spark, str(feed), ledger, choice)
    names = lambda df: sorted(os.path.basename(p) for p in file_paths(df))
    assert names(take()) == []
    for name, seconds in (("a.json", 0), ("b [1].json", 10)):
        put(feed / name, "{}")
        at(name, seconds)
    first = take("EUR")
    assert names(first) == ["a.json", "b \\[1\\].json"]
    append_rows(first, ledger)
    assert names(take("EUR")) == [] and len(names(take())) == 2   # other currencies of the same files are new
    append_rows(take(), ledger)
    assert names(take("USD")) == []                                 # taken whole: for every choice
    put(feed / "late.json", "{}")
    at("late.json", -3600)
    put(feed / "a.json", "{} ")
    at("a.json", 0)
    put(feed / "old.json", "{}")
    at("old.json", -LATENESS.total_seconds() - 60)
    assert names(take()) == ["a.json", "late.json"]                 # rewritten, and late within the rule
    assert "modifiedafter" in str(take()._jdf.queryExecution().logical()).lower() or len(names(take())) == 2


def test_counters_of_empty_frames(spark, tmp_path):
    from ledgerfold.sinks.counters import Counters
    counters = Counters()
    counters.watch(spark.range(5).where("id < 0 and id > 0"), read=None, odd=F.col("id") > 1).write.parquet(f"{tmp_path}/a")
    counters.watch(spark.range(5), read=None, odd=F.col("id") > 1).write.parquet(f"{tmp_path}/b")
    counters.watch(spark.createDataFrame([], "id long").where("false"), gone=None).write.parquet(f"{tmp_path}/c")
    assert counters.values() == {"read": 5, "odd": 3, "gone": 0}


def test_empty_multilingual_export_gives_a_zero_row(spark, tmp_path):
    prepare(spark, str(tmp_path))
    put(tmp_path / "landing_multilingual/f7.csv", "RowID,Currency Symbol,% Commission,CPA Commission\n")
    run_month(spark, MonthParams(MONTH, str(tmp_path), rules=RULES, shapes=("multilingual",), skip=frozenset({"reference", "unified"})))
    (row,) = spark.read.parquet(f"{tmp_path}/report_multilingual").collect()
    assert (row.account_username, row.pct_commission, row.cpa_commission) == ("multi", "0", "0")


def test_the_month_defaults_to_the_last_closed_one():
    from ledgerfold.functions import closed_month
    import datetime as dt
    assert MonthParams(None, "x").month == closed_month(dt.date.today()) and MonthParams(" 2026-05 ", "x").month == "2026-05"
