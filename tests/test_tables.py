"""Readers and writers in temporary folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerfold.contracts import ACCOUNTS, RATE_HISTORY, WIDE_REPORT, PendingFx, Rebase, Rules
from ledgerfold.operators.billing import published
from ledgerfold.session import settle
from ledgerfold.sinks import publish as pub
from ledgerfold.sinks import tables as tb
from ledgerfold.sinks.run_log import append_run_log, run_summary
from ledgerfold.sources import exports as ex
from ledgerfold.sources import tables as src
from ledgerfold.sources import worksheet as ws


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def test_report_with_colliding_headers(spark, tmp_path, rows):
    path = put(f"{tmp_path}/wide.csv", "﻿plataforma,operador,empresa,username,month,currency,Month,RS,CPA,Due\n"
               'Wide,"Op ""A""",B,u,2026-05,,2026-04,"1,5",2,3\n')
    df = src.read_report(spark, path, WIDE_REPORT)
    assert rows(df, "operator", "month", "currency", "row_month", "rs_reward") == [('Op "A"', "2026-05", None, "2026-04", "1,5")]
    assert src.read_report(spark, f"{tmp_path}/none.csv", WIDE_REPORT).count() == 0


def reports(spark, folder, accounts, names=None, merge=False, required=(), scraped=None):
    registry = spark.createDataFrame(accounts, "account_id string, file_name string")
    return ex.account_reports(ex.read_landing(spark, folder), registry, registry, names or {}, merge, required, scraped)


def test_exports_with_different_headers(spark, tmp_path, rows):
    folder = f"{tmp_path}/landing"
    put(f"{folder}/acc one.csv", "﻿Month,Reward\nMay,1\n")
    put(f"{folder}/two.csv", 'Reward,Month,month\n"5,0",Jun,x\n7,"a\nb",y\n')
    put(f"{folder}/three.csv", "Month,Reward\n")
    put(f"{folder}/four.csv", "Account_ID\nv\n\n")
    got = reports(spark, folder, [("1", "acc one"), ("2", "two"), ("3", "three"), ("4", "four")])
    assert got.columns == ["Account_ID", "Month", "Reward", "month__2"]
    assert rows(got.rows, "account_id", "Month", "Reward", "month__2", "row_account_id") == [
        ("1", "May", "1", None, None), ("2", "Jun", "5,0", "x", None), ("2", "a\nb", "7", "y", None), ("4", None, None, None, "v")]
    assert rows(got.empty_files(), "account_id") == [("3",)]
    # Files are read once: what follows comes from the written records, whatever the number of layouts.
    assert "csv" not in got.rows._jdf.queryExecution().toString().lower()


def test_no_cell_is_lost_in_a_wide_file(spark, tmp_path):
    folder = f"{tmp_path}/landing"
    put(f"{folder}/w.csv", ",".join(f"h{i}" for i in range(3000)) + "\n" + ",".join(f"v{i}" for i in range(3000)) + "\n" + '"q""q",' * 2999 + "\n")
    got = reports(spark, folder, [("1", "w")])
    first, second = got.rows.orderBy("row_no").collect()
    assert len(got.columns) == 3000 and (first["h0"], first["h299"], first["h2999"]) == ("v0", "v299", "v2999")
    assert second["h2998"] == 'q"q' and second["h2999"] is None


def test_a_bad_file_costs_its_account_only(spark, tmp_path, rows):
    folder = f"{tmp_path}/landing"
    put(f"{folder}/good.csv", "Amount,Kind\n1,a\n")
    put(f"{folder}/bad.csv", "Sum,Kind\n2,b\n")
    put(f"{folder}/shared.csv", "Amount,Kind\n3,c\n")
    put(f"{folder}/stranger.csv", "Amount,Kind\n4,d\n")
    got = reports(spark, folder, [("1", "good"), ("2", "bad"), ("3", "shared"), ("4", "shared")], required=("Kind", "Amount"))
    assert rows(got.rows, "account_id", "Amount") == [("1", "1")]
    assert rows(got.rejected, "file_name", "account_id", "reason") == [("bad", "2", "lacks amount"), ("shared", None, "several accounts")]
    assert rows(got.unregistered) == [("stranger",)] and got.empty_files().count() == 0


def test_scraped_tables_stand_in_for_missing_exports(spark, tmp_path, rows):
    folder = f"{tmp_path}/landing"
    put(f"{folder}/a.csv", "Kind,Amount\nx,1\n")
    put(f"{folder}/b.csv", "Kind,Amount\n")
    scraped = spark.createDataFrame([("1", ["Kind", "Amount"], [["page", "9"]]), ("2", ["Kind", "Amount"], [["page", "9"]]),
                                     ("3", [" Amount", "Kind"], [["5", "y", "more"], ["6"]]), ("4", ["Kind"], []), ("9", ["Kind"], [["z"]])],
                                    "account_id string, headers array<string>, rows array<array<string>>")
    got = reports(spark, folder, [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d"), ("5", "e")], scraped=scraped)
    assert rows(got.rows, "account_id", "Kind", "Amount", "col_2") == [("1", "x", "1", None), ("3", "y", "5", "more"), ("3", None, "6", None)]
    assert rows(got.files, "account_id", "source") == [("1", 0), ("2", 0), ("3", 1), ("4", 1)]
    assert rows(got.empty_files(), "account_id") == [("2",), ("4",)]


def test_empty_landing(spark, tmp_path):
    folder = f"{tmp_path}/landing"
    put(f"{folder}/none.csv", "")
    assert reports(spark, folder, [("1", "none")]).rows.count() == 0


def test_rate_feed_and_rules(spark, tmp_path, rows):
    feed = put(f"{tmp_path}/feed/day.json", json.dumps({
        "time_last_update_utc": "Mon, 01 Jun 2026 00:00:01 +0000", "base_code": "EUR", "conversion_rates": {"BRL": 5.5}}, indent=1))
    assert rows(src.read_rate_feed(spark, os.path.dirname(feed)), F.col("conversion_rates")["BRL"]) == [(5.5,)]
    assert src.read_rate_feed(spark, f"{tmp_path}/none").count() == 0
    path = put(f"{tmp_path}/rules.json", json.dumps({
        "pending": [{"platform": "p", "username": "u"}], "sheet_tabs": {"T": "B"}, "rebases": [{"brand": "x", "reported": "A", "restated": "C"}]}))
    rules = src.read_rules(spark, path)
    assert rules.pending == (PendingFx("p", "u"),) and rules.sheet_tabs == {"T": "B"}
    assert rules.rebases == (Rebase("x", "A", "C"),) and rules.operator_aliases == Rules().operator_aliases


def test_reference_order(spark, tmp_path, rows):
    path = put(f"{tmp_path}/ref.csv", "operador,username,empresa,ref,resta\n" + "".join(f"o,u,b,r{i},\n" for i in range(50)))
    df = src.read_reference(spark, path)
    assert [r.ref for r in df.orderBy("pos").collect()] == [f"r{i}" for i in range(50)]
    assert src.read_reference(spark, f"{tmp_path}/none").columns[-1] == "pos"
    assert src.read_accounts(spark, f"{tmp_path}/none").schema == ACCOUNTS
    assert src.read_rates(spark, f"{tmp_path}/none").schema == RATE_HISTORY


def cells(spark, *tabs):
    data = [(tab, i + 1, row) for tab, lines in tabs for i, row in enumerate(lines)]
    return spark.createDataFrame(data, "tab string, row_no int, cells array<string>")


def test_offset_header(spark, rows):
    df = cells(spark, ("t", [["title", "", ""], ["", "", ""], ["P", " U ", "R"], ["Net", "u1", "No"], ["Cell", "u2"], ["", " ", ""]]),
               ("short", [["P"]]))
    out = ws.read_offset_header(df, 3, {"u": "U", "p": "P", "gone": "X", "r": "R"})
    assert rows(out) == [("t", 4, "u1", "Net", "", "No"), ("t", 5, "u2", "Cell", "", "")]


def test_reference_sheet(spark, rows):
    head = ["Plataforma", "Usuario Referencia", "Operador Referencia", "RS / CPA / Fijo", "Resta"]
    lines = [["x"]] * 8 + [head, ["Netrefer", "u", "r", "RS", "No"]]
    out = ws.read_reference_sheet(cells(spark, ("A", lines), ("B", lines), ("Z", lines)), Rules(sheet_tabs={"B": "BrandB", "A": "BrandA"}))
    assert [r.brand for r in out.orderBy("pos").collect()] == ["BrandB", "BrandA"]


def test_partition_upsert(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    schema = "operator string, month string, v int"
    keys = ["operator", "month"]
    first = spark.createDataFrame([("A", "2026-04", 1), ("A", "2026-05", 2), ("B", "2026-06", 3), ("C", "2026-05", 4)], schema)
    assert sorted(tb.write_upsert(spark, path, first, keys)) == ["2026-04", "2026-05", "2026-06"]
    april = [f for f in sorted(os.listdir(f"{path}/month=2026-04")) if f.endswith(".parquet")]
    batch = spark.createDataFrame([("A", "2026-05", 9)], schema)
    purge = spark.createDataFrame([("A", "2026-05"), ("B", "2026-06")], "operator string, month string")
    tb.write_upsert(spark, path, batch, keys, purge)
    stored = tb.read_table(spark, path)
    assert dict(stored.dtypes)["month"] == "string"
    assert rows(stored.select("operator", "month", "v")) == [("A", "2026-04", 1), ("A", "2026-05", 9), ("C", "2026-05", 4)]
    assert not os.path.exists(f"{path}/month=2026-06")
    assert april == [f for f in sorted(os.listdir(f"{path}/month=2026-04")) if f.endswith(".parquet")]
    tb.write_upsert(spark, path, batch, keys)
    assert rows(tb.read_table(spark, path).select("operator", "month", "v")) == [("A", "2026-04", 1), ("A", "2026-05", 9), ("C", "2026-05", 4)]


KEYS = ["operator", "month"]
TABLE = "operator string, month string, v int"


def stored_rows(spark, path):
    table = tb.read_partitioned(spark, path, "month")
    return [] if table is None else sorted(((r.operator, r.month, r.v) for r in table.collect()), key=repr)


@pytest.mark.parametrize(("first", "batch", "purge", "left"), [
    # every touched month is purged, and the batch is empty
    ([("a", "2026-05", 1), ("b", "2026-04", 2)], [], [("a", "2026-05")], [("b", "2026-04", 2)]),
    ([("a", "2026-05", 1)], [], [("a", "2026-05")], []),
    # other keys of a null or empty month stay; both are one partition
    ([("a", None, 1), ("b", None, 2)], [("a", None, 9)], None, [("a", None, 9), ("b", None, 2)]),
    ([("a", "", 1), ("b", None, 2)], [("a", None, 9)], None, [("a", None, 9), ("b", None, 2)]),
    ([("a", None, 1), ("b", "2026-04", 2)], [], [("a", "")], [("b", "2026-04", 2)]),
    # a text month is no number
    ([("a", "01", 1), ("b", "01", 2), ("c", "1", 3)], [("a", "01", 9)], None, [("a", "01", 9), ("b", "01", 2), ("c", "1", 3)]),
    # names that a folder cannot have as they are
    ([("a", "x:1/%", 1), ("b", "y", 2)], [("b", "y", 3)], [("a", "x:1/%"), ("b", "y")], [("b", "y", 3)]),
    ([("a", "x:1", 1), ("b", "x:1", 2)], [], [("a", "x:1")], [("b", "x:1", 2)]),
    # keys that the store lacks; batch and purge in different months
    ([("a", "m1", 1)], [("a", "m2", 2)], [("z", "m1"), ("z", "m9")], [("a", "m1", 1), ("a", "m2", 2)]),
    ([("a", "m1", 1), ("b", "m1", 5)], [("a", "m2", 2)], [("a", "m1")], [("a", "m2", 2), ("b", "m1", 5)])])
def test_upsert_loses_nothing(spark, tmp_path, first, batch, purge, left):
    path = f"{tmp_path}/t"
    tb.write_upsert(spark, path, spark.createDataFrame(first, TABLE), KEYS)
    keys = None if purge is None else spark.createDataFrame(purge, "operator string, month string")
    tb.write_upsert(spark, path, spark.createDataFrame(batch, TABLE), KEYS, keys)
    assert stored_rows(spark, path) == sorted(left, key=repr)


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        settle(spark.range(1))


def test_failed_replacement_leaves_the_table(spark, tmp_path, rows, monkeypatch):
    path = f"{tmp_path}/t"
    tb.replace_table(spark, path, spark.range(2).toDF("v"))
    moved, calls = tb._moved, []

    def fails_at(n):
        def move(fs, source, target):
            calls.append(1)
            return False if len(calls) == n else moved(fs, source, target)
        return move

    for n in (1, 2):
        calls.clear()
        monkeypatch.setattr(tb, "_moved", fails_at(n))
        with pytest.raises(RuntimeError, match="as before"):
            tb.replace_table(spark, path, spark.range(5).toDF("v"))
        assert rows(spark.read.parquet(path)) == [(0,), (1,)]
    monkeypatch.undo()
    os.rename(path, f"{path}__old_crash")
    tb.recover_table(spark, path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,)]


def test_copies_in_a_batch_of_rates_are_one_row(spark, tmp_path):
    rate = spark.createDataFrame([("2026-05", "t1", "EUR", "BRL", "5"), ("2026-05", "t1", "EUR", "BRL", "5"), ("2026-05", "t1", "EUR", "USD", "2")], RATE_HISTORY)
    tb.append_rates(spark, f"{tmp_path}/rates", rate)
    files = sorted(os.listdir(f"{tmp_path}/rates"))
    tb.append_rates(spark, f"{tmp_path}/rates", rate)
    assert tb.read_table(spark, f"{tmp_path}/rates").count() == 2 and sorted(os.listdir(f"{tmp_path}/rates")) == files


def test_replace_and_append(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    tb.replace_table(spark, path, spark.range(3).toDF("v"))
    tb.replace_table(spark, path, spark.read.parquet(path).where("v > 0"))      # reads what it replaces
    tb.append_rows(spark.range(5, 6).toDF("v"), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,), (5,)]
    assert os.listdir(tmp_path) == ["t"]
    rate = spark.createDataFrame([("2026-05", "t1", "EUR", "BRL", "5")], RATE_HISTORY)
    for _ in range(2):
        tb.append_rates(spark, f"{tmp_path}/rates", rate)
    assert tb.read_table(spark, f"{tmp_path}/rates").count() == 1
    assert rows(settle(rate)) == rows(rate)


def test_publish(spark, tmp_path, rows):
    df = spark.createDataFrame([("Op", "u", "1.50", None), ("Op", "v", "x", "nan")], "Operador string, Login string, A string, B string")
    pub.publish(spark, df, f"{tmp_path}/full", "replace")
    pub.publish(spark, df, f"{tmp_path}/full", "replace")
    assert rows(spark.read.parquet(f"{tmp_path}/full")) == [("Op", "u", "1.50", ""), ("Op", "v", "x", "nan")]
    accounts = spark.createDataFrame([("1", "op", "U")], "account_id string, operator string, username string")
    pub.publish(spark, df, f"{tmp_path}/more")
    pub.publish(spark, df, f"{tmp_path}/more", accounts=accounts, ids=["1"])
    assert rows(spark.read.parquet(f"{tmp_path}/more")) == [("Op", "u", "1,50", ""), ("Op", "u", "1,50", ""), ("Op", "v", "x", "")]


def test_run_log(spark, tmp_path, rows):
    steps = [("2026-06-01T00:00:00", "2026-05", "rates", 0, 3661.0), ("2026-06-01T00:00:00", "2026-05", "unified", 2, 1.0)]
    append_run_log(spark, f"{tmp_path}/log", steps)
    append_run_log(spark, f"{tmp_path}/log", steps[:1])
    got = rows(spark.read.parquet(f"{tmp_path}/log"), "step", "returncode", "status", "duration")
    assert got == [("rates", 0, "OK", "01:01:01"), ("rates", 0, "OK", "01:01:01"), ("unified", 2, "ERRO", "00:00:01")]
    frame = spark.createDataFrame(steps, "run_at string, month string, step string, returncode int, seconds double")
    assert rows(run_summary(frame, "month")) == [("2026-05", 1, 1, "01:01:02")]


def test_published_columns(spark):
    from ledgerfold.contracts import PUBLISHED
    df = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in PUBLISHED.values()], F.lit(True).alias("pending_fx"))
    row = published(df).head()
    assert row.RS_Operador == row.TotalFacturacion_Operador == "Esperar cambio" and row.RS_EUR == "" and len(row) == 18
