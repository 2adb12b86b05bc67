"""The monthly job: rates, landed exports, reports, reference, unified table, publication.

Stored tables below the root: accounts, reference, rates, rate_feed, sheet_cells; landing_<shape> (folders
of exports), scraped_tables_<shape> (account_id, headers, rows: pages of accounts that landed no export),
shown_long and scraped_vendor (cells of pages read beside an export), extraction_log
(account_id, ok), late_rates (row_key, rate), currency_rules (platform, operator, brand, default_currency); rate_feed_taken, report_<shape>, outcomes_<shape>, unregistered_<shape>, rejected_<shape>, unified, load_counters,
divergences, rejected_amounts, rejected_amounts_long, rejected_rates, missing_rates, missing_accounts, published, publish_changes, run_log, step_counters."""

from __future__ import annotations

import datetime as dt
import re
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import HEADER_MAP, MEASURE_HEADERS, UNION_KEYS, Rules
from ..functions import closed_month, norm_key, number_fault, strip
from ..operators.billing import published
from ..operators.filters import ACTIVE, ACTIVE_MULTILINGUAL, only_month, select_accounts
from ..operators.fx import completed_rows, refresh_rates, rejected_rates
from ..operators.joins import join_unique
from ..operators.quality import account_outcomes, filter_by_ids, load_counters, missing_accounts_report, split_faults
from ..operators.reference import refresh_reference
from ..operators.standardize import landed_long, landed_multilingual, landed_vendor, landed_wide, scraped_table, zero_cells
from ..session import settle
from ..sinks.counters import Counters, append_counters
from ..sinks.publish import publish_new, republish
from ..sinks.run_log import append_run_log
from ..sinks.tables import (append_rates, append_rows, partition_text, read_partitioned, read_table, replace_table, table_exists,
                            touched_values, write_upsert)
from ..sources.exports import Reports, account_reports, no_landing, read_landing
from ..sources.intake import file_paths, new_files
from ..sources.tables import read_accounts, read_rate_feed, read_rates, read_reference
from ..sources.worksheet import read_reference_sheet
from .unified import build_unified

REPORT_KEYS = {
    "wide": ["operator", "username", "month"],
    "long": ["operator", "username", "month"],
    "vendor": ["operator", "username", "month"],
    "multilingual": ["operator", "account_username", "month"],
}
# Platform of each report shape, and the active flags that take part.
PLATFORMS = {"wide": "netrefer", "long": "cellxpert", "vendor": "raventrack", "multilingual": "incomeaccess"}
ACTIVE_FLAGS = {"multilingual": ACTIVE_MULTILINGUAL}
# Header names of each shape, whether headers that meet in one share its cells, and columns a file cannot lack.
HEADERS = {"wide": (MEASURE_HEADERS, False), "long": ({}, False), "vendor": (MEASURE_HEADERS, False), "multilingual": (HEADER_MAP, True)}
REQUIRED = {"long": ("Commission Type", "Amount")}


@dataclass
class MonthParams:
    """What to run. `root` is the folder of stored tables; see `table_path`. Without a month it is the
    last one that is over."""
    month: str | None
    root: str
    shapes: Sequence[str] = tuple(REPORT_KEYS)
    operator: str | None = None
    ids: Sequence[str] | None = None
    currencies: Sequence[str] = ()
    rules: Rules = field(default_factory=Rules)
    skip: frozenset = frozenset()       # of: rates, reference, unified, publish

    def __post_init__(self) -> None:
        self.month = (self.month or "").strip() or closed_month(dt.date.today())

    def table_path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def chosen(df: DataFrame, params: MonthParams, accounts: DataFrame) -> DataFrame:
    """Report rows of the wanted operator and account ids."""
    if params.operator:
        df = df.where(norm_key(F.col("operator")) == params.operator.strip().lower())
    if not params.ids:
        return df
    if "account_id" in df.columns:
        return df.where(strip(F.col("account_id")).isin([str(i).strip() for i in params.ids]))
    named = df if "username" in df.columns else df.withColumn("username", F.col("account_username"))
    return filter_by_ids(named, accounts, params.ids).select(*df.columns)


def rates_step(spark: SparkSession, p: MonthParams) -> dict[str, int]:
    """Feed files that no earlier run took (for the same currencies) to the rate history."""
    folder, ledger = p.table_path("rate_feed"), p.table_path("rate_feed_taken")
    files = settle(new_files(spark, folder, ledger, ",".join(sorted(p.currencies))))
    paths = file_paths(files)
    if paths:
        rows, _ = refresh_rates(read_rate_feed(spark, paths), None, p.currencies)
        append_rates(spark, p.table_path("rates"), rows.withColumn("rate", F.col("rate").cast("string")))
        append_rows(files, ledger)
    return {"files": len(paths)}


def side_table(spark: SparkSession, p: MonthParams, name: str, schema: str) -> DataFrame:
    found = read_table(spark, p.table_path(name))
    return spark.createDataFrame([], schema) if found is None else found


def standardise_landed(spark: SparkSession, p: MonthParams, shape: str, reports: Reports, accounts: DataFrame) -> DataFrame:
    """Landed reports of a shape, whatever their layouts, to its standard report."""
    empty = reports.empty_files()
    if shape == "wide":
        return landed_wide(reports.rows, accounts, p.month)
    if shape == "multilingual":
        zeros = empty.select("account_id", "layout", zero_cells(F.col("header")).alias("cells"))
        return landed_multilingual(reports.with_lines(zeros), accounts, p.month)
    if shape == "long":
        good, bad = split_faults(reports.rows, {"Amount": number_fault(F.col("Amount"))} if "Amount" in reports.columns else {}, "account_id")
        replace_table(spark, p.table_path("rejected_amounts_long"), bad)
        shown = side_table(spark, p, "shown_long", "account_id string, row_no int, text string, is_total boolean")
        return landed_long(good, shown, accounts, p.month, empty.select("account_id").distinct())
    seen = side_table(spark, p, "scraped_vendor", "account_id string, row_no int, col_no int, text string")
    tables = side_table(spark, p, "scraped_tables_vendor", "account_id string, headers array<string>, rows array<array<string>>")
    cells = scraped_table(tables).select("account_id", "row_no", "col_no", "text").unionByName(seen)
    return landed_vendor(reports.rows, cells, accounts, p.month)


def landed_outcomes(spark: SparkSession, p: MonthParams, reports: Reports, accounts: DataFrame) -> DataFrame:
    """Outcome of every account. One whose file was rejected failed, whatever the extraction log says."""
    failed = reports.rejected.where("account_id is not null").select("account_id", F.lit(False).alias("ok"))
    log = read_table(spark, p.table_path("extraction_log"))
    log = reports.files.select("account_id", F.lit(True).alias("ok")) if log is None else log.select("account_id", "ok")
    log = join_unique(log, failed.select(F.col("account_id").alias("_a")).distinct(), [(F.col("account_id"), "_a")], "left_anti").unionByName(failed)
    return account_outcomes(accounts.select("account_id", "platform", "operator", "username"), reports.rows.select("account_id"), log)


def landed_step(shape: str) -> Callable[[SparkSession, MonthParams], dict[str, int] | None]:
    """Landed exports of the shape's active accounts to its stored report, with the outcome of every
    account, the files that belong to none and those that cannot be used."""
    def run(spark: SparkSession, p: MonthParams) -> dict[str, int] | None:
        folder = p.table_path(f"landing_{shape}")
        registry = read_accounts(spark, p.table_path("accounts"))
        accounts = select_accounts(registry, PLATFORMS[shape], p.operator, p.ids or None, ACTIVE_FLAGS.get(shape, ACTIVE))
        scraped = read_table(spark, p.table_path(f"scraped_tables_{shape}"))
        if not table_exists(spark, folder) and scraped is None:
            return None
        landing = read_landing(spark, folder) if table_exists(spark, folder) else no_landing(spark)
        counters = Counters()
        reports = account_reports(landing, accounts, registry, *HEADERS[shape], REQUIRED.get(shape, ()), scraped, counters)
        replace_table(spark, p.table_path(f"unregistered_{shape}"), reports.unregistered)
        replace_table(spark, p.table_path(f"rejected_{shape}"), reports.rejected)
        rows = standardise_landed(spark, p, shape, reports, accounts)
        replace_table(spark, p.table_path(f"outcomes_{shape}"), landed_outcomes(spark, p, reports, accounts))
        write_upsert(spark, p.table_path(f"report_{shape}"), rows, REPORT_KEYS[shape], counters=counters)
        return counters.values()
    return run


def report_step(shape: str, standardised: DataFrame) -> Callable[[SparkSession, MonthParams], dict[str, int]]:
    def run(spark: SparkSession, p: MonthParams) -> dict[str, int]:
        counters = Counters()
        rows = chosen(standardised, p, read_accounts(spark, p.table_path("accounts")))
        write_upsert(spark, p.table_path(f"report_{shape}"), rows, REPORT_KEYS[shape], counters=counters)
        return counters.values()
    return run


def reference_step(spark: SparkSession, p: MonthParams) -> None:
    sheet = read_reference_sheet(spark.read.parquet(p.table_path("sheet_cells")), p.rules)
    reference = read_reference(spark, p.table_path("reference"))
    missing = missing_accounts_report(sheet, read_accounts(spark, p.table_path("accounts")), p.rules)
    replace_table(spark, p.table_path("missing_accounts"), missing)
    replace_table(spark, p.table_path("reference"), refresh_reference(sheet, reference, p.rules))


def unified_step(spark: SparkSession, p: MonthParams) -> dict[str, int]:
    counters = Counters()
    stored = {shape: read_partitioned(spark, p.table_path(f"report_{shape}"), "month") for shape in REPORT_KEYS}
    reports = {k: only_month(v, p.month) for k, v in stored.items() if v is not None}
    rates = read_rates(spark, p.table_path("rates"), [p.month])
    replace_table(spark, p.table_path("rejected_rates"), rejected_rates(rates))
    built = build_unified(reports, rates,
                          read_reference(spark, p.table_path("reference")), p.rules,
                          read_accounts(spark, p.table_path("accounts")), p.ids, counters=counters,
                          currency_rules=read_table(spark, p.table_path("currency_rules")))
    replace_table(spark, p.table_path("divergences"), built.divergences)
    replace_table(spark, p.table_path("rejected_amounts"), built.rejected)
    replace_table(spark, p.table_path("load_counters"), load_counters(built.enriched, "platform"))
    replace_table(spark, p.table_path("missing_rates"), built.missing_rates)
    write_upsert(spark, p.table_path("unified"), built.unified, UNION_KEYS, built.processed_keys, counters=counters)
    return counters.values()


def late_rates_step(spark: SparkSession, p: MonthParams) -> dict[str, int]:
    """Rates that came after a month was built (`late_rates`: row_key, rate) complete the rows that wait for them, in every stored
    month, and their published form. Waiting rows are found by the files' statistics; only months
    that hold one with a rate now are read whole and rewritten."""
    stored = read_partitioned(spark, p.table_path("unified"), "month")
    if stored is None:
        return {"completed": 0}
    rows, found = completed_rows(stored, read_table(spark, p.table_path("late_rates")))
    months = touched_values("month", settle(found))
    if not months:
        return {"completed": 0}
    counters = Counters()
    here = stored.where(partition_text("month").isin(months))
    rows = settle(counters.watch(completed_rows(here, read_table(spark, p.table_path("late_rates")))[0], completed=None))
    write_upsert(spark, p.table_path("unified"), rows, ["row_key", "month"])
    republish(spark, published(rows), p.table_path("published"))
    return counters.values()


def publish_step(spark: SparkSession, p: MonthParams) -> None:
    """Rows not published yet; keys published in another form before are written to `publish_changes`."""
    rows = only_month(read_partitioned(spark, p.table_path("unified"), "month"), p.month)
    changed = publish_new(spark, published(rows), p.table_path("published"))
    replace_table(spark, p.table_path("publish_changes"), changed)


def run_month(spark: SparkSession, params: MonthParams,
              standardised: Mapping[str, DataFrame] | None = None) -> list[tuple]:
    """Run the month's steps in order. Reports come from the landing folders, or from
    `standardised` (by shape) where it is given. A failed step is logged and later steps still
    run, as each reads stored tables; only publication needs a unified table of this run.
    Returns the run-log rows; raises nothing once the parameters are right."""
    if not re.fullmatch(r"\d{4}-\d{2}", params.month):
        raise ValueError("month must look like 2026-05")
    steps = [("rates", rates_step)]
    if standardised is None:
        steps += [(shape, landed_step(shape)) for shape in REPORT_KEYS if shape in params.shapes]
    else:
        steps += [(shape, report_step(shape, df)) for shape, df in standardised.items() if shape in params.shapes]
    steps += [("reference", reference_step), ("unified", unified_step)]
    if table_exists(spark, params.table_path("late_rates")):
        steps.append(("late_rates", late_rates_step))
    steps.append(("publish", publish_step))
    skip = set(params.skip) | ({"publish"} if "unified" in params.skip else set())
    log, counted = [], []
    run_at = dt.datetime.now().isoformat(timespec="seconds")
    for name, step in steps:
        if name in skip:
            continue
        start, code = time.monotonic(), 0
        try:
            counted += [(run_at, params.month, name, counter, n) for counter, n in (step(spark, params) or {}).items()]
        except Exception as error:      # one failed step must not hide the others
            print(f"[{name}] failed: {error}")
            code = 1
            skip |= {"publish"} if name == "unified" else set()
        log.append((run_at, params.month, name, code, time.monotonic() - start))
    append_run_log(spark, params.table_path("run_log"), log)
    append_counters(spark, params.table_path("step_counters"), counted)
    return log
