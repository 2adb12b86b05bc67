"""Landing folder of platform exports whose headers differ from file to file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_per_key
from ..operators.joins import join_unique
from ..operators.layouts import (best_source, by_name, canonical_slots, clean_names, column_names, column_plan, header_mapping,
                                 layout_id, record_cells)
from ..session import settle

#: Cells that the reader takes of one record; a record with more fails the read.
MAX_CELLS = 1 << 17
#: Sources of an account's report, best first.
EXPORT, SCRAPED = 0, 1


@dataclass
class Landing:
    """Exports as data: `files` has (`_file`, `layout`, `header`), `lines` has (`_file`, `row_no`,
    `layout`, `cells`) for each line below a header. `row_no` only orders lines of a file."""
    files: DataFrame
    lines: DataFrame


def read_landing(spark: SparkSession, path: str, separator: str = ",", line_breaks: bool = True) -> Landing:
    """Read a folder's files once; each file's first record is its header.

    The reader splits records and keeps their raw text; cells are cut by `record_cells`, so a record may have
    any number of them. The records are written once to the shared folder; files, layouts
    and lines come from there. Cells may hold line breaks, which keeps a file in one task; without them (`line_breaks`
    off) a large file is split. The driver sees no file names."""
    scan = (spark.read.schema("_one string, _record string").option("columnNameOfCorruptRecord", "_record").option("header", False)
            .option("sep", separator).option("escape", '"').option("maxColumns", MAX_CELLS)
            .option("multiLine", line_breaks).option("recursiveFileLookup", True).csv(path))
    # A record of one cell fits the reader's schema; the raw text of any other one is in _record.
    cells = F.coalesce(record_cells(F.col("_record"), separator), F.array("_one"))
    records = settle(scan.select(
        F.col("_metadata.file_path").alias("_file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("row_no"),
        cells.alias("cells")))
    first = first_per_key(records, ["_file"], [F.col("row_no")])
    files = settle(first.select("_file", F.col("row_no").alias("_first"), clean_names(F.col("cells")).alias("header"))
                        .withColumn("layout", layout_id(F.col("header"))))
    head = files.select(F.col("_file").alias("_of"), "_first", "layout")
    lines = join_unique(records, head, [(F.col("_file"), "_of")], "inner").where(F.col("row_no") > F.col("_first"))
    return Landing(files.drop("_first"), lines.drop("_first"))


# --- files and accounts ------------------------------------------------------
def _file_name() -> Column:
    return F.url_decode(F.regexp_replace(F.element_at(F.split(F.col("_file"), "/"), -1), r"\.[A-Za-z]+$", ""))


def file_owners(landing: Landing, accounts: DataFrame) -> DataFrame:
    """Every file with its `file_name`, `account_id` and the number of accounts `owners` that carry the name. A name
    that several accounts carry belongs to none of them: its rows would count for each."""
    owners = accounts.groupBy(F.col("file_name").alias("_name")).agg(F.min("account_id").alias("account_id"), F.count(F.lit(1)).alias("owners"))
    named = join_unique(landing.files.withColumn("file_name", _file_name()), owners, [(F.col("file_name"), "_name")], "left")
    return named.withColumn("owners", F.coalesce("owners", F.lit(0))).withColumn("account_id", F.when(F.col("owners") == 1, F.col("account_id")))


def unregistered_files(owned: DataFrame) -> DataFrame:
    """Files whose name no account carries; their rows go nowhere."""
    return owned.where("owners = 0").select("file_name").distinct()


def rejected_files(owned: DataFrame, plan: DataFrame, required: Sequence[str]) -> DataFrame:
    """(file_name, account_id, reason) of files that cannot be used: several accounts own the name, or a required
    column is missing. The rows of other files are not touched by that."""
    needed = F.array(*[F.lit(c.lower()) for c in required]).cast("array<string>")
    names = plan.select(F.col("layout").alias("_layout"), F.array_except(needed, F.col("names")).alias("lacking"))
    seen = join_unique(owned.where("owners > 0"), names, [(F.col("layout"), "_layout")], "left")
    reason = (F.when(F.col("owners") > 1, "several accounts")
              .when(F.size("lacking") > 0, F.concat(F.lit("lacks "), F.array_join("lacking", ", "))))
    return seen.select("file_name", "_file", "account_id", reason.alias("reason")).where("reason is not null")


# --- one frame for all layouts and sources -----------------------------------
@dataclass
class Reports:
    """Reports of all accounts: `rows` by column name (see `by_name`) with `account_id`, `row_no`, `cells`,
    `header` and `names`; `files` (account_id, source, layout, header) of the best source of each
    account that could be used, `rejected` and `unregistered` files."""
    rows: DataFrame
    files: DataFrame
    rejected: DataFrame
    unregistered: DataFrame
    plan: DataFrame
    columns: list[str]

    def empty_files(self) -> DataFrame:
        """Files without a line, of accounts that have no line at all."""
        return join_unique(self.files, self.rows.select(F.col("account_id").alias("_a")).distinct(), [(F.col("account_id"), "_a")], "left_anti")

    def with_lines(self, lines: DataFrame) -> DataFrame:
        """The rows and more lines (account_id, layout, cells)."""
        more = lines.withColumn("row_no", F.lit(None).cast(self.rows.schema["row_no"].dataType))
        return self.rows.unionByName(by_name(more, self.plan, self.columns))


def scraped_lines(tables: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scraped tables (`account_id`, `headers`, `rows`) as (files, lines) of layouts, like exports. Short rows lack
    their last cells; cells behind the header have invented names col_<position>."""
    width = F.greatest(F.size("headers"), F.coalesce(F.array_max(F.transform("rows", F.size)), F.lit(0)))
    invented = F.transform(F.sequence(F.lit(0), F.greatest(width, F.lit(1)) - 1), lambda i: F.coalesce(F.get("headers", i), F.concat(F.lit("col_"), i.cast("string"))))
    files = tables.select("account_id", F.lit(SCRAPED).alias("source"), clean_names(F.slice(invented, F.lit(1), width)).alias("header"), "rows")
    files = files.withColumn("layout", layout_id(F.col("header")))
    lines = files.select("account_id", "source", "layout", F.posexplode("rows").alias("_at", "cells"))
    row_no = F.struct(F.lit(0).cast("long").alias("block"), F.col("_at").cast("long").alias("row"))
    return files.drop("rows"), lines.select("account_id", "source", row_no.alias("row_no"), "layout", "cells")


def account_reports(landing: Landing, accounts: DataFrame, registry: DataFrame, headers: Mapping[str, str], merge: bool,
                    required: Sequence[str] = (), scraped: DataFrame | None = None, counters=None) -> Reports:
    """The landed reports of the given accounts, all layouts in one frame. An account without a landed
    file takes its scraped table where there is one; a rejected file costs its own account only."""
    spark = landing.lines.sparkSession
    owned = settle(file_owners(landing, registry))
    wanted = accounts.select(F.col("account_id").alias("_a")).distinct()
    files = join_unique(owned.where("account_id is not null"), wanted, [(F.col("account_id"), "_a")], "left_semi")
    files = files.select("account_id", F.lit(EXPORT).alias("source"), "layout", "header", "_file")
    more = None
    if scraped is not None:
        pages, more = scraped_lines(join_unique(scraped, wanted, [(F.col("account_id"), "_a")], "left_semi"))
        files = files.unionByName(pages, allowMissingColumns=True)
    files = settle(best_source(files))
    layouts = files.select("layout", "header").distinct()
    slots = settle(canonical_slots(layouts, header_mapping(spark, headers), merge))
    names = column_names(slots)
    plan = settle(column_plan(layouts, slots, names))
    rejected = settle(rejected_files(owned, plan, required))
    bad = rejected.select(F.coalesce("_file", F.lit("")).alias("_bad")).distinct()
    files = join_unique(files, bad, [(F.coalesce("_file", F.lit("-")), "_bad")], "left_anti")
    owner = files.where(F.col("source") == EXPORT).select(F.col("_file").alias("_of"), "account_id")
    lines = join_unique(landing.lines, owner, [(F.col("_file"), "_of")], "inner").select("account_id", "row_no", "layout", "cells")
    if more is not None:
        paged = files.where(F.col("source") == SCRAPED).select(F.col("account_id").alias("_a")).distinct()
        lines = lines.unionByName(join_unique(more, paged, [(F.col("account_id"), "_a")], "left_semi").select(*lines.columns))
    if counters is not None:
        lines = counters.watch(lines, read=None)
    return Reports(settle(by_name(lines, plan, names)), files.drop("_file"), rejected.drop("_file"), unregistered_files(owned), plan, names)


def no_landing(spark: SparkSession) -> Landing:
    """A folder without files."""
    return Landing(spark.createDataFrame([], "_file string, header array<string>, layout string"),
                   spark.createDataFrame([], "_file string, row_no struct<block: bigint, row: bigint>, cells array<string>, layout string"))
