"""Worksheet tabs landed as cells (tab, row_no from 1, cells array<string>)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import SHEET_COLUMNS, SHEET_HEADER_ROW, Rules
from ..functions import strip
from ..operators.filters import any_filled


def read_offset_header(cells: DataFrame, header_row: int, columns: Mapping[str, str]) -> DataFrame:
    """Rows below a header that stands in row `header_row` of each tab, as (tab,
    row_no, wanted columns). Columns are found by header name, absent ones are '';
    rows empty in all wanted columns drop. Tabs with fewer rows yield nothing.

    Headers are joined as data (one row per tab), so all tabs take one scan."""
    headers = cells.where(F.col("row_no") == header_row).select(
        "tab", F.transform("cells", strip).alias("_header"))
    place = lambda name: F.array_position("_header", name).cast("int") - F.lit(1)      # noqa: E731
    cell = lambda name: F.when(place(name) >= 0, F.get("cells", place(name)))          # noqa: E731
    rows = cells.where(F.col("row_no") > header_row).join(headers, "tab")
    out = rows.select("tab", "row_no", *[F.coalesce(cell(header), F.lit("")).alias(name)
                                         for name, header in columns.items()])
    return out.where(any_filled(list(columns)))


def read_reference_sheet(cells: DataFrame, rules: Rules,
                         header_row: int = SHEET_HEADER_ROW) -> DataFrame:
    """The reference tabs with their brand (from the tab's name) and `pos`, the place
    of a row in tab order."""
    order = {tab: i for i, tab in enumerate(rules.sheet_tabs)}
    tab_map = F.create_map(*[F.lit(x) for pair in rules.sheet_tabs.items() for x in pair])
    tab_no = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    rows = read_offset_header(cells.where(F.col("tab").isin(list(order))), header_row, SHEET_COLUMNS)
    return rows.select(tab_map[F.col("tab")].alias("brand"), *SHEET_COLUMNS,
                       F.struct(tab_no[F.col("tab")].alias("tab"), "row_no").alias("pos"))
