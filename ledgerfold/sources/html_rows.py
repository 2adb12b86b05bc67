"""Rows of the largest table in an HTML page.

The only place where Python sees data: Spark has no HTML parser. Pages travel as
Arrow batches and each page is handled on its own, so no shuffle is needed."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "page_id bigint, block_no int, row_no int, cells array<string>"
SHAPES = {"table": ({"table"}, {"tr"}, {"td", "th"}), "list": ({"ul", "ol"}, {"li"}, set())}


class _Blocks(HTMLParser):
    """Collects the rows of every block; a cell is closed by the next cell or row."""

    def __init__(self, shape: str):
        super().__init__(convert_charrefs=True)
        self.block_tags, self.row_tags, self.cell_tags = SHAPES[shape]
        self.blocks: list[list[list[str]]] = []
        self.open: list[list[list[str]]] = []

    def handle_starttag(self, tag, attrs):
        if tag in self.block_tags:
            self.blocks.append([])
            self.open.append(self.blocks[-1])
        elif self.open and tag in self.row_tags:
            self.open[-1].append([] if self.cell_tags else [""])
        elif self.open and tag in self.cell_tags:
            if not self.open[-1]:
                self.open[-1].append([])
            self.open[-1][-1].append("")

    def handle_endtag(self, tag):
        if tag in self.block_tags and self.open:
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1] and self.open[-1][-1]:
            self.open[-1][-1][-1] += data


def largest_block(html: str | None, shape: str) -> tuple[int, list[list[str]]]:
    """(position, rows) of the block with most rows, the first on ties."""
    parser = _Blocks(shape)
    parser.feed(html or "")
    parser.close()
    best = max(range(len(parser.blocks)), key=lambda i: (len(parser.blocks[i]), -i), default=0)
    rows = parser.blocks[best] if parser.blocks else []
    return best, [[cell.strip() for cell in row] for row in rows]


def html_rows(pages: DataFrame, shape: str = "table") -> DataFrame:
    """(page_id, block_no, row_no, cells) of each page's largest table or list; for a
    table, row 0 is its header."""
    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(page, *largest_block(html, shape))
                     for page, html in zip(batch["page_id"], batch["html"])]
            yield pd.DataFrame([(page, block, i, cells) for page, block, rows in found
                                for i, cells in enumerate(rows)],
                               columns=["page_id", "block_no", "row_no", "cells"])

    return pages.select("page_id", "html").mapInPandas(extract, SCHEMA)
