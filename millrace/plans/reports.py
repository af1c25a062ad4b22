"""The report layouts, each a composition of grid operators.

Every parser takes a grid of any number of files and returns the table rows of
all of them, as text, with ``source_file``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.casts import number
from millrace.operators.blocks import (
    BLOCK,
    TOTAL_LABELS,
    anchored_tables,
    blank_to_null,
    block_heads,
    cell,
    drop_empty_columns,
    drop_empty_rows,
    drop_total_columns,
    expand_header,
    is_total,
    number_blocks,
    pairs,
    promote_header,
    whole_file,
)
from millrace.session import stage


def _entry(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def _blocked(grid: DataFrame, marker: str, staged: bool, sized: bool) -> DataFrame:
    blocks = number_blocks(grid, marker, sized=sized)
    return stage(blocks, "blocks") if staged else blocks


# Fixed values of the basket layout: width, block marker, named cells of row 0, table header row.
PCF_WIDTH = 25
PCF_MARKER = "TRADE_DATE"
PCF_HEAD_CELLS = {"SS_LONG_CODE": 2, "FULL_NAME": 4, "TICKER_1": 5, "TICKER_2": 6, "BASE_CURRENCY": 7}
PCF_HEADER_ROW = 8


def pcf_heads(blocks: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Header row, and the key/value pairs of the eight rows above it."""
    first = F.array(
        _entry(cell(0), cell(1)),
        *[_entry(F.lit(name), cell(at)) for name, at in PCF_HEAD_CELLS.items()],
        _entry(cell(8), cell(9)),
    )
    entries = F.when(F.col("block_row") == 0, first).otherwise(pairs(F.col("cells")))
    return block_heads(blocks, PCF_HEADER_ROW, [(F.col("block_row") < PCF_HEADER_ROW, entries)], columns)


def pcf_report(grid: DataFrame, columns: Sequence[str] | None = None, staged: bool = False) -> DataFrame:
    """Basket report: holdings below the header row, head metrics on every holding."""
    blocks = _blocked(grid, PCF_MARKER, staged, sized=False)
    return promote_header(blocks, PCF_HEADER_ROW, columns=columns, lookup=pcf_heads(blocks, columns))


# Fixed values of the order layout: width, block marker, header row, tail length, two special cells.
UCF_WIDTH = 34
UCF_MARKER = "FUND_NAME"
UCF_HEADER_ROW = 7
UCF_TAIL_ROWS = 16
UCF_ORDER_TYPE_CELL = (6, 0)
UCF_BROKER_CELL = (3, 2)


def ucf_heads(blocks: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Header row, and the pairs of the seven rows above it and of the last sixteen."""
    row = F.col("block_row")
    type_row, type_col = UCF_ORDER_TYPE_CELL
    broker_row, broker_col = UCF_BROKER_CELL
    unbrokered = F.transform("cells", lambda c, i: F.when(~((row == broker_row) & (i == broker_col)), c))
    head = (
        F.when(row == type_row, F.array(_entry(F.lit("ORDER_TYPE"), cell(type_col))))
        .when(row == broker_row, F.concat(F.array(_entry(F.lit("BROKER_NAME"), cell(broker_col))), pairs(unbrokered)))
        .otherwise(pairs(F.col("cells")))
    )
    sections = [
        (row < UCF_HEADER_ROW, head),
        (row >= F.col("block_size") - UCF_TAIL_ROWS, pairs(F.col("cells"))),
    ]
    return block_heads(blocks, UCF_HEADER_ROW, sections, columns)


def ucf_report(grid: DataFrame, columns: Sequence[str] | None = None, staged: bool = False) -> DataFrame:
    """Order report: holdings between the header row and the tail, metrics on every holding."""
    blocks = _blocked(grid, UCF_MARKER, staged, sized=True)
    body = (F.col("block_row") > UCF_HEADER_ROW) & (F.col("block_row") < F.col("block_size") - UCF_TAIL_ROWS)
    return promote_header(blocks, UCF_HEADER_ROW, columns=columns, lookup=ucf_heads(blocks, columns), data=body)


def _single_metric_report(
    grid: DataFrame, header_row: int, key_at: tuple[int, int], value_col: int, columns: Sequence[str] | None
) -> DataFrame:
    sheet = whole_file(grid)
    row, col = key_at
    entry = F.array(_entry(cell(col), cell(value_col)))
    lookup = block_heads(sheet, header_row, [(F.col("block_row") == row, entry)], columns)
    return promote_header(sheet, header_row, columns=columns, lookup=lookup)


def cil_report(grid: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One key/value row, then header and data."""
    return _single_metric_report(grid, 1, (0, 0), 1, columns)


def accounting_nav_report(grid: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Header in row 3; the pair in row 1, columns 6 and 7, goes on every row."""
    return _single_metric_report(grid, 3, (1, 6), 7, columns)


def nbf_report(grid: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Regional sheet: names in row 0 (from the third on), data from row 2, no totals, numbers as float."""
    sheet = whole_file(grid)
    names = F.transform(
        "cells",
        lambda c, i: F.when(i == 0, F.lit("Region"))
        .when(i == 1, F.lit("Branch"))
        .otherwise(F.replace(c, F.lit("."), F.lit("/"))),
    )
    table = promote_header(
        sheet, 0, columns=columns, lookup=expand_header(sheet, 0, names=names), data=F.col("block_row") >= 2
    )
    body = [c for c in table.columns if c != "source_file"]
    table = drop_empty_rows(blank_to_null(table, body), body)
    table = drop_total_columns(table.where(~is_total(F.col("Region"), TOTAL_LABELS[:2])), TOTAL_LABELS[:2])
    figures = [c for c in table.columns if c not in ("source_file", "Region", "Branch")]
    return table.withColumns({c: number(F.col(f"`{c}`")).cast("float") for c in figures})


def bmo_report(grid: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Branch sheet that starts at an anchor cell and ends at the first total row.

    Finding out which columns are empty runs one aggregate job.
    """
    below = F.col("row_no") > F.col("anchor_row")
    table = promote_header(
        whole_file(grid),
        0,
        columns=columns,
        lookup=anchored_tables(grid, "BRANCH"),
        data=F.lit(True),
        row_filter=below & (F.col("stop_row").isNull() | (F.col("row_no") < F.col("stop_row"))),
    )
    body = [c for c in table.columns if c != "source_file"]
    table = drop_total_columns(drop_empty_rows(blank_to_null(table, body), body))
    return drop_empty_columns(table, [c for c in table.columns if c != "source_file"])


__all__ = [
    "BLOCK",
    "accounting_nav_report",
    "bmo_report",
    "cil_report",
    "nbf_report",
    "pcf_heads",
    "pcf_report",
    "ucf_heads",
    "ucf_report",
]
