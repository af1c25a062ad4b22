from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import blocks as B
from millrace.plans import reports
from millrace.sources import delimited, grid

MIXED = """junk,,
TRADE_DATE,20240102,LC,,"Fund, A"
k,1,,

TICKER,SHARES
AAA,5
trade_date,20240102,LD
k,2
TICKER,SHARES
BBB,"1,000"
CCC,"two
lines"
TRADE_DATE,20240103
k,3
TICKER,SHARES
"""


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def grid_of(spark, files: dict[str, list[list]], width: int):
    data = [
        (name, n, [None if c is None else str(c) for c in [*cells, *[None] * (width - len(cells))]])
        for name, lines in files.items()
        for n, cells in enumerate(lines)
    ]
    return spark.createDataFrame(data, "source_file string, row_no long, cells array<string>")


@pytest.mark.parametrize("chunk", [1, 2, 3, 50_000])
def test_blocks_whatever_the_part_size(spark, folder, chunk):
    (folder / "a.csv").write_text(MIXED)
    (folder / "b.csv").write_text("no,marker\nat,all\n")
    (folder / "c.csv").write_text("TRADE_DATE,1\nx,y\n")
    g = grid.fixed_grid(spark, str(folder), 5)
    got = rows(B.number_blocks(g, "trade_date", chunk_rows=chunk), "source_file", "row_no", "block_id", "block_row", "block_size")
    a = [(1, 4), (2, 5), (3, 3)]
    want = []
    at = 1
    for block, size in a:
        want += [("a.csv", at + i, block, i, size) for i in range(size)]
        at += size
    want += [("c.csv", 0, 1, 0, 2), ("c.csv", 1, 1, 1, 2)]
    assert got == want


def test_cells_survive_quotes_blank_lines_and_breaks(spark, folder):
    (folder / "a.csv").write_text(MIXED)
    got = {r["row_no"]: r["cells"] for r in grid.fixed_grid(spark, str(folder), 5).collect()}
    assert got[1] == ["TRADE_DATE", "20240102", "LC", None, "Fund, A"]
    assert got[3][0] == "TICKER"
    assert got[8][:2] == ["BBB", "1,000"]
    assert got[9][:2] == ["CCC", "two\nlines"]
    assert sorted(got) == list(range(13))


def test_wide_rows_raise_drop_or_stay(spark, folder):
    (folder / "a.csv").write_text("a,b\n1,2,3\n4,5\n")
    with pytest.raises(Exception, match="wider than 2"):
        grid.fixed_grid(spark, str(folder), 2).collect()
    assert grid.fixed_grid(spark, str(folder), 2, long_rows="drop").count() == 2
    assert grid.fixed_grid(spark, str(folder), 2, long_rows="keep").count() == 3


def test_row_numbers_of_split_files(spark, folder):
    lines = [f"{i},{'x' * (i % 50)}" for i in range(4000)]
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    (folder / "b.csv").write_text("\n".join(lines[:100]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
    try:
        g = grid.fixed_grid(spark, str(folder), 2, multiline=False)
        got = g.select("source_file", "row_no", F.col("cells")[0].cast("long").alias("k"), F.spark_partition_id().alias("p"))
        data = got.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert len(data) == 4100
    assert all(r["row_no"] == r["k"] for r in data)


def test_promoted_header_with_repeats_and_missing_names(spark):
    g = grid_of(spark, {"f": [["A", None, "A", "B"], [1, 2, 3, 4], [5]], "g": [["B", "C"], [6, 7]]}, 4)
    out = B.promote_header(B.whole_file(g), 0)
    assert out.columns == ["source_file", "A", "B", "A.1", "C"]
    assert rows(out.na.fill("-"), *[f"`{c}`" for c in out.columns]) == [
        ("f", "1", "4", "3", "-"), ("f", "5", "-", "-", "-"), ("g", "-", "6", "-", "7")]


def test_pairs_last_key_wins_and_odd_cell_is_left(spark):
    g = grid_of(spark, {"f": [["a", 1, "b", 2, "odd"], [None, "x", "a", None], ["b", 3]]}, 5)
    kv = B.key_values(B.whole_file(g), B.pairs(F.col("cells")))
    assert {(r["key"], r["value"]) for r in kv.collect()} == {("a", None), ("b", "3")}
    assert B.metrics_map(kv).first()["metrics"] == {"a": None, "b": "3"}


PCF = [
    ["TRADE_DATE", "20240102", "LC9", None, "Fund, A", "FA", "FB", "CAD", "NAV", "10"],
    ["NAV", "11"], ["x", "1"], [], ["k", None], ["y", "2", "z", "3"], [None, "lost"], ["x", "9"],
    ["TICKER", "SHARES", None, "x"],
]


def test_pcf_block_without_holdings_and_marker_case(spark):
    lower = [["trade_date", "20240103", *PCF[0][2:]], *PCF[1:]]
    g = grid_of(spark, {"f": [["junk"], *PCF, ["AAA", 5, "u", "own"], ["BBB", 6], *lower, ["CCC", 7], *PCF]}, reports.PCF_WIDTH)
    out = reports.pcf_report(g)
    got = {r["TICKER"]: r.asDict() for r in out.collect()}
    assert sorted(got) == ["AAA", "BBB", "CCC"]
    a = got["AAA"]
    assert (a["TRADE_DATE"], a["SS_LONG_CODE"], a["FULL_NAME"], a["TICKER_1"], a["TICKER_2"], a["BASE_CURRENCY"]) == (
        "20240102", "LC9", "Fund, A", "FA", "FB", "CAD")
    assert (a["NAV"], a["x"], a["k"], a["y"], a["z"]) == ("11", "9", None, "2", "3")
    assert got["CCC"]["trade_date"] == "20240103"
    assert got["CCC"]["TRADE_DATE"] is None


def test_pcf_staged_equals_unstaged(spark):
    g = grid_of(spark, {"f": [*PCF, ["AAA", 5]], "g": [*PCF, ["BBB", 6], ["CCC", 7]]}, reports.PCF_WIDTH)
    columns = ["TICKER", "NAV", "x", "absent"]
    assert rows(reports.pcf_report(g, columns).na.fill("-"), *columns) == rows(
        reports.pcf_report(g, columns, staged=True).na.fill("-"), *columns)


def ucf_block(name: str, holdings: list[list]) -> list[list]:
    tail = [[f"T{i}", i] for i in range(15)] + [["FUND_NAME", "overwritten"]]
    head = [["FUND_NAME", name], ["A", 1], [], ["BROKER", None, "Clerk", "v"], [], [], ["CREATION", "no"], ["TICKER", "T3"]]
    # The marker may only open a block, so the overwriting key sits in the second pair.
    tail[-1] = ["LAST", 1, "A", "late"]
    return [*head, *holdings, *tail]


def test_ucf_head_and_tail(spark):
    g = grid_of(spark, {"f": [*ucf_block("one", [["AAA", "hidden"], ["BBB", "hidden"]]), *ucf_block("two", []), *ucf_block("three", [["CCC", 1]])]}, reports.UCF_WIDTH)
    got = {r["TICKER"]: r.asDict() for r in reports.ucf_report(g).collect()}
    assert sorted(got) == ["AAA", "BBB", "CCC"]
    a = got["AAA"]
    assert (a["ORDER_TYPE"], a["BROKER_NAME"], a["BROKER"], a["A"], a["T14"], a["LAST"], a["T3"]) == ("CREATION", "Clerk", None, "late", "14", "1", "3")
    assert "Clerk" not in a and "CREATION" not in a
    assert got["CCC"]["FUND_NAME"] == "three"


def test_cil_and_accounting(spark):
    g = grid_of(spark, {"f": [["DATE", "20240131"], ["A", "DATE"], [1, "own"], [2]], "g": [["DATE", "20240201"], ["B"], [3]]}, 3)
    assert rows(reports.cil_report(g).na.fill("-"), "source_file", "A", "B", "DATE") == [
        ("f", "1", "-", "20240131"), ("f", "2", "-", "20240131"), ("g", "-", "3", "20240201")]
    top = [[], [None] * 6 + ["Date:", "01/31/2024"], [], ["Fund ID", "NAV"], [7, 1.5]]
    assert rows(reports.accounting_nav_report(grid_of(spark, {"f": top}, 8)), "`Fund ID`", "NAV", "`Date:`") == [("7", "1.5", "01/31/2024")]


def test_nbf(spark):
    sheet = [["r", "b", "31.12.2024", "Total"], ["units"], ["East", "E1", "5", 1], [" ", None], ["total", None, 9], [None, "E2", "x"]]
    out = reports.nbf_report(grid_of(spark, {"f": sheet}, 4))
    assert out.columns == ["source_file", "Region", "Branch", "31/12/2024"]
    got = sorted(((r["Region"], r["Branch"], r["31/12/2024"]) for r in out.collect()), key=lambda r: r[1])
    assert got == [("East", "E1", 5.0), (None, "E2", None)]


def test_bmo_per_file_anchor(spark):
    files = {
        "f": [["Title"], [None, " branch ", "Assets", "Empty", "TOTAL"], [None, "B1", 1, " ", 9], [], [None, "Total", 9], [None, "B9", 1]],
        "g": [["BRANCH", "Assets"], ["B2", 2], ["B3", 3]],
    }
    g = grid_of(spark, files, 5).withColumn(
        "cells", F.transform("cells", lambda c: F.when(F.upper(F.trim(c)) == "BRANCH", F.lit("Branch")).otherwise(c)))
    assert rows(reports.bmo_report(g), "source_file", "Branch", "Assets") == [("f", "B1", "1"), ("g", "B2", "2"), ("g", "B3", "3")]
    assert "Empty" not in reports.bmo_report(g).columns
    with pytest.raises(Exception, match="no 'BRANCH' cell"):
        B.find_anchor(grid_of(spark, {"f": [["none"]]}, 2), "BRANCH").collect()


def test_header_shift_is_decided_per_file(spark, folder):
    (folder / "a.csv").write_text("# Order, Date\nN1,x,y\nN2,p,q\nN3,1,2,3\n")
    (folder / "b.csv").write_text("# Order, Date\nO1,z\n")
    out = delimited.scan_header_shift(spark, str(folder), width=8)
    assert rows(out.na.fill("-"), "source_file", "__index_level_0__", "`# Order`", "` Date`") == [
        ("a.csv", "N1", "x", "y"), ("a.csv", "N2", "p", "q"), ("b.csv", "-", "O1", "z")]


def test_files_with_other_headers(spark, folder):
    (folder / "a.csv").write_text("A,B\n1,N/A\n")
    (folder / "b.csv").write_text("B,C\n2,\n")
    assert rows(delimited.scan_by_name(spark, str(folder), width=4).na.fill("-"), "A", "B", "C") == [("-", "2", "-"), ("1", "N/A", "-")]
    with pytest.raises(Exception, match="CSV"):
        delimited.scan_delimited(spark, str(folder)).collect()


def test_quoted_empty_cells_are_null(spark, folder):
    (folder / "a.csv").write_text('A,B,C\n1,"",3\n')
    assert rows(delimited.scan_delimited(spark, str(folder)).na.fill("-"), "A", "B", "C") == [("1", "-", "3")]
    assert grid.fixed_grid(spark, str(folder), 3).where("row_no = 1").first()["cells"] == ["1", None, "3"]


def test_ragged_rows(spark, folder):
    (folder / "a.csv").write_text("a\nb,,c\n,,\n")
    got = {r["row_no"]: r["cells"] for r in grid.ragged_grid(spark, str(folder), max_width=4).collect()}
    assert got[0] == ["a", None, None, None]
    assert got[1] == ["b", "", "c", None]


def test_hot_block_is_joined_in_parts(spark):
    """A block with nearly all rows: the joined rows are grouped by part, none is lost."""
    n = 500
    g = grid_of(spark, {"f": [*PCF, *[[f"H{i}", i] for i in range(n)], *PCF, ["S", 1]]}, reports.PCF_WIDTH)
    numbered = B.number_blocks(g, "TRADE_DATE", sized=False, chunk_rows=40)
    lookup = reports.pcf_heads(numbered, ["TICKER", "NAV"])
    joined = B.attach(numbered.where("block_row > 8"), lookup, B.BLOCK, chunk_rows=40)
    assert joined.count() == n + 1
    again = B.attach(numbered.where("block_row > 8"), lookup.drop("_from", "_to"), B.BLOCK, chunk_rows=40)
    assert again.count() == n + 1


def test_rows_of_blocks_are_ordered_once(spark):
    """Block sizes take no second order of the rows, and the blocks' ranges are right."""
    from millrace.operators import blocks

    rows = [("f", i, ["M", None] if i % 700 == 3 else [str(i), "x"]) for i in range(3000)]
    grid = spark.createDataFrame(rows, "source_file string, row_no bigint, cells array<string>")
    numbered = blocks.number_blocks(grid, "m")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"row_no#\d+L? DESC", plan(numbered))
    starts = [i for i in range(3000) if i % 700 == 3]
    want = [(i, k + 1, i - a, e - a) for k, (a, e) in enumerate(zip(starts, [*starts[1:], 3000])) for i in range(a, e)]
    assert sorted((r.row_no, r.block_id, r.block_row, r.block_size) for r in numbered.collect()) == want
    spans = {(r.block_id, r._from, r._to) for r in blocks.expand_header(numbered, 1).collect()}
    assert spans == {(k + 1, a, e - 1) for k, (a, e) in enumerate(zip(starts, [*starts[1:], 3000]))}
