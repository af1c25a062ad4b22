"""Report grids drawn from the given tables, taken apart again by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.casts import number
from millrace.operators.blocks import (
    BLOCK,
    blank_to_null,
    drop_empty_columns,
    drop_empty_rows,
    find_anchor,
    key_values,
    number_blocks,
    pairs,
    promote_header,
)
from millrace.plans import reports
from millrace.session import stage
from millrace.workload.tables import table, text

PER_FILE = 16
KEYS_PER_PART = 1_024


def padded(width: int, *cells: Column | str | None) -> Column:
    """A row of the grid: given cells as text, the rest NULL. Plain strings are literals."""
    given = [c.cast("string") if isinstance(c, Column) else F.lit(c).cast("string") for c in cells]
    return F.array(*given, *[F.lit(None).cast("string")] * (width - len(given)))


def numbered(df: DataFrame, key: str, spread: str) -> DataFrame:
    """Add a dense ``seq`` within ``key`` from 0; a key with very many rows is counted in ranges of ``spread``."""
    parts = df.withColumn("_sub", F.floor(F.col(spread) / KEYS_PER_PART))
    within = F.row_number().over(Window.partitionBy(key, "_sub").orderBy(*[c for c in df.columns if c != key])) - 1
    earlier = Window.partitionBy(key).orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy(key, "_sub").agg(F.count("*").alias("_n")).select(
        key, "_sub", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    return (
        parts.withColumn("_within", within)
        .join(offsets, [key, "_sub"])
        .withColumn("seq", F.col("_before") + F.col("_within"))
        .drop("_sub", "_within", "_before")
    )


def supplier_grid(
    spark: SparkSession,
    folder: str,
    head: Sequence[Column],
    line: Column,
    tail: Sequence[Column] = (),
) -> DataFrame:
    """One block per supplier, a few suppliers per file, one stray row at the top of each file."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    counts = lines.groupBy("l_suppkey").agg(F.count("*").alias("n"))
    size = F.lit(len(head) + len(tail)) + F.coalesce(F.col("n"), F.lit(0))
    file = F.concat(F.lit("report_"), F.floor(F.col("s_suppkey") / PER_FILE).cast("string"))
    in_file = Window.partitionBy("source_file").orderBy("s_suppkey").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        table(spark, folder, "supplier")
        .join(counts, F.col("s_suppkey") == F.col("l_suppkey"), "left")
        .drop("l_suppkey")
        .select("*", file.alias("source_file"), size.alias("size"))
        .withColumn("start", F.coalesce(F.sum("size").over(in_file), F.lit(0)) + 1)
    )
    width = len(line_width(head))
    first = blocks.where("start = 1")
    stray = first.select("source_file", F.lit(0).cast("long").alias("row_no"), padded(width, "stray").alias("cells"))
    tops = blocks.select("source_file", "start", F.posexplode(F.array(*head)).alias("at", "cells"))
    tops = tops.select("source_file", (F.col("start") + F.col("at")).alias("row_no"), "cells")
    body = numbered(lines, "l_suppkey", "l_partkey").join(
        blocks.select("s_suppkey", "source_file", "start"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    body = body.select("source_file", (F.col("start") + len(head) + F.col("seq")).alias("row_no"), line.alias("cells"))
    grid = stray.unionByName(tops).unionByName(body)
    if tail:
        ends = blocks.select("source_file", "start", "size", F.posexplode(F.array(*tail)).alias("at", "cells"))
        at = F.col("start") + F.col("size") - len(tail) + F.col("at")
        grid = grid.unionByName(ends.select("source_file", at.alias("row_no"), "cells"))
    return grid


def line_width(head: Sequence[Column]) -> range:
    return range(reports.PCF_WIDTH if len(head) == reports.PCF_HEADER_ROW + 1 else reports.UCF_WIDTH)


def pcf_grid(spark: SparkSession, folder: str) -> DataFrame:
    w = reports.PCF_WIDTH
    key = text("s_suppkey")
    twelve = [c for n in range(1, 13) for c in (f"K{n}", str(n))]
    head = [
        padded(
            w, "Trade_Date", "20240131", F.concat(key, F.lit("-L")), None, "Fund, A", F.concat(F.lit("T"), key), None,
            "CAD", "NAV", F.col("s_acctbal"),
        ),
        padded(w, "STATUS", "old", "NATION", F.col("s_nationkey")),
        padded(w, None, "no key", "NAME", F.col("s_name")),
        padded(w),
        padded(w, "EMPTY", None),
        padded(w, *twelve, "ODD"),
        padded(w, "STATUS", "older"),
        padded(w, "STATUS", F.concat(F.lit("S"), key)),
        padded(w, "ORDER", "PART", None, "SHARES", "STATUS", "PRICE", "LINE", "PART"),
    ]
    line = padded(
        w, F.col("l_orderkey"), F.col("l_partkey"), "unnamed", F.col("l_quantity"), "not this", F.col("l_extendedprice"),
        F.col("l_linenumber"), "again",
    )
    return supplier_grid(spark, folder, head, line)


def ucf_grid(spark: SparkSession, folder: str) -> DataFrame:
    w = reports.UCF_WIDTH
    key = text("s_suppkey")
    head = [
        padded(w, "FUND_NAME", F.concat(F.lit("Fund "), key), "FUND_TICKER", F.concat(F.lit("T"), key)),
        padded(w, "TRADE_DATE", "20240131"),
        padded(w),
        padded(w, "BROKER", None, F.concat(F.lit("Clerk "), text("s_nationkey")), "taken apart"),
        padded(w, "NAV", "0"),
        padded(w, "NAME", F.col("s_name")),
        padded(w, F.when(F.col("s_suppkey") % 2 == 0, "CREATION").otherwise("REDEMPTION"), "ignored"),
        padded(w, "ORDER", "PART", "SHARES", None, "PRICE", "NAV", "LINE"),
    ]
    line = padded(
        w, F.col("l_orderkey"), F.col("l_partkey"), F.col("l_quantity"), None, F.col("l_extendedprice"), "hidden",
        F.col("l_linenumber"),
    )
    tail = [padded(w, f"K{i}", str(i), f"X{i}", F.col("s_nationkey") + i) for i in range(reports.UCF_TAIL_ROWS - 1)]
    tail.append(padded(w, "NAV", F.col("s_acctbal"), "STATUS", F.concat(F.lit("S"), key)))
    return supplier_grid(spark, folder, head, line, tail)


def _numbers(df: DataFrame, longs: Sequence[str], doubles: Sequence[str]) -> DataFrame:
    typed = {c: F.col(c).cast("long") for c in longs} | {c: number(F.col(c)) for c in doubles}
    return df.withColumns(typed)


FILE = f"'report_' || CAST(s_suppkey // {PER_FILE} AS VARCHAR)"
LINE = """l_orderkey AS "ORDER", l_partkey AS "PART", l_quantity AS "SHARES", l_extendedprice AS "PRICE",
    CAST(l_linenumber AS BIGINT) AS "LINE" """
HELD = "supplier JOIN lineitem ON s_suppkey = l_suppkey"


def q_pcf(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["ORDER", "PART", "SHARES", "PRICE", "LINE", "Trade_Date", "SS_LONG_CODE", "FULL_NAME", "TICKER_1",
               "TICKER_2", "BASE_CURRENCY", "NAV", "STATUS", "NATION", "NAME", "EMPTY", "K12", "ODD"]
    report = reports.pcf_report(pcf_grid(spark, folder), columns)
    return _numbers(report, ["ORDER", "PART", "LINE", "NATION"], ["SHARES", "PRICE", "NAV"])


PCF_SQL = f"""
    SELECT {FILE} AS source_file, {LINE}, '20240131' AS "Trade_Date", s_suppkey || '-L' AS "SS_LONG_CODE",
           'Fund, A' AS "FULL_NAME", 'T' || s_suppkey AS "TICKER_1", NULL::VARCHAR AS "TICKER_2", 'CAD' AS "BASE_CURRENCY",
           s_acctbal AS "NAV", 'S' || s_suppkey AS "STATUS", CAST(s_nationkey AS BIGINT) AS "NATION", s_name AS "NAME",
           NULL::VARCHAR AS "EMPTY", '12' AS "K12", NULL::VARCHAR AS "ODD"
    FROM {HELD}
"""


def q_ucf(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["ORDER", "PART", "SHARES", "PRICE", "LINE", "FUND_NAME", "FUND_TICKER", "TRADE_DATE", "BROKER_NAME",
               "NAME", "ORDER_TYPE", "NAV", "STATUS", "K0", "X14", "BROKER"]
    report = reports.ucf_report(ucf_grid(spark, folder), columns)
    return _numbers(report, ["ORDER", "PART", "LINE", "X14"], ["SHARES", "PRICE", "NAV"])


UCF_SQL = f"""
    SELECT {FILE} AS source_file, {LINE}, 'Fund ' || s_suppkey AS "FUND_NAME", 'T' || s_suppkey AS "FUND_TICKER",
           '20240131' AS "TRADE_DATE", 'Clerk ' || s_nationkey AS "BROKER_NAME", s_name AS "NAME",
           CASE WHEN s_suppkey % 2 = 0 THEN 'CREATION' ELSE 'REDEMPTION' END AS "ORDER_TYPE",
           s_acctbal AS "NAV", 'S' || s_suppkey AS "STATUS", '0' AS "K0", CAST(s_nationkey + 14 AS BIGINT) AS "X14",
           NULL::VARCHAR AS "BROKER"
    FROM {HELD}
"""


def q_blocks(spark: SparkSession, folder: str) -> DataFrame:
    blocks = number_blocks(pcf_grid(spark, folder), "trade_date")
    return blocks.groupBy(*BLOCK).agg(
        F.count("*").alias("n_rows"), F.max("block_row").alias("last_row"), F.max("block_size").alias("block_size"),
        F.max(F.when(F.col("block_row") == 0, F.get("cells", F.lit(2)))).alias("long_code"),
    )


BLOCKS_SQL = f"""
    SELECT {FILE} AS source_file, row_number() OVER (PARTITION BY s_suppkey // {PER_FILE} ORDER BY s_suppkey) AS block_id,
           9 + n AS n_rows, 8 + n AS last_row, 9 + n AS block_size, s_suppkey || '-L' AS long_code
    FROM (SELECT s_suppkey, count(l_suppkey) AS n FROM supplier LEFT JOIN lineitem ON s_suppkey = l_suppkey GROUP BY ALL)
"""


def q_kv(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of whole blocks: every holding row counts as pairs as well, the last row of a key wins."""
    blocks = number_blocks(pcf_grid(spark, folder), "TRADE_DATE")
    keyed = F.filter(pairs(F.col("cells")), lambda e: ~e["key"].isin("unnamed", "not this"))
    kv = key_values(blocks.where("block_row > 0"), keyed)
    return kv.withColumn("value", F.when(~F.col("key").rlike("^[0-9.]+$"), F.col("value"))).distinct()


KV_SQL = f"""
    WITH b AS (
        SELECT *, {FILE} AS source_file,
               row_number() OVER (PARTITION BY s_suppkey // {PER_FILE} ORDER BY s_suppkey) AS block_id
        FROM supplier
    ), held AS (
        SELECT b.*, l.* FROM b JOIN lineitem l ON s_suppkey = l_suppkey
    )
    SELECT source_file, block_id, 'STATUS' AS key, 'PRICE' AS value FROM b
    UNION ALL SELECT source_file, block_id, 'NATION', CAST(s_nationkey AS VARCHAR) FROM b
    UNION ALL SELECT source_file, block_id, 'NAME', s_name FROM b
    UNION ALL SELECT source_file, block_id, 'EMPTY', NULL FROM b
    UNION ALL SELECT source_file, block_id, 'K' || n, n FROM b, range(1, 13) r(n)
    UNION ALL SELECT source_file, block_id, 'ORDER', 'PART' FROM b
    UNION ALL SELECT source_file, block_id, 'LINE', 'PART' FROM b
    UNION ALL SELECT DISTINCT source_file, block_id, CAST(l_orderkey AS VARCHAR), NULL FROM held
    UNION ALL SELECT DISTINCT source_file, block_id, CAST(l_linenumber AS VARCHAR), NULL FROM held
        WHERE l_linenumber NOT IN (SELECT l_orderkey FROM held h WHERE h.block_id = held.block_id AND h.source_file = held.source_file)
"""


def q_header(spark: SparkSession, folder: str) -> DataFrame:
    # Written once, in columns: the names, the headers and the rows each read it.
    blocks = stage(number_blocks(pcf_grid(spark, folder), "TRADE_DATE"), "blocks")
    return _numbers(promote_header(blocks, 8), ["ORDER", "PART", "LINE"], ["SHARES", "PRICE"])


HEADER_SQL = f"""SELECT {FILE} AS source_file, {LINE}, 'not this' AS "STATUS", 'again' AS "PART.1" FROM {HELD}"""


def sheet_of(df: DataFrame, key: str, per_sheet: int, heads: Sequence[Column], row: Column, ends: Sequence[Column] = ()) -> DataFrame:
    """A sheet per run of ``per_sheet`` keys: head rows, one row per record, closing rows."""
    sheet = F.floor(F.col(key) / per_sheet)
    placed = df.withColumn("source_file", F.concat(F.lit("sheet_"), sheet.cast("string"))).withColumn(
        "_at", F.row_number().over(Window.partitionBy("source_file").orderBy(key)) - 1
    )
    body = placed.select("source_file", (F.col("_at") + len(heads)).cast("long").alias("row_no"), row.alias("cells"))
    files = placed.groupBy("source_file").agg(F.count("*").alias("_n"))
    tops = files.select("source_file", F.posexplode(F.array(*heads)).alias("row_no", "cells"))
    grid = body.unionByName(tops.withColumn("row_no", F.col("row_no").cast("long")))
    if ends:
        last = files.select("source_file", "_n", F.posexplode(F.array(*ends)).alias("_p", "cells"))
        grid = grid.unionByName(
            last.select("source_file", (F.col("_n") + len(heads) + F.col("_p")).cast("long").alias("row_no"), "cells")
        )
    return grid


ROWS_PER_SHEET = 1_000


def q_cil(spark: SparkSession, folder: str) -> DataFrame:
    grid = sheet_of(
        table(spark, folder, "orders"), "o_orderkey", ROWS_PER_SHEET,
        [padded(4, "DATE", "20240131"), padded(4, "ORDER", "STATUS", "PRICE", "DATE")],
        padded(4, F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice"), "wrong"),
    )
    return _numbers(reports.cil_report(grid, ["ORDER", "STATUS", "PRICE", "DATE"]), ["ORDER"], ["PRICE"])


def q_accounting(spark: SparkSession, folder: str) -> DataFrame:
    grid = sheet_of(
        table(spark, folder, "customer"), "c_custkey", ROWS_PER_SHEET,
        [
            padded(8, "Price report"),
            padded(8, None, None, None, None, None, None, "Date:", "01/31/2024"),
            padded(8),
            padded(8, "Fund ID", "Vendor Fund Name", None, "NAV"),
        ],
        padded(8, F.col("c_custkey"), F.col("c_name"), "x", F.col("c_acctbal")),
    )
    return _numbers(reports.accounting_nav_report(grid), ["Fund ID"], ["NAV"])


def q_nbf(spark: SparkSession, folder: str) -> DataFrame:
    whole = F.floor(F.col("c_acctbal"))
    end = F.when(F.col("c_custkey") % 11 == 0, F.lit("grand total")).otherwise(F.concat(F.lit("R"), text("c_nationkey")))
    grid = sheet_of(
        table(spark, folder, "customer"), "c_custkey", ROWS_PER_SHEET,
        [padded(6, "a", "b", "31.01.2024", "Total", "Q2.2024", "GRAND TOTAL"), padded(6, "units")],
        F.when(F.col("c_custkey") % 7 == 0, padded(6, " ", None, "\t")).otherwise(
            padded(6, end, F.col("c_name"), whole, "1", F.when(F.col("c_custkey") % 5 == 0, "n/a").otherwise(text("c_nationkey")), "2")
        ),
        [padded(6, "TOTAL", None, "99")],
    )
    return reports.nbf_report(grid)


NBF_SQL = f"""
    SELECT 'sheet_' || c_custkey // {ROWS_PER_SHEET} AS source_file, 'R' || c_nationkey AS "Region", c_name AS "Branch",
           CAST(floor(c_acctbal) AS FLOAT) AS "31/01/2024",
           CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS FLOAT) END AS "Q2/2024"
    FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0
"""


def bmo_grid(spark: SparkSession, folder: str) -> DataFrame:
    return sheet_of(
        table(spark, folder, "customer"), "c_custkey", ROWS_PER_SHEET,
        [padded(7, "Quarterly"), padded(7, None, "note", "note"), padded(7, None, None, "Branch", "Assets", "Total", "Empty", "Advisors")],
        F.when(F.col("c_custkey") % 9 == 0, padded(7, "margin")).otherwise(
            padded(7, "margin", None, F.col("c_name"), F.col("c_acctbal"), "5", " ", F.col("c_nationkey"))
        ),
        [padded(7, None, None, "Totals", "1"), padded(7, None, None, "after the end", "2")],
    )


def q_bmo(spark: SparkSession, folder: str) -> DataFrame:
    return _numbers(reports.bmo_report(bmo_grid(spark, folder)), ["Advisors"], ["Assets"])


BMO_SQL = f"""
    SELECT 'sheet_' || c_custkey // {ROWS_PER_SHEET} AS source_file, c_name AS "Branch", c_acctbal AS "Assets",
           CAST(c_nationkey AS BIGINT) AS "Advisors"
    FROM customer WHERE c_custkey % 9 <> 0
"""


def q_anchor(spark: SparkSession, folder: str) -> DataFrame:
    return find_anchor(bmo_grid(spark, folder), "branch")


def q_drop_empty(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    blank = F.when(F.col("c_custkey") % 3 == 0, F.lit(" \t"))
    df = c.select(
        F.coalesce(blank, text("c_custkey")).alias("key"), F.coalesce(blank, F.col("c_name")).alias("name"),
        F.lit(" ").alias("nothing"),
        F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.coalesce(blank, F.col("c_mktsegment"))).alias("segment"),
    )
    return drop_empty_columns(drop_empty_rows(blank_to_null(df)))


QUERIES = {
    "grid_blocks": (q_blocks, BLOCKS_SQL),
    "grid_kv_metrics": (q_kv, KV_SQL),
    "grid_promote_header": (q_header, HEADER_SQL),
    "pcf_report": (q_pcf, PCF_SQL),
    "ucf_report": (q_ucf, UCF_SQL),
    "cil_report": (
        q_cil,
        f"""SELECT 'sheet_' || o_orderkey // {ROWS_PER_SHEET} AS source_file, o_orderkey AS "ORDER",
            o_orderstatus AS "STATUS", o_totalprice AS "PRICE", '20240131' AS "DATE" FROM orders""",
    ),
    "accounting_nav_report": (
        q_accounting,
        f"""SELECT 'sheet_' || c_custkey // {ROWS_PER_SHEET} AS source_file, c_custkey AS "Fund ID",
            c_name AS "Vendor Fund Name", c_acctbal AS "NAV", '01/31/2024' AS "Date:" FROM customer""",
    ),
    "nbf_report": (q_nbf, NBF_SQL),
    "bmo_report": (q_bmo, BMO_SQL),
    "grid_anchor": (
        q_anchor,
        f"""SELECT DISTINCT 'sheet_' || c_custkey // {ROWS_PER_SHEET} AS source_file, CAST(2 AS BIGINT) AS anchor_row,
            2 AS anchor_col FROM customer""",
    ),
    "grid_drop_empty": (
        q_drop_empty,
        """SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name,
           CASE WHEN c_custkey % 2 <> 0 THEN c_mktsegment END AS segment FROM customer WHERE c_custkey % 3 <> 0""",
    ),
}
