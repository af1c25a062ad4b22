"""Scans over files that are first written from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.casts import number
from millrace.session import workspace
from millrace.sources.delimited import scan_delimited, scan_header_shift, scan_skip_bad_rows, scan_skip_rows
from millrace.sources.grid import fixed_grid, ragged_grid
from millrace.workload.tables import table, text

ROWS_PER_FILE = 5_000
# Files that a task writes one after another; bounds the rows that it orders.
FILES_PER_TASK = 8


def write_reports(df: DataFrame, key: str, line: Column, top: tuple[str, ...] = (), label: str = "inbox") -> str:
    """Write text files of ``ROWS_PER_FILE`` keys each, ``top`` lines first, in key order."""
    folder = workspace(df.sparkSession, label)
    file = F.floor(F.col(key) / ROWS_PER_FILE)
    lines = df.select(file.alias("delivery"), F.col(key).alias("_at"), line.alias("value"))
    heads = df.select(file.alias("delivery")).distinct()
    for n, content in enumerate(top):
        head = heads.select("delivery", F.lit(n - len(top)).cast("long").alias("_at"), F.lit(content).alias("value"))
        lines = lines.unionByName(head)
    (
        lines.repartition(max(1, -(-heads.count() // FILES_PER_TASK)), "delivery")
        .sortWithinPartitions("delivery", "_at")
        .select("delivery", "value")
        .write.partitionBy("delivery")
        .text(folder)
    )
    return folder


def q_csv_nulls(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    orders = table(spark, folder, "orders").select(
        k.alias("Order Key"),
        F.when(k % 5 == 0, "N/A").when(k % 7 == 0, "NULL").when(k % 3 != 0, F.col("o_orderstatus")).alias("status"),
        F.concat(F.lit('say "'), F.col("o_orderpriority"), F.lit('", twice')).alias("note"),
        F.lpad(text("o_custkey"), 8, "0").alias("customer"),
    )
    inbox = workspace(spark, "inbox")
    orders.write.option("header", True).option("escape", '"').csv(inbox)
    return scan_delimited(spark, inbox).drop("source_file")


CSV_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS "Order Key",
           CASE WHEN o_orderkey % 5 = 0 THEN 'N/A' WHEN o_orderkey % 7 = 0 THEN 'NULL'
                WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status,
           'say "' || o_orderpriority || '", twice' AS note, lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS customer
    FROM orders
"""


def _typed(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("long").alias("key"), "status", number(F.col("price")).alias("price"))


def q_skip_rows(spark: SparkSession, folder: str) -> DataFrame:
    line = F.concat_ws(",", "o_orderkey", "o_orderstatus", "o_totalprice")
    inbox = write_reports(table(spark, folder, "orders"), "o_orderkey", line, ("as of today,x", "key,status,price"))
    return _typed(scan_skip_rows(spark, inbox, 1, width=8, lineage="path"))


def q_bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    full = F.concat_ws(",", "o_orderkey", "o_orderstatus", "o_totalprice")
    line = F.when(k % 6 == 1, F.concat(full, F.lit(",1,2"))).when(k % 7 == 2, F.concat_ws(",", "o_orderkey", "o_orderstatus"))
    inbox = write_reports(table(spark, folder, "orders"), "o_orderkey", line.otherwise(full), ("key,status,price",))
    return _typed(scan_skip_bad_rows(spark, inbox, ["key", "status", "price"], width=8, lineage="path"))


def q_shift(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    full = F.concat_ws(",", F.concat(F.lit("N"), text("o_orderkey")), "o_orderkey", "o_orderstatus", "o_totalprice")
    line = F.when(k % 6 == 1, F.concat(full, F.lit(",9"))).otherwise(full)
    inbox = write_reports(table(spark, folder, "orders"), "o_orderkey", line, ("# Order, Key, Status",))
    shifted = scan_header_shift(spark, inbox, width=8, lineage="path")
    return shifted.select(
        F.col("__index_level_0__").alias("label"), F.col("`# Order`").cast("long").alias("order"),
        F.col("` Key`").alias("key"), number(F.col("` Status`")).alias("status"),
    )


def q_ragged(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    status = F.when(k % 4 == 3, "").otherwise(F.col("o_orderstatus"))
    line = F.when(k % 4 == 0, text("o_orderkey")).when(k % 4 == 1, F.concat_ws(",", "o_orderkey", status))
    line = line.otherwise(F.concat_ws(",", "o_orderkey", status, F.lit('"a, b"'), text("o_custkey")))
    inbox = write_reports(table(spark, folder, "orders"), "o_orderkey", line)
    grid = ragged_grid(spark, inbox, max_width=6, lineage="path")
    return grid.select(
        "row_no", *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(6)], F.size("cells").alias("width")
    )


RAGGED_SQL = f"""
    SELECT row_number() OVER (PARTITION BY o_orderkey // {ROWS_PER_FILE} ORDER BY o_orderkey) - 1 AS row_no,
           CAST(o_orderkey AS VARCHAR) AS c0,
           CASE o_orderkey % 4 WHEN 1 THEN o_orderstatus WHEN 2 THEN o_orderstatus WHEN 3 THEN '' END AS c1,
           CASE WHEN o_orderkey % 4 >= 2 THEN 'a, b' END AS c2,
           CASE WHEN o_orderkey % 4 >= 2 THEN CAST(o_custkey AS VARCHAR) END AS c3,
           NULL::VARCHAR AS c4, NULL::VARCHAR AS c5, 6 AS width
    FROM orders
"""


def q_fixed(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    broken = F.concat(F.lit('"two\nlines, one cell",'), text("o_orderkey"))
    line = F.when(k % 5 == 0, F.concat(broken, F.lit("\n")))  # the extra line break leaves a blank line
    line = line.otherwise(F.concat_ws(",", F.col("o_orderstatus"), "o_orderkey", "o_custkey"))
    inbox = write_reports(table(spark, folder, "orders"), "o_orderkey", line)
    grid = fixed_grid(spark, inbox, 4, lineage="path")
    return grid.select("row_no", *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(4)])


FIXED_SQL = f"""
    SELECT row_number() OVER (PARTITION BY o_orderkey // {ROWS_PER_FILE} ORDER BY o_orderkey) - 1 AS row_no,
           CASE WHEN o_orderkey % 5 = 0 THEN 'two' || chr(10) || 'lines, one cell' ELSE o_orderstatus END AS c0,
           CAST(o_orderkey AS VARCHAR) AS c1,
           CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS c2, NULL::VARCHAR AS c3
    FROM orders
"""


def q_split_grid(spark: SparkSession, folder: str) -> DataFrame:
    """The same scan for files without quoted line breaks, which Spark may read in splits."""
    line = F.concat_ws(",", "o_orderkey", "o_orderstatus")
    inbox = write_reports(table(spark, folder, "orders"), "o_orderkey", line)
    grid = fixed_grid(spark, inbox, 2, multiline=False, lineage="path")
    return grid.select("row_no", F.get("cells", F.lit(0)).cast("long").alias("key"))


QUERIES = {
    "scan_csv_nulls": (q_csv_nulls, CSV_SQL),
    "scan_skip_rows": (
        q_skip_rows,
        "SELECT o_orderkey AS key, o_orderstatus AS status, o_totalprice AS price FROM orders",
    ),
    "scan_skip_bad_rows": (
        q_bad_rows,
        """SELECT o_orderkey AS key, o_orderstatus AS status,
           CASE WHEN o_orderkey % 7 <> 2 THEN o_totalprice END AS price FROM orders WHERE o_orderkey % 6 <> 1""",
    ),
    "scan_header_shift": (
        q_shift,
        """SELECT 'N' || o_orderkey AS label, o_orderkey AS "order", o_orderstatus AS key, o_totalprice AS status
           FROM orders WHERE o_orderkey % 6 <> 1""",
    ),
    "scan_ragged_grid": (q_ragged, RAGGED_SQL),
    "scan_fixed_grid": (q_fixed, FIXED_SQL),
    "scan_split_grid": (
        q_split_grid,
        f"""SELECT row_number() OVER (PARTITION BY o_orderkey // {ROWS_PER_FILE} ORDER BY o_orderkey) - 1 AS row_no,
            o_orderkey AS key FROM orders""",
    ),
}
