"""Incremental ingest of an inbox that fills up between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import ColumnMap, SilverSpec
from millrace.session import workspace
from millrace.sinks.silver import SilverTable
from millrace.sources.tables import read_table
from millrace.streaming import stream_bronze, stream_csv, stream_outcomes, stream_silver
from millrace.workload.tables import table

COLUMNS = ["Order", "Status", "Price"]
SPEC = SilverSpec(
    "orders", ("order_id",),
    {"Order": ColumnMap("int", "order_id"), "Status": ColumnMap("str", "status"), "Price": ColumnMap("float", "price")},
)


def _deliver(df: DataFrame, inbox: str, price) -> None:
    rows = df.select(F.format_number("o_orderkey", 0), F.concat(F.lit("'"), F.col("o_orderstatus")), price.cast("string"))
    rows.toDF(*COLUMNS).write.mode("append").option("header", True).csv(inbox)


def q_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries, three runs: each file is taken once."""
    o = table(spark, folder, "orders")
    inbox, path, check = (workspace(spark, n) for n in ("inbox", "bronze", "checkpoint"))
    for part in (0, 1, None):
        if part is not None:
            _deliver(o.where(F.col("o_orderkey") % 2 == part), inbox, F.col("o_totalprice"))
        stream_bronze(stream_csv(spark, inbox, COLUMNS), path, check, "run").awaitTermination()
    return read_table(spark, path).select(*COLUMNS, "batch_id")


def q_silver(spark: SparkSession, folder: str) -> DataFrame:
    """A second delivery repeats every third order and changes every sixth."""
    o = table(spark, folder, "orders")
    k = F.col("o_orderkey")
    inbox, root, check = (workspace(spark, n) for n in ("inbox", "silver", "checkpoint"))
    silver = SilverTable(spark, root, SPEC)
    for delivery in (1, 2):
        rows = o if delivery == 1 else o.where(k % 3 == 0)
        price = F.col("o_totalprice") + (F.when(k % 6 == 0, 1.0).otherwise(0.0) if delivery == 2 else F.lit(0.0))
        _deliver(rows, inbox, price)
        stream_silver(stream_csv(spark, inbox, COLUMNS), silver, check, "run").awaitTermination()
    return silver.read().select("order_id", "status", "price", "is_current", "batch_id")


SILVER_SQL = """
    SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS price, o_orderkey % 6 <> 0 AS is_current, 'run-0' AS batch_id
    FROM orders
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice + 1.0, true, 'run-1' FROM orders WHERE o_orderkey % 6 = 0
"""


def q_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Row and misfit counts per run; some rows have a field too many."""
    o = table(spark, folder, "orders")
    inbox, path, check = (workspace(spark, n) for n in ("inbox", "manifest", "checkpoint"))
    line = F.concat_ws(",", "o_orderkey", "o_orderstatus", "o_totalprice")
    o.select(F.when(F.col("o_orderkey") % 8 == 0, F.concat(line, F.lit(",x"))).otherwise(line).alias("value")).write.text(inbox)
    rows = stream_csv(spark, inbox, COLUMNS, header=False, keep_corrupt=True)
    stream_outcomes(rows, path, check, "run").awaitTermination()
    found = read_table(spark, path)
    return found.groupBy("status", "batch_id").agg(F.sum("rows").alias("n_rows"), F.sum("bad_rows").alias("n_bad"))


QUERIES = {
    "stream_bronze": (
        q_bronze,
        """SELECT format('{:,}', o_orderkey) AS "Order", '''' || o_orderstatus AS "Status", CAST(o_totalprice AS VARCHAR) AS "Price",
           'run-' || o_orderkey % 2 AS batch_id FROM orders""",
    ),
    "stream_silver": (q_silver, SILVER_SQL),
    "stream_outcomes": (
        q_outcomes,
        """SELECT 'processed' AS status, 'run-0' AS batch_id, count(*) AS n_rows, count(*) FILTER (o_orderkey % 8 = 0) AS n_bad
           FROM orders""",
    ),
}
