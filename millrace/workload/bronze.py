"""Bronze tables and the replay to silver."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import ColumnMap, FeedSpec, SilverSpec
from millrace.operators.dedup import union_evolving
from millrace.operators.routing import add_audit
from millrace.plans.medallion import Lake
from millrace.session import workspace
from millrace.sinks.bronze import write_bronze
from millrace.sources.tables import read_table
from millrace.workload.scans import write_reports
from millrace.workload.tables import table, text

AT = datetime(2024, 1, 2, 14, 30)


def _batch(df: DataFrame, batch: str) -> DataFrame:
    return add_audit(df, batch, AT, f"{batch}.csv").drop("ingested_at")


def q_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches, the second with a new column and delivered twice."""
    o = table(spark, folder, "orders")
    path = workspace(spark, "bronze")
    write_bronze(_batch(o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_totalprice"), "a"), path)
    for _ in range(2):
        write_bronze(_batch(o.where("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus"), "b"), path)
    return read_table(spark, path)


APPEND_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice,
           CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS batch_id,
           CASE WHEN o_orderkey % 2 = 0 THEN 'a.csv' ELSE 'b.csv' END AS source_file
    FROM orders
"""


def q_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """The same overwrite with the old schema kept, and with it replaced."""
    o = table(spark, folder, "orders")
    results = []
    for merge in (True, False):
        path = workspace(spark, "bronze")
        write_bronze(_batch(o.select("o_orderkey", "o_custkey"), "a"), path)
        write_bronze(_batch(o.select("o_orderkey", "o_orderstatus"), "b"), path, "overwrite", merge_schema=merge)
        result = read_table(spark, path)
        results.append(result.withColumn("columns", F.lit(",".join(sorted(result.columns)))))
    return union_evolving(*results)


OVERWRITE_SQL = """
    SELECT o_orderkey, NULL::BIGINT AS o_custkey, o_orderstatus, 'b.csv' AS source_file, 'b' AS batch_id,
           unnest(['batch_id,o_custkey,o_orderkey,o_orderstatus,source_file', 'batch_id,o_orderkey,o_orderstatus,source_file'])
             AS "columns"
    FROM orders
"""


def q_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = workspace(spark, "bronze")
    write_bronze(_batch(table(spark, folder, "lineitem"), "all"), path)
    return read_table(spark, path)


FEEDS = [
    FeedSpec(
        r"orders_a", "csv", "orders_a",
        silver=SilverSpec("orders", ("order_id",), {"Order": ColumnMap("int", "order_id"), "Price": ColumnMap("float", "price")}),
    ),
    FeedSpec(
        r"orders_b", "csv", "orders_b", load_type="overwrite", rename=True,
        silver=SilverSpec(
            "orders_kept", ("order_id",), {"Order": ColumnMap("int", "order_id"), "Price": ColumnMap("float", "price")},
            dedup_timestamp="order_id",
        ),
    ),
    FeedSpec(r"missing", "csv", "never_landed", silver=SilverSpec("never", ("id",))),
]


def q_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Two bronze tables, replayed twice: the second replay changes nothing."""
    lake = Lake(spark, workspace(spark, "lake"), FEEDS)
    raw = table(spark, folder, "orders").select(
        F.format_number("o_orderkey", 0).alias("Order"), text("o_totalprice").alias("Price"),
        F.concat(F.lit("'"), F.col("o_orderstatus")).alias("Order Status"), F.lit("in.csv").alias("source_file"),
    )
    for feed, batches in zip(FEEDS[:2], (("a1", "a2"), ("b1", "b2")), strict=True):
        for batch in batches:
            lake.land(feed, raw, batch, AT)
    for run in ("replay-1", "replay-2"):
        states = lake.replay(run)
    tables = [lake.silver_table(f).read().withColumn("table", F.lit(f.silver.table)) for f in FEEDS[:2]]
    both = union_evolving(*tables).drop("ingested_at")
    return both.withColumn("states", F.lit(",".join(f"{k}={v}" for k, v in sorted(states.items()))))


REPLAY_SQL = """
    SELECT o_orderkey AS order_id, o_totalprice AS price, o_orderstatus AS order_status,
           CASE t.name WHEN 'orders' THEN 'in.csv' ELSE 'in_20240102_1430.csv' END AS source_file, t.batch AS batch_id,
           true AS is_current, t.name AS "table", 'never=missing,orders=done,orders_kept=done' AS states
    FROM orders, (VALUES ('orders', 'a2')) t(name, batch)
    UNION ALL
    SELECT o_orderkey, o_totalprice, o_orderstatus, 'in_20240102_1430.csv', 'b2', true, 'orders_kept',
           'never=missing,orders=done,orders_kept=done' FROM orders
"""


def q_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """A whole inbox run: files to bronze to silver, read back from silver."""
    lake = Lake(spark, workspace(spark, "lake"), [
        FeedSpec(r"delivery=", "csv", "never_matched_by_name"),
        FeedSpec(r"^part-.*\.txt$", "csv", "orders", silver=SilverSpec(
            "orders", ("order_id", "status"),
            {"Order Key": ColumnMap("int", "order_id"), "Total": ColumnMap("float", "total"),
             "Day": ColumnMap("datetime", "ordered_at", "%Y%m%d")},
        )),
    ])
    line = F.concat_ws(",", "o_orderkey", F.concat(F.lit("' "), F.col("o_orderstatus")), F.concat(F.lit('"'), F.format_number("o_totalprice", 2), F.lit('"')), F.date_format("o_orderdate", "yyyyMMdd"))
    inbox = write_reports(table(spark, folder, "orders"), "o_orderkey", line, ("Order Key,Status,Total,Day",))
    manifest = lake.ingest(inbox, AT, "run-1")
    good = manifest.where("status = 'processed' AND error IS NULL").count()
    silver = lake.silver_table(lake.feeds[1]).current().drop("ingested_at", "source_file")
    return silver.withColumns({"ordered_at": F.date_format("ordered_at", "yyyy-MM-dd HH:mm"), "files": F.lit(good)})


INGEST_SQL = """
    SELECT o_orderkey AS order_id, ' ' || o_orderstatus AS status, o_totalprice AS total,
           strftime((o_orderdate AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M') AS ordered_at,
           'run-1' AS batch_id, true AS is_current, (SELECT count(DISTINCT o_orderkey // 5000) FROM orders) AS files
    FROM orders
"""

QUERIES = {
    "bronze_append_evolve": (q_append, APPEND_SQL),
    "bronze_overwrite": (q_overwrite, OVERWRITE_SQL),
    "bronze_roundtrip": (q_roundtrip, "SELECT *, 'all.csv' AS source_file, 'all' AS batch_id FROM lineitem"),
    "replay_silver": (q_replay, REPLAY_SQL),
    "ingest_inbox": (q_ingest, INGEST_SQL),
}
