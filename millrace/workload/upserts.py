"""Versioned upserts: two deliveries of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import SilverSpec
from millrace.operators import upsert as up
from millrace.operators.dedup import latest_by_null_pattern
from millrace.session import workspace
from millrace.sinks.silver import SilverTable
from millrace.workload.tables import table

SPEC = SilverSpec("orders", ("order_id", "status"), dedup_timestamp="ingested_at")


def delivery(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """Delivery 1 lacks every third order; delivery 2 has the even ones, with every fourth repriced.

    One key part is missing on every fifth order, the whole key on every 35th.
    """
    key = F.col("o_orderkey")
    price = F.col("o_totalprice") + (F.when(key % 4 == 0, 1.0).otherwise(0.0) if n == 2 else F.lit(0.0))
    rows = table(spark, folder, "orders").where(key % 3 != 0 if n == 1 else key % 2 == 0)
    return rows.select(
        F.when(key % 35 != 0, key).alias("order_id"),
        F.when(key % 5 != 0, F.col("o_orderstatus")).alias("status"),
        price.alias("price"),
        F.lit(f"2024-01-0{n} 09:00:00").cast("timestamp_ntz").alias("ingested_at"),
        F.lit(f"orders_{n}.csv").alias("source_file"),
        F.lit(f"batch-{n}").alias("batch_id"),
    )


COLUMNS = "order_id, status, price, ingested_at, source_file, batch_id"


def _delivery_sql(n: int) -> str:
    price = "o_totalprice + CASE WHEN o_orderkey % 4 = 0 THEN 1.0 ELSE 0.0 END" if n == 2 else "o_totalprice"
    where = "o_orderkey % 3 <> 0" if n == 1 else "o_orderkey % 2 = 0"
    return f"""SELECT CASE WHEN o_orderkey % 35 <> 0 THEN o_orderkey END AS order_id,
        CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS status, {price} AS price,
        TIMESTAMP '2024-01-0{n} 09:00:00' AS ingested_at, 'orders_{n}.csv' AS source_file, 'batch-{n}' AS batch_id
        FROM orders WHERE {where} AND o_orderkey % 35 <> 0"""


SIDES = f"WITH a AS ({_delivery_sql(1)}), b AS ({_delivery_sql(2)})"
SAME = "a.order_id IS NOT DISTINCT FROM b.order_id AND a.status IS NOT DISTINCT FROM b.status"
A, B = (", ".join(f"{t}.{c.strip()}" for c in COLUMNS.split(",")) for t in "ab")
ALWAYS_SQL = f"""{SIDES}
    SELECT {A}, NOT EXISTS (SELECT 1 FROM b WHERE {SAME}) AS is_current FROM a
    UNION ALL SELECT {B}, true FROM b"""
INSERT_SQL = f"""{SIDES}
    SELECT {A}, true AS is_current FROM a
    UNION ALL SELECT {B}, true FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE {SAME})"""
CHANGE_SQL = f"""{SIDES}
    SELECT {A}, NOT EXISTS (SELECT 1 FROM b WHERE {SAME} AND a.price <> b.price) AS is_current FROM a
    UNION ALL SELECT {B}, true FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE {SAME} AND a.price = b.price)"""


def q_initial(spark: SparkSession, folder: str) -> DataFrame:
    return up.initial_version(delivery(spark, folder, 1), SPEC)


def _upserted(policy: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        existing = up.initial_version(delivery(spark, folder, 1), SPEC)
        return up.upsert(existing, delivery(spark, folder, 2), SPEC, policy)

    return query


def silver_after_two(spark: SparkSession, folder: str, policy: str) -> SilverTable:
    silver = SilverTable(spark, workspace(spark, "silver"), SPEC)
    for n in (1, 2, 2):
        silver.upsert(delivery(spark, folder, n), f"batch-{n}", policy)
    return silver


def q_stored_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return silver_after_two(spark, folder, "always").read()


def q_stored_current(spark: SparkSession, folder: str) -> DataFrame:
    return silver_after_two(spark, folder, "on_change").current()


def q_stats(spark: SparkSession, folder: str) -> DataFrame:
    existing = up.initial_version(delivery(spark, folder, 1), SPEC)
    fresh = latest_by_null_pattern(delivery(spark, folder, 2), SPEC.primary_keys, SPEC.dedup_timestamp)
    return up.upsert_stats(up.compare_versions(up.current_rows(existing), fresh, SPEC.primary_keys))


def q_indicator(spark: SparkSession, folder: str) -> DataFrame:
    return up.left_join_indicator(delivery(spark, folder, 2), delivery(spark, folder, 1), SPEC.primary_keys)


QUERIES = {
    "scd2_initial": (q_initial, f"{SIDES} SELECT {A}, true AS is_current FROM a"),
    "scd2_upsert": (q_stored_upsert, ALWAYS_SQL),
    "scd2_insert_new": (_upserted("insert_new"), INSERT_SQL),
    "scd2_on_change": (_upserted("on_change"), CHANGE_SQL),
    "scd2_current": (q_stored_current, f"SELECT * FROM ({CHANGE_SQL}) WHERE is_current"),
    "scd2_stats": (
        q_stats,
        f"""{SIDES} SELECT count(*) FILTER (a.price IS NULL) AS inserted,
            count(*) FILTER (a.price <> b.price) AS replaced, count(*) FILTER (a.price = b.price) AS skipped
            FROM b LEFT JOIN a ON {SAME}""",
    ),
    "join_left_indicator": (
        q_indicator,
        f"""WITH a AS ({_delivery_sql(1).replace(" AND o_orderkey % 35 <> 0", "")}),
                 b AS ({_delivery_sql(2).replace(" AND o_orderkey % 35 <> 0", "")})
            SELECT {B}, EXISTS (SELECT 1 FROM a WHERE {SAME}) AS is_match FROM b""",
    ),
}
