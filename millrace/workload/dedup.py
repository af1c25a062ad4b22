"""Duplicate removal and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import dedup
from millrace.workload.tables import table


def doubled_orders(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    return o.unionByName(o.where("o_orderkey % 4 = 0"))


def q_exact(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.exact_with_count(doubled_orders(spark, folder))


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")


def q_latest(spark: SparkSession, folder: str) -> DataFrame:
    e = events(spark, folder).withColumn("ts", F.when(F.col("event_id") % 3 != 0, F.col("ts")))
    return dedup.latest_per_key(e, ["user_id", "event_type"], "ts", ["event_id"])


def holey_events(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).withColumns(
        {
            "user_id": F.when(F.col("event_id") % 5 > 0, F.col("user_id")),
            "event_type": F.when(F.col("event_id") % 7 > 1, F.col("event_type")),
        }
    )


HOLEY_SQL = """
    SELECT event_id, ts, CASE WHEN event_id % 5 > 0 THEN user_id END AS user_id,
           CASE WHEN event_id % 7 > 1 THEN event_type END AS event_type, value
    FROM events
"""


def q_null_pattern(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.latest_by_null_pattern(holey_events(spark, folder), ["user_id", "event_type"], "ts")


def q_pattern_profile(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.key_pattern_profile(holey_events(spark, folder), ["user_id", "event_type"])


def q_unique(spark: SparkSession, folder: str) -> DataFrame:
    e = events(spark, folder).withColumn("minute", F.date_trunc("minute", "ts").cast("timestamp_ntz")).drop("ts")
    e = e.withColumn("value", F.floor("value"))
    kept = [
        dedup.unique_by(e, ["event_type", "value"], ["event_id"], keep).withColumn("keep", F.lit(keep))
        for keep in ("first", "last", "none")
    ]
    return dedup.union_evolving(*kept)


UNIQUE_SQL = """
    WITH e AS (
        SELECT event_id, user_id, event_type, CAST(floor(value) AS BIGINT) AS value, date_trunc('minute', ts) AS minute
        FROM events
    ), n AS (
        SELECT *, row_number() OVER (PARTITION BY event_type, value ORDER BY event_id) AS up,
               row_number() OVER (PARTITION BY event_type, value ORDER BY event_id DESC) AS down
        FROM e
    )
    SELECT event_id, user_id, event_type, value, minute, k.keep
    FROM n, (VALUES ('first'), ('last'), ('none')) k(keep)
    WHERE (k.keep = 'first' AND up = 1) OR (k.keep = 'last' AND down = 1) OR (k.keep = 'none' AND up = 1 AND down = 1)
"""


def q_union(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer").select("c_custkey", "c_name")
    s = table(spark, folder, "supplier").select("s_suppkey", F.col("s_name").alias("c_name"), "s_acctbal")
    return dedup.union_evolving(c, s)


QUERIES = {
    "dedup_exact": (
        q_exact,
        """SELECT *, count(*) - 1 AS removed
           FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 4 = 0) GROUP BY ALL""",
    ),
    "dedup_latest": (
        q_latest,
        """SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN ts END AS ts, user_id, event_type, value FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id, event_type
             ORDER BY CASE WHEN event_id % 3 <> 0 THEN ts END DESC NULLS LAST, event_id DESC) = 1""",
    ),
    "dedup_null_pattern": (
        q_null_pattern,
        f"""SELECT * FROM ({HOLEY_SQL}) WHERE user_id IS NOT NULL OR event_type IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "null_pattern_profile": (
        q_pattern_profile,
        f"""SELECT CASE WHEN user_id IS NULL AND event_type IS NULL THEN 'none'
                        WHEN user_id IS NULL OR event_type IS NULL THEN 'partial' ELSE 'full' END AS pattern,
                   user_id IS NULL AS user_id_null, event_type IS NULL AS event_type_null, count(*) AS "rows"
            FROM ({HOLEY_SQL}) GROUP BY ALL""",
    ),
    "unique_keep": (q_unique, UNIQUE_SQL),
    "union_evolving": (
        q_union,
        """SELECT c_custkey, c_name, NULL::BIGINT AS s_suppkey, NULL::DOUBLE AS s_acctbal FROM customer
           UNION ALL SELECT NULL, s_name, s_suppkey, s_acctbal FROM supplier""",
    ),
}
