"""Row hashes, validity, quarantine and reference links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.quality import flag_validity, link_reference, quarantine, row_hash
from millrace.workload.tables import table


def q_hash(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority")
    )
    return row_hash(o)


def _flagged(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    rules = {
        "negative balance": F.col("c_acctbal") >= 0,
        "no segment": F.when(F.col("c_custkey") % 6 != 0, F.col("c_mktsegment")).isNotNull(),
        "unknown nation": F.when(F.col("c_custkey") % 10 != 0, F.col("c_nationkey") < 25),
    }
    return flag_validity(c, rules)


FLAG_SQL = """
    SELECT *, nullif(concat_ws('; ', CASE WHEN c_acctbal < 0 THEN 'negative balance' END,
             CASE WHEN c_custkey % 6 = 0 THEN 'no segment' END, CASE WHEN c_custkey % 10 = 0 THEN 'unknown nation' END), '') AS _error_reason,
           _error_reason IS NULL AS _is_valid
    FROM customer
"""


def q_validity(spark: SparkSession, folder: str) -> DataFrame:
    return _flagged(spark, folder)


def q_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    parts = quarantine(_flagged(spark, folder))
    return parts["valid"].withColumn("zone", F.lit("silver")).unionByName(parts["quarantine"].withColumn("zone", F.lit("quarantine")))


def q_link(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").where("n_nationkey % 4 <> 0")
    return link_reference(table(spark, folder, "customer"), nations, {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])


QUERIES = {
    "row_hash": (
        q_hash,
        """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS priority,
           sha256(concat_ws(chr(31), '=' || o_orderkey, '=' || o_orderstatus,
             CASE WHEN o_orderkey % 3 <> 0 THEN '=' || o_orderpriority ELSE '-' END)) AS _derived_hash_id FROM orders""",
    ),
    "validity_flags": (q_validity, FLAG_SQL),
    "quarantine_split": (q_quarantine, f"SELECT *, CASE WHEN _is_valid THEN 'silver' ELSE 'quarantine' END AS zone FROM ({FLAG_SQL})"),
    "reference_link": (
        q_link,
        """SELECT c.*, n_name, n_regionkey FROM customer c
           LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 4 <> 0) ON c_nationkey = n_nationkey""",
    ),
}
