"""Names, casts by map, filters, splits and chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.columns import (
    apply_transformations,
    cast_columns,
    drop_columns,
    filter_rows,
    normalize_column_names,
    rename_columns,
    snake_case_columns,
    split_table,
    validate_columns,
)
from millrace.operators.dedup import unique_by
from millrace.workload.tables import table, text


def awkward_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias(" Order-Key "),
        F.col("o_custkey").alias("Cust/Key"),
        F.col("o_orderstatus").alias("$ Order  Status"),
        F.col("o_totalprice").alias("Total.Price (CAD)"),
    )


def q_snake(spark: SparkSession, folder: str) -> DataFrame:
    return snake_case_columns(awkward_orders(spark, folder))


def q_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return normalize_column_names(awkward_orders(spark, folder))


def q_cast_columns(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "orders").select(
        text("o_orderkey").alias("key"),
        F.when(F.col("o_orderkey") % 5 == 0, "x").otherwise(text("o_totalprice")).alias("price"),
        F.when(F.col("o_orderkey") % 4 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(F.col("o_orderstatus") == "F", "true").when(F.col("o_orderstatus") == "O", "false").otherwise("?").alias("done"),
        F.col("o_custkey").alias("customer"),
    )
    wanted = {"key": "Int64", "price": "Float64", "day": "Date", "done": "Boolean", "customer": "Utf8", "gone": "Int64"}
    return cast_columns(raw, wanted)


CAST_COLUMNS_SQL = """
    SELECT o_orderkey AS key, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price,
           CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
           CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS done,
           CAST(o_custkey AS VARCHAR) AS customer
    FROM orders
"""


def q_rename(spark: SparkSession, folder: str) -> DataFrame:
    return rename_columns(table(spark, folder, "supplier"), {"s_suppkey": "supplier_id", "s_acctbal": "balance"})


def q_drop(spark: SparkSession, folder: str) -> DataFrame:
    return drop_columns(table(spark, folder, "supplier"), ["s_name", "never_there"])


def q_validate(spark: SparkSession, folder: str) -> DataFrame:
    return validate_columns(table(spark, folder, "customer"), ["c_custkey", "c_acctbal"])


def q_filter(spark: SparkSession, folder: str) -> DataFrame:
    return filter_rows(table(spark, folder, "part"), lambda d: d.where("p_size > 25 AND p_type <> 'ECONOMY'"))


def q_split(spark: SparkSession, folder: str) -> DataFrame:
    parts = split_table(
        table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"),
        lambda d: {"open": d.where("o_orderstatus = 'O'"), "other": d.where("o_orderstatus <> 'O'")},
    )
    tagged = [df.withColumn("part", F.lit(name)) for name, df in parts.items()]
    return tagged[0].unionByName(tagged[1])


def q_chain(spark: SparkSession, folder: str) -> DataFrame:
    return apply_transformations(
        awkward_orders(spark, folder),
        [
            (normalize_column_names, {}),
            (rename_columns, {"rename_map": {"totalprice_cad": "price"}}),
            (cast_columns, {"cast_map": {"price": "Int64"}}),
            (filter_rows, {"filter_fn": lambda d: d.where("price > 1000")}),
            (unique_by, {"keys": ["custkey"], "order": ["order_key"]}),
            (drop_columns, {"columns": ["_order_status"]}),
        ],
    )


QUERIES = {
    "snake_case_columns": (
        q_snake,
        """SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS _order_status,
           o_totalprice AS total_price_cad FROM orders""",
    ),
    "normalize_column_names": (
        q_normalize,
        """SELECT o_orderkey AS order_key, o_custkey AS custkey, o_orderstatus AS _order_status,
           o_totalprice AS totalprice_cad FROM orders""",
    ),
    "cast_columns": (q_cast_columns, CAST_COLUMNS_SQL),
    "rename_columns": (
        q_rename,
        "SELECT s_suppkey AS supplier_id, s_name, s_nationkey, s_acctbal AS balance FROM supplier",
    ),
    "drop_columns": (q_drop, "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier"),
    "validate_columns": (q_validate, "SELECT * FROM customer"),
    "filter_rows": (q_filter, "SELECT * FROM part WHERE p_size > 25 AND p_type <> 'ECONOMY'"),
    "split_table": (
        q_split,
        """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS part
           FROM orders""",
    ),
    "transform_chain": (
        q_chain,
        """SELECT o_orderkey AS order_key, o_custkey AS custkey, CAST(trunc(o_totalprice) AS BIGINT) AS price
           FROM orders WHERE trunc(o_totalprice) > 1000
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
    ),
}
