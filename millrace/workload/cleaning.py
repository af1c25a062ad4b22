"""Casts, cleaning and audit over a spoiled copy of lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import ColumnMap
from millrace.functions import casts
from millrace.operators.cleaning import cast_loss, clean_and_cast, clean_inferred
from millrace.workload.tables import every, table, text

LINE = {
    "Order Key": ColumnMap("int", "order_id"),
    "Part": ColumnMap("str", "part_id"),
    "Quantity": ColumnMap("int", "share_count"),
    "Price": ColumnMap("float", "price"),
    "Discount %": ColumnMap("pct", "discount_pct"),
    "Flag": ColumnMap("bool", "is_flagged"),
    "Ship Date": ColumnMap("datetime", "ship_date", "%m/%d/%Y"),
    "Not Delivered": ColumnMap("str", "absent"),
}


def spoiled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem as a vendor would send it: text with commas, quotes, blanks and bad values."""
    li = table(spark, folder, "lineitem")
    empty, bad = every(7, "l_orderkey", "l_linenumber"), every(11, "l_orderkey", "l_linenumber")

    def spoil(c):
        return F.when(empty, F.lit("")).when(bad, F.lit("bad")).otherwise(c)

    half = F.when(F.col("l_linenumber") % 2 == 0, 0.5).otherwise(0.0)
    return li.select(
        F.format_number("l_orderkey", 0).alias("Order Key"),
        F.concat(F.lit("  '"), text("l_partkey"), F.lit("\t ")).alias("Part"),
        spoil((F.col("l_quantity") + half).cast("string")).alias("Quantity"),
        spoil(F.format_number("l_extendedprice", 2)).alias("Price"),
        F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%")).alias("Discount %"),
        F.when(F.col("l_returnflag") == "A", "Yes")
        .when(F.col("l_returnflag") == "N", "no")
        .otherwise("maybe")
        .alias("Flag"),
        F.when(every(13, "l_orderkey"), "99/99/9999")
        .otherwise(F.date_format("l_shipdate", "MM/dd/yyyy"))
        .alias("Ship Date"),
        F.concat(F.lit("''"), text("l_linenumber"), F.lit(" ")).alias("Line/No."),
        text("l_suppkey").alias("Supp-Key "),
        F.when(F.col("l_linestatus") == "O", "N/A").otherwise("' x ").alias("$ Line Status"),
        text("l_tax").alias("Tax"),
    )


EMPTY = "(l_orderkey + l_linenumber) % 7 = 0"
BAD = "(l_orderkey + l_linenumber) % 11 = 0"
QUANTITY = "l_quantity + CASE WHEN l_linenumber % 2 = 0 THEN 0.5 ELSE 0 END"
TYPED = {
    "order_id": "l_orderkey",
    "part_id": "CAST(l_partkey AS VARCHAR)",
    "share_count": f"CASE WHEN {EMPTY} OR {BAD} THEN NULL ELSE CAST(round_even({QUANTITY}, 0) AS BIGINT) END",
    "price": f"CASE WHEN {EMPTY} OR {BAD} THEN NULL ELSE l_extendedprice END",
    "discount_pct": "CAST(round(l_discount * 100) AS INTEGER) / 100.0::DOUBLE",
    "is_flagged": "CASE l_returnflag WHEN 'A' THEN true WHEN 'N' THEN false END",
    "ship_date": "CASE WHEN l_orderkey % 13 <> 0 THEN strftime((l_shipdate AT TIME ZONE 'America/New_York')"
    " AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') END",
    "line_no_": "CAST(l_linenumber AS VARCHAR)",
    "supp_key": "CAST(l_suppkey AS VARCHAR)",
    "_line_status": "CASE WHEN l_linestatus = 'O' THEN 'N/A' ELSE ' x' END",
}


def _readable(df: DataFrame) -> DataFrame:
    return df.withColumn("ship_date", F.date_format("ship_date", "yyyy-MM-dd HH:mm:ss"))


def q_clean_and_cast(spark: SparkSession, folder: str) -> DataFrame:
    return _readable(clean_and_cast(spoiled_lines(spark, folder), LINE)).drop("tax")


def _cast_one(source: str, target: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        raw = spoiled_lines(spark, folder)
        value = casts.converter(LINE[source].dtype)(F.col(f"`{source}`"), raw.schema[source].dataType, LINE[source])
        if target == "ship_date":
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        return raw.groupBy(F.col("`Supp-Key `").alias("supp_key"), value.alias(target)).agg(F.count("*").alias("n"))

    sql = f"""SELECT CAST(l_suppkey AS VARCHAR) AS supp_key, {TYPED[target]} AS {target}, count(*) AS n
        FROM lineitem GROUP BY ALL"""
    return query, sql


def q_cast_loss(spark: SparkSession, folder: str) -> DataFrame:
    loss = cast_loss(spoiled_lines(spark, folder), LINE)
    return loss.withColumn("samples", F.array_join("samples", "|"))


CAST_LOSS_SQL = f"""
    WITH spoiled AS (
        SELECT CASE WHEN {EMPTY} THEN '' WHEN {BAD} THEN 'bad' END AS cell,
               CASE WHEN l_orderkey % 13 = 0 THEN '99/99/9999' END AS day,
               CASE WHEN l_returnflag = 'R' THEN 'maybe' END AS flag
        FROM lineitem
    ), lost AS (
        SELECT 'share_count' AS "column", cell AS v FROM spoiled WHERE cell IS NOT NULL
        UNION ALL SELECT 'price', cell FROM spoiled WHERE cell IS NOT NULL
        UNION ALL SELECT 'ship_date', day FROM spoiled WHERE day IS NOT NULL
        UNION ALL SELECT 'is_flagged', flag FROM spoiled WHERE flag IS NOT NULL
    )
    SELECT "column", count(*) AS lost, count(*) FILTER (v = '') AS empty,
           string_agg(DISTINCT v, '|' ORDER BY v) AS samples
    FROM lost GROUP BY "column"
"""


def q_infer_types(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    missing = F.when(F.col("o_orderkey") % 9 == 0, F.lit("n/a")).when(F.col("o_orderkey") % 10 == 0, F.lit("NULL"))
    day = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    raw = o.select(
        F.format_number("o_orderkey", 0).alias("order_id"),
        F.coalesce(missing, F.concat(F.lit("$"), F.format_number("o_totalprice", 2))).alias("price"),
        F.coalesce(missing, day).alias("day"),
        F.concat(F.lit("  '"), F.col("o_orderstatus")).alias("status"),
        F.coalesce(missing, text("o_custkey")).alias("customer"),
    )
    return clean_inferred(raw, {"customer": "int"})


INFER_SQL = """
    WITH o AS (SELECT *, o_orderkey % 9 = 0 OR o_orderkey % 10 = 0 AS missing FROM orders)
    SELECT o_orderkey AS order_id, CASE WHEN NOT missing THEN o_totalprice END AS price,
           CASE WHEN NOT missing THEN CAST(o_orderdate AS DATE) END AS day, o_orderstatus AS status,
           CASE WHEN NOT missing THEN o_custkey END AS customer
    FROM o
"""

QUERIES = {
    "clean_and_cast": (
        q_clean_and_cast,
        "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in TYPED.items())
        + " FROM (SELECT DISTINCT * FROM lineitem)",
    ),
    "cast_string": _cast_one("Part", "part_id"),
    "cast_float": _cast_one("Price", "price"),
    "cast_int": _cast_one("Quantity", "share_count"),
    "cast_bool": _cast_one("Flag", "is_flagged"),
    "cast_pct": _cast_one("Discount %", "discount_pct"),
    "cast_datetime": _cast_one("Ship Date", "ship_date"),
    "cast_loss_audit": (q_cast_loss, CAST_LOSS_SQL),
    "infer_types": (q_infer_types, INFER_SQL),
}
