"""The analysis SQL over views, and the position roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import fund_code, long_code_class, split_part
from millrace.operators.rollup import position_rollup
from millrace.plans import analysis
from millrace.session import workspace
from millrace.sinks import write_csv
from millrace.sources.delimited import scan_delimited
from millrace.sources.tables import register_view
from millrace.workload.tables import table, text

STOCK_SQL = """
    SELECT p_partkey AS part_id, CASE p_type WHEN 'ECONOMY' THEN 'scrap' WHEN 'STANDARD' THEN 'spare' ELSE p_type END AS kind,
           CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS label,
           CASE p_size % 4 WHEN 0 THEN 'east' WHEN 1 THEN 'west' WHEN 2 THEN 'north' END AS depot,
           p_name AS title, CASE WHEN p_size % 5 <> 0 THEN p_retailprice END AS price
    FROM part
"""


def _stock(spark: SparkSession, folder: str) -> DataFrame:
    register_view(spark, "millrace_part", f"{folder}/part.parquet", merge_schema=False)
    return spark.sql(STOCK_SQL.replace("FROM part", "FROM millrace_part"))


def q_case(spark: SparkSession, folder: str) -> DataFrame:
    return analysis.with_fallback(_stock(spark, folder), "shown_as", "label", "depot", unless=("kind", "scrap"))


def q_not_in(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["title", "price", "kind", "depot"]
    return analysis.distinct_where(_stock(spark, folder), columns, {"kind": "spare"}, {"depot": ["east", "west"]})


CODES_SQL = """
    SELECT concat('''''', replace(p_brand, '#', '.'), '.U') AS quoted,
           concat(lpad(CAST(p_size AS VARCHAR(2)), 4, '0'), substr(p_type, 1, p_partkey % 5)) AS long_code
    FROM part
"""


def q_codes(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(
        F.concat(F.lit("''"), F.replace(F.col("p_brand"), F.lit("#"), F.lit(".")), F.lit(".U")).alias("quoted"),
        F.concat(F.lpad(text("p_size"), 4, "0"), F.substr("p_type", F.lit(1), (F.col("p_partkey") % 5).cast("int"))).alias("long_code"),
    )
    long_code = F.col("long_code")
    return analysis.distinct_pieces(
        parts, code=fund_code(F.col("quoted")), stem=F.left(long_code, F.lit(4)), series=long_code_class(long_code)
    )


CUSTOMERS_SQL = """
    SELECT CASE WHEN c_custkey % 2 = 0 THEN 'N' || c_nationkey || c_mktsegment END AS own_region,
           'N' || c_nationkey || c_mktsegment AS region,
           CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE c_mktsegment || '/' || c_custkey % 7 END AS branch,
           c_custkey % 4 AS terms,
           CASE WHEN c_custkey % 10 = 0 THEN c_custkey % 30 END AS account
    FROM customer
"""


def q_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """The customer list arrives as CSV and is queried as a relation."""
    k = F.col("c_custkey")
    code = F.concat(F.lit("N"), text("c_nationkey"), F.col("c_mktsegment"))
    customers = table(spark, folder, "customer").select(
        F.when(k % 2 == 0, code).alias("own_region"), code.alias("region"),
        F.when(k % 3 == 0, F.col("c_mktsegment")).otherwise(F.concat(F.col("c_mktsegment"), F.lit("/"), (k % 7).cast("string"))).alias("branch"),
        (k % 4).alias("terms"), F.when(k % 10 == 0, k % 30).alias("account"),
    )
    path = workspace(spark, "csv")
    write_csv(customers, path)
    register_view(spark, "millrace_customers", scan_delimited(spark, path))
    rows = spark.sql("SELECT coalesce(own_region, region) AS area, branch, terms, account FROM millrace_customers")
    filled = analysis.borrow_missing(rows, "area", "account")
    branch = F.col("branch")
    return analysis.distinct_pieces(
        filled, area=F.col("area"), branch=split_part(branch, "/", 1), desk=split_part(branch, "/", 2),
        terms=F.col("terms"), account=F.col("account").cast("string"),
    )


ACCOUNTS_SQL = f"""
    WITH base AS (SELECT *, coalesce(own_region, region) AS area FROM ({CUSTOMERS_SQL})),
    n AS (SELECT DISTINCT area, branch, terms, account FROM base),
    k AS (SELECT DISTINCT area, account FROM base WHERE account IS NOT NULL)
    SELECT DISTINCT n.area, nullif(string_split(n.branch, '/')[1], '') AS branch, string_split(n.branch, '/')[2] AS desk,
           CAST(n.terms AS VARCHAR) AS terms, CAST(coalesce(n.account, k.account) AS VARCHAR) AS account
    FROM n LEFT JOIN k ON n.area = k.area
"""


def q_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Roll lineitem up as positions, write it as CSV, read the CSV back."""
    li = table(spark, folder, "lineitem").select(
        F.concat(text("l_suppkey"), F.lit(" - "), F.col("l_returnflag")).alias("holder"),
        F.when(F.col("l_orderkey") % 50 != 0, F.col("l_linestatus")).alias("suffix"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_partkey")).alias("Part"),
        F.col("l_quantity").cast("long").alias("Total Units"),
        F.when(F.col("l_linenumber") > 2, F.col("l_shipdate").cast("date")).alias("Day"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("_row"),
    )
    rolled = position_rollup(li, ["holder", "suffix"], "_row", ["Total Units"], clean_keys=["holder"])
    path = workspace(spark, "csv")
    write_csv(rolled, path)
    return scan_delimited(spark, path).drop("source_file")


ROLLUP_SQL = """
    WITH li AS (
        SELECT CAST(l_suppkey AS VARCHAR) AS fund, CASE WHEN l_orderkey % 50 <> 0 THEN l_linestatus END AS sup, *,
               (l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS r FROM lineitem
    )
    SELECT fund AS "holder", sup AS "suffix",
           CAST(first(l_partkey ORDER BY r) FILTER (l_partkey % 5 <> 0) AS VARCHAR) AS "Part",
           CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR) AS "Total Units",
           strftime(first(l_shipdate ORDER BY r) FILTER (l_linenumber > 2), '%Y-%m-%d') AS "Day"
    FROM li WHERE sup IS NOT NULL GROUP BY ALL
"""

QUERIES = {
    "sql_case_coalesce": (
        q_case,
        f"SELECT CASE WHEN kind <> 'scrap' THEN coalesce(label, depot) END AS shown_as, * FROM ({STOCK_SQL})",
    ),
    "sql_distinct_not_in": (
        q_not_in,
        f"""SELECT DISTINCT title, price, kind, depot FROM ({STOCK_SQL})
            WHERE kind = 'spare' AND depot NOT IN ('east', 'west')""",
    ),
    "sql_fund_codes": (
        q_codes,
        f"""SELECT DISTINCT replace(ltrim(quoted, ''''), '.', '/') AS code, left(long_code, 4) AS stem,
            CASE WHEN len(long_code) > 6 THEN substring(long_code, 5, 1) END AS series FROM ({CODES_SQL})""",
    ),
    "sql_cte_self_join": (q_accounts, ACCOUNTS_SQL),
    "position_rollup": (q_rollup, ROLLUP_SQL),
}
