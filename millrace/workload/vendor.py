"""Vendor responses built from events, customers and orders, flattened again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import field_value
from millrace.operators import vendor
from millrace.session import workspace
from millrace.workload.tables import table, text

PER_MESSAGE = 500


def _pairs(**fields: Column) -> Column:
    """A map without the absent fields."""
    entries = [F.when(v.isNotNull(), F.struct(F.lit(k).alias("key"), v.alias("value"))) for k, v in fields.items()]
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def _landed(df: DataFrame) -> DataFrame:
    """Responses as they land: JSON lines, read back with their schema."""
    path = workspace(df.sparkSession, "responses")
    df.write.json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def history_responses(spark: SparkSession, folder: str) -> DataFrame:
    """One message per user and run of events: at most ``PER_MESSAGE`` entries each."""
    k = F.get_json_object("props", "$.k").cast("double")
    fields = _pairs(PX_LAST=F.col("value"), VOLUME=F.when(F.col("event_id") % 3 != 0, k))
    e = table(spark, folder, "events").select(
        F.concat(F.lit("U"), text("user_id"), F.lit(" CN Equity")).alias("ticker"),
        F.floor(F.col("event_id") / PER_MESSAGE).alias("_message"),
        F.struct(F.to_date("ts").alias("date"), fields.alias("fields")).alias("entry"),
    )
    return e.groupBy("ticker", "_message").agg(F.collect_list("entry").alias("entries")).drop("_message")


def q_history(spark: SparkSession, folder: str) -> DataFrame:
    return vendor.history_rows(_landed(history_responses(spark, folder)), ["PX_LAST", "VOLUME", "NEVER"])


HISTORY_SQL = """
    SELECT 'U' || user_id || ' CN Equity' AS "Ticker", CAST(ts AS DATE) AS "Date", value AS "PX_LAST",
           CASE WHEN event_id % 3 <> 0 THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS "VOLUME", NULL::DOUBLE AS "NEVER"
    FROM events
"""


def q_on_dates(spark: SparkSession, folder: str) -> DataFrame:
    history = vendor.history_rows(history_responses(spark, folder), ["PX_LAST"])
    c = table(spark, folder, "customer").where("c_custkey % 3 = 0")
    tickers = vendor.ticker_universe(c.select(F.concat(F.lit("U"), text("c_custkey")).alias("t")), "t", " CN Equity")
    days = table(spark, folder, "events").where("event_type = 'error'").select(F.date_format("ts", "yyyy-MM-dd").alias("day")).where("day LIKE '%5'")
    dates = vendor.request_dates(days, "day").select(F.to_date("request_date", "yyyyMMdd").alias("Date"))
    return vendor.history_on_dates(history, tickers.withColumnRenamed("ticker", "Ticker"), dates)


ON_DATES_SQL = f"""
    SELECT "Ticker", "Date", "PX_LAST" FROM ({HISTORY_SQL})
    WHERE "Ticker" IN (SELECT 'U' || c_custkey || ' CN Equity' FROM customer WHERE c_custkey % 3 = 0)
      AND "Date" IN (SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'error' AND strftime(ts, '%Y-%m-%d') LIKE '%5')
"""


def q_reference(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    fields = _pairs(
        NAME=F.concat(F.lit('NAME = "'), F.col("c_name"), F.lit('"\n')),
        SECTOR=F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit('" '))),
        BALANCE=text("c_acctbal"),
    )
    security = F.struct(F.concat(F.lit("C"), text("c_custkey")).alias("ticker"), fields.alias("fields"))
    responses = c.groupBy(F.floor(F.col("c_custkey") / PER_MESSAGE).alias("_m")).agg(F.collect_list(security).alias("securities"))
    wanted = {"NAME": "string", "SECTOR": "string", "BALANCE": "double", "NEVER": "string"}
    return vendor.reference_rows(_landed(responses.drop("_m")), wanted)


def q_bulk(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    entry = F.create_map(
        F.lit("Declared Date"), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit("Dividend Amount"), text("o_totalprice"), F.lit("Frequency"), F.col("o_orderpriority"),
    )
    entry = F.map_filter(entry, lambda k, v: ~((k == "Declared Date") & (F.col("o_orderkey") % 4 == 0)))
    responses = o.groupBy(
        F.concat(F.lit("C"), (F.col("o_custkey") % 40).cast("string"), F.lit(" CN Equity")).alias("ticker"),
        F.floor(F.col("o_orderkey") / PER_MESSAGE).alias("_m"),
    ).agg(F.collect_list(entry).alias("entries"))
    casts = {"Declared Date": "Date", "Dividend Amount": "Float64", "Record Date": "Date"}
    return vendor.bulk_rows(_landed(responses.drop("_m")), ["Declared Date", "Dividend Amount", "Frequency"], casts)


def q_universe(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part").select(F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")).alias("code"))
    return vendor.ticker_universe(p, "code", " CN Equity")


def q_field_text(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("p_partkey")
    raw = F.when(k % 3 == 0, F.concat(F.lit('  NAME = "'), F.col("p_name"), F.lit(' = x"\n')))
    raw = raw.when(k % 3 == 1, F.concat(F.lit('"'), F.col("p_name"), F.lit('"  '))).otherwise(F.col("p_name"))
    return table(spark, folder, "part").select("p_partkey", field_value(raw).alias("value"))


QUERIES = {
    "vendor_history_flatten": (q_history, HISTORY_SQL),
    "vendor_history_dates": (q_on_dates, ON_DATES_SQL),
    "vendor_reference_flatten": (
        q_reference,
        """SELECT 'C' || c_custkey AS "Ticker", c_name AS "NAME", CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS "SECTOR",
           c_acctbal AS "BALANCE", NULL::VARCHAR AS "NEVER" FROM customer""",
    ),
    "vendor_bulk_flatten": (
        q_bulk,
        """SELECT CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS "Declared Date",
           o_totalprice AS "Dividend Amount", o_orderpriority AS "Frequency", 'C' || o_custkey % 40 || ' CN Equity' AS ticker
           FROM orders""",
    ),
    "ticker_universe": (q_universe, "SELECT p_brand || ' CN Equity' AS ticker FROM part WHERE p_partkey % 4 <> 0"),
    "vendor_field_text": (
        q_field_text,
        "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || ' = x' ELSE p_name END AS value FROM part",
    ),
}
