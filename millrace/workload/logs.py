"""Message logs written from events, and business days over orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.calendar import business_day_offset, holiday_dates
from millrace.operators.logs import elapsed, parse_messages, type_messages
from millrace.session import workspace
from millrace.sources.textlog import scan_log
from millrace.workload.tables import table, text


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as log lines: updates, orders, other lines and blank ones."""
    k = F.col("event_id")
    stamp = F.date_format("ts", "yyyy-MM-dd hh:mm:ss.SSSSSS a")
    head = F.concat(stamp, F.lit(": INFO: app."), F.col("event_type"))
    clock = F.date_format("ts", "hh:mm a")
    amount = F.format_number(k * 7, 0)
    update = F.concat(head, F.lit(": Update : "), clock, F.lit(" : Port "), text("user_id"), F.lit(" : ABC.TO BUY "), amount, F.lit(" (u"), text("user_id"), F.lit(")"))
    order = F.concat(head, F.lit(": Order : "), clock, F.lit(" : NEW SELL "), amount, F.lit(" XY Z CN FILLED "), amount, F.lit(" @ "), text("value"), F.lit(" (u"), text("user_id"), F.lit(") tail"))
    line = F.when(k % 4 == 0, order).when(k % 7 == 0, F.concat(F.lit("note "), text("event_id"))).when(k % 9 == 0, F.lit("   ")).otherwise(F.concat(F.lit("  "), update))
    return table(spark, folder, "events").select(line.alias("value"))


def q_log(spark: SparkSession, folder: str) -> DataFrame:
    path = workspace(spark, "log")
    log_lines(spark, folder).write.text(path)
    typed = type_messages(parse_messages(scan_log(spark, path)))
    return typed.drop("source_file").withColumn("log_ts", F.date_format("log_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


LOG_SQL = """
    WITH e AS (
        SELECT *, CASE WHEN event_id % 4 = 0 THEN 'Order' WHEN event_id % 7 = 0 THEN 'UNKNOWN' WHEN event_id % 9 = 0 THEN '' ELSE 'Update' END AS kind
        FROM events
    ), s AS (
        SELECT *, kind <> 'UNKNOWN' AS known, kind = 'Order' AS is_order, kind = 'Update' AS is_update FROM e WHERE kind <> ''
    )
    SELECT kind AS msg_type, CASE WHEN known THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS log_ts,
           CASE WHEN known THEN 'INFO' END AS level, CASE WHEN known THEN 'app.' || event_type END AS source,
           CASE WHEN known THEN strftime(ts, '%H:%M:00') END AS trade_time,
           CASE WHEN is_update THEN CAST(user_id AS DOUBLE) END AS port,
           CASE WHEN is_update THEN 'ABC.TO' WHEN is_order THEN 'XY Z CN' END AS security,
           CASE WHEN is_update THEN 'BUY' END AS direction, CASE WHEN known THEN CAST(event_id * 7 AS DOUBLE) END AS quantity,
           CASE WHEN known THEN 'u' || user_id END AS "user", CASE WHEN is_order THEN 'NEW' END AS action,
           CASE WHEN is_order THEN 'SELL' END AS side, CASE WHEN is_order THEN CAST(event_id * 7 AS DOUBLE) END AS filled_qty,
           CASE WHEN is_order THEN value END AS price, CASE WHEN NOT known THEN 'note ' || event_id END AS raw
    FROM s
"""


def q_elapsed(spark: SparkSession, folder: str) -> DataFrame:
    """Per user and over the whole log; stamps are cut to ten minutes' grain on some rows, so they repeat."""
    e = table(spark, folder, "events").select(
        "event_id", "user_id",
        F.when(F.col("event_id") % 3 == 0, F.date_trunc("hour", "ts").cast("timestamp_ntz")).when(F.col("event_id") % 31 != 0, F.col("ts")).alias("ts"),
    )
    overall = elapsed(e, "ts", "event_id")
    return elapsed(overall, "ts", "event_id", ["user_id"], output="elapsed_user_s").drop("ts")


ELAPSED_SQL = """
    WITH e AS (
        SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('hour', ts) WHEN event_id % 31 <> 0 THEN ts END AS ts FROM events
    )
    SELECT event_id, user_id,
           (epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY ts NULLS LAST, event_id)) / 1e6 AS elapsed_s,
           (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id)) / 1e6 AS elapsed_user_s
    FROM e
"""


def q_business_days(spark: SparkSession, folder: str) -> DataFrame:
    """Holidays are the order dates that fall on a few days of the year, by region."""
    o = table(spark, folder, "orders").select(
        "o_orderkey", (F.col("o_orderdate") + F.expr("make_dt_interval(0, CAST(o_orderkey % 24 AS INT))")).alias("anchor"),
        (F.col("o_orderkey") % 23 - 11).cast("int").alias("days"),
    )
    day = F.date_format("o_orderdate", "MM-dd")
    holidays = table(spark, folder, "orders").select(
        F.explode(
            F.array_compact(F.array(
                F.when(day.isin("01-01", "07-01", "12-25"), "Ontario"),
                F.when(day.isin("01-01", "07-04", "11-27", "11-28"), "US"), F.when(day == "01-26", "AU"),
            ))
        ).alias("region"),
        F.to_date("o_orderdate").alias("date"),
    ).distinct()
    off = holiday_dates(holidays, ["US", "Nowhere"], [dt.date(1996, 12, 26), dt.date(1997, 12, 26)])
    return business_day_offset(o, "anchor", "days", off)


BUSINESS_SQL = """
    WITH o AS (
        SELECT o_orderkey, o_orderdate + to_hours(o_orderkey % 24) AS anchor, CAST(o_orderkey % 23 - 11 AS INTEGER) AS days FROM orders
    ), off AS (
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
        WHERE strftime(o_orderdate, '%m-%d') IN ('01-01', '07-01', '12-25', '07-04', '11-27', '11-28')
        UNION SELECT DATE '1996-12-26' UNION SELECT DATE '1997-12-26'
    ), cal AS (
        SELECT CAST(d AS DATE) AS d, isodow(d) < 6 AND CAST(d AS DATE) NOT IN (SELECT d FROM off) AS open
        FROM range((SELECT min(anchor) FROM o) - INTERVAL 90 DAY, (SELECT max(anchor) FROM o) + INTERVAL 90 DAY, INTERVAL 1 DAY) r(d)
    ), idx AS (
        SELECT d, open, CAST(sum(open::INT) OVER (ORDER BY d) AS BIGINT) AS before FROM cal
    )
    SELECT o_orderkey, anchor, days, g.d + (anchor - date_trunc('day', anchor)) AS offset_at
    FROM o JOIN idx s ON s.d = CAST(anchor AS DATE)
    JOIN idx g ON g.open AND g.before = days + CASE WHEN days > 0 OR s.open THEN s.before ELSE s.before + 1 END
"""

QUERIES = {
    "log_parse": (q_log, LOG_SQL),
    "log_elapsed": (q_elapsed, ELAPSED_SQL),
    "business_day_offset": (q_business_days, BUSINESS_SQL),
}
