"""Routing, lineage and manifests over listings derived from documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.feeds import catalogue
from millrace.functions.text import stamped_name
from millrace.operators.routing import add_audit, outcomes, route
from millrace.sources.listing import list_files, unseen_files
from millrace.workload.scans import write_reports
from millrace.workload.tables import table, text

CLIENT = "Acme"
NAMES = (
    "All_Positions{n}.csv", "old_PLF_POSITIONS{n}.CSV.bak", "Acme_CIL_ALL.{n}.txt", "securities.csv",
    "my_securities.csv", "Acme_UCF_{n}", "Daily_Net_Asset_Values.csv", "Acme_2024-01-31.xlsx", "notes {n}.md",
)


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """One made-up delivery name per document."""
    number = F.lpad(text("doc_id"), 8, "0")
    name = F.lit(None).cast("string")
    for i, form in enumerate(NAMES):
        before, _, after = form.partition("{n}")
        filled = F.concat(F.lit(before), number, F.lit(after)) if "{n}" in form else F.lit(form)
        name = F.when(F.col("doc_id") % len(NAMES) == i, filled).otherwise(name)
    return table(spark, folder, "documents").select("doc_id", "source", name.alias("file_name"))


def _names_sql() -> str:
    cases = " ".join(
        f"WHEN {i} THEN " + "'" + form.replace("{n}", "' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '") + "'"
        for i, form in enumerate(NAMES)
    )
    return f"SELECT doc_id, source, CASE doc_id % {len(NAMES)} {cases} END AS file_name FROM documents"


def _routes_sql() -> str:
    rules = ", ".join(
        f"({i}, '{f.pattern}', '{f.bronze_table}', '{f.load_type}')" for i, f in enumerate(catalogue(CLIENT))
    )
    return f"""
        WITH n AS ({_names_sql()}), rules(feed, pattern, bronze_table, load_type) AS (VALUES {rules}),
        hit AS (
            SELECT doc_id, min(feed) AS feed FROM n JOIN rules ON regexp_matches(file_name, pattern, 'i') GROUP BY doc_id
        )
        SELECT n.doc_id, source, file_name, hit.feed, bronze_table, load_type
        FROM n LEFT JOIN hit USING (doc_id) LEFT JOIN rules ON rules.feed = hit.feed"""


def q_route(spark: SparkSession, folder: str) -> DataFrame:
    return route(listing(spark, folder), catalogue(CLIENT))


def q_discover(spark: SparkSession, folder: str) -> DataFrame:
    """Real files: an inbox written from orders, listed and counted."""
    inbox = write_reports(table(spark, folder, "orders"), "o_orderkey", text("o_orderkey"))
    found = list_files(spark, inbox, recursive=True)
    return found.select(
        F.regexp_extract("path", r"delivery=(\d+)", 1).cast("long").alias("delivery"), F.col("length").alias("bytes"),
        F.col("file_name").endswith(".txt").alias("is_text"),
    )


def q_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("doc_id")
    states = route(listing(spark, folder), catalogue(CLIENT)).withColumns(
        {
            "bronze_error": F.when(k % 10 == 0, F.lit("bad header")),
            "silver_error": F.when(k % 4 == 0, F.lit("clash")),
        }
    )
    day = F.timestamp_seconds(F.lit(1_704_067_200) + k * 86_400)  # midnight UTC: still the day before in the zone
    return outcomes(states, "run-1", day)


OUTCOMES_SQL = f"""
    SELECT file_name, 'run-1' AS batch_id, CASE WHEN failed THEN 'failed' ELSE 'processed' END AS status,
           CASE WHEN feed IS NULL THEN 'no feed matches the file name' WHEN doc_id % 10 = 0 THEN 'bad header'
                WHEN doc_id % 4 = 0 THEN 'clash' END AS error,
           CASE WHEN failed THEN 'failed' ELSE 'processed/' || strftime(
               (to_timestamp(1704067200 + doc_id * 86400) AT TIME ZONE 'America/New_York'), '%Y/%B/%d') END
             || '/' || file_name AS archive_path
    FROM (SELECT *, feed IS NULL OR doc_id % 10 = 0 AS failed FROM ({_routes_sql()}))
"""


def q_stamped(spark: SparkSession, folder: str) -> DataFrame:
    files = listing(spark, folder)
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id") * 61)
    return files.select("doc_id", stamped_name(F.col("file_name"), at).alias("stamped"))


STAMPED_SQL = f"""
    SELECT doc_id, regexp_extract(file_name, '^(.+?)(\\.[^.]*)?$', 1) || '_'
           || strftime(to_timestamp(1704067200 + doc_id * 61) AT TIME ZONE 'UTC', '%Y%m%d_%H%M')
           || regexp_extract(file_name, '^(.+?)(\\.[^.]*)?$', 2) AS stamped
    FROM ({_names_sql()})
"""


def q_new_files(spark: SparkSession, folder: str) -> DataFrame:
    remote = listing(spark, folder).withColumn("is_directory", F.col("doc_id") % 10 == 0)
    taken = table(spark, folder, "labels").join(listing(spark, folder), "doc_id").select("file_name")
    return unseen_files(remote, taken).drop("is_directory")


def q_audit(spark: SparkSession, folder: str) -> DataFrame:
    at = F.lit("2024-01-02 14:30:00").cast("timestamp")
    rows = table(spark, folder, "orders").withColumn("source_file", F.concat(F.lit("day_"), F.date_format("o_orderdate", "yyyyMMdd")))
    audited = add_audit(rows, "run-1", at)
    return audited.withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"))


QUERIES = {
    "route_files": (q_route, _routes_sql()),
    "discover_files": (
        q_discover,
        """SELECT o_orderkey // 5000 AS delivery, CAST(sum(length(CAST(o_orderkey AS VARCHAR)) + 1) AS BIGINT) AS bytes,
           true AS is_text FROM orders GROUP BY ALL""",
    ),
    "file_outcomes": (q_outcomes, OUTCOMES_SQL),
    "timestamped_name": (q_stamped, STAMPED_SQL),
    "new_files_anti_join": (
        q_new_files,
        f"""WITH n AS ({_names_sql()})
            SELECT file_name, doc_id, source FROM n WHERE doc_id % 10 <> 0 AND file_name NOT IN
              (SELECT file_name FROM n JOIN labels USING (doc_id))""",
    ),
    "audit_columns": (
        q_audit,
        """SELECT *, 'day_' || strftime(o_orderdate, '%Y%m%d') AS source_file, '2024-01-02 14:30:00' AS ingested_at,
           'run-1' AS batch_id FROM orders""",
    ),
}
