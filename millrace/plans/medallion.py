"""Inbox to bronze to silver, feed by feed; every feed's files go through one job."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import FeedSpec
from millrace.operators.cleaning import clean_and_cast
from millrace.operators.routing import add_audit, delivered_name, new_batch_id, outcomes, route
from millrace.plans import reports
from millrace.session import stage
from millrace.sinks.bronze import write_bronze
from millrace.sinks.silver import SilverTable
from millrace.sources.delimited import ERROR, scan_by_name, scan_header_shift, scan_skip_rows
from millrace.sources.grid import fixed_grid, ragged_grid
from millrace.sources.listing import deliveries, list_files
from millrace.sources.tables import read_table, table_exists

log = logging.getLogger(__name__)

def _pcf(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    return reports.pcf_report(fixed_grid(spark, paths, reports.PCF_WIDTH, **options), staged=True)


def _ucf(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    return reports.ucf_report(fixed_grid(spark, paths, reports.UCF_WIDTH, **options), staged=True)


def _cil(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    return reports.cil_report(ragged_grid(spark, paths, **options))


# Scan options of a feed (``multiline=False`` for large files without quoted
# line breaks, ``width``, ``delimiter``) pass through.
PARSERS = {
    "csv": scan_by_name,
    "csv skip 1": lambda spark, paths, **options: scan_skip_rows(spark, paths, 1, **options),
    "csv shifted": scan_header_shift,
    "cil": _cil,
    "pcf": _pcf,
    "ucf": _ucf,
}

# Workbooks arrive as decoded grids: a parquet folder with source_file, row_no, cells.
GRID_PARSERS = {
    "sheet": lambda grid: reports.promote_header(reports.whole_file(grid), 0),
    "accounting_nav": reports.accounting_nav_report,
    "nbf": reports.nbf_report,
    "bmo": reports.bmo_report,
}


# Parsers that can mark faulty rows instead of failing on them.
MARKING = ("csv", "csv skip 1")


def parse(spark: SparkSession, feed: FeedSpec, paths: Sequence[str], **options) -> DataFrame:
    """Raw rows of all files of a feed; ``options`` of the scan go before the feed's own."""
    if callable(feed.parser):
        return feed.parser(spark, list(paths))
    if feed.parser in PARSERS:
        return PARSERS[feed.parser](spark, list(paths), lineage="path", **{**feed.options, **options})
    if feed.parser in GRID_PARSERS:
        return GRID_PARSERS[feed.parser](spark.read.parquet(*paths))
    raise ValueError(f"no parser {feed.parser!r} for {feed.bronze_table}")


@dataclass
class Lake:
    """Folders of a lake and the feeds that fill it."""

    spark: SparkSession
    root: str
    feeds: Sequence[FeedSpec]
    policy: str = "on_change"
    errors: dict[str, str] = field(default_factory=dict)

    def bronze_path(self, feed: FeedSpec) -> str:
        return f"{self.root}/bronze/{feed.bronze_table}"

    def silver_table(self, feed: FeedSpec) -> SilverTable:
        return SilverTable(self.spark, f"{self.root}/silver/{feed.silver.table}", feed.silver)

    def land(self, feed: FeedSpec, rows: DataFrame, batch_id: str, at: datetime) -> DataFrame:
        """Write raw rows to bronze; returns what was written."""
        name = F.regexp_extract("source_file", r"([^/]+)$", 1)
        named = rows.withColumn("source_file", delivered_name(name, F.lit(feed.rename), F.lit(at)))
        landed = add_audit(named, batch_id, at)
        write_bronze(landed, self.bronze_path(feed), feed.load_type)
        return read_table(self.spark, self.bronze_path(feed), schema=landed.schema, batch_id=batch_id)

    def land_files(
        self, feed: FeedSpec, paths: Sequence[str], batch_id: str, at: datetime
    ) -> tuple[DataFrame, DataFrame | None]:
        """Land the files of a feed; returns what was written, and (file, fault) of files left out.

        All files go through one job.  Only if that fails are the rows staged
        with their faults marked: files without a fault then land without the
        others.  A failure that no row explains, or all files have, is raised.
        """
        try:
            return self.land(feed, parse(self.spark, feed, paths), batch_id, at), None
        except Exception:
            if feed.parser not in MARKING or "long_rows" in feed.options:
                raise
            rows = stage(parse(self.spark, feed, paths, long_rows="mark"), "marked")
            faults = rows.where(F.col(ERROR).isNotNull()).groupBy("source_file").agg(F.min(ERROR).alias("fault"))
            faults = stage(faults, "faults")
            good = rows.drop(ERROR).join(faults, "source_file", "left_anti").select(*[f"`{c}`" for c in rows.columns if c != ERROR])
            if faults.isEmpty() or good.isEmpty():
                raise
            return self.land(feed, good, batch_id, at), faults

    def refine(self, feed: FeedSpec, rows: DataFrame, batch_id: str) -> bool:
        """Clean rows and upsert them into the feed's silver table."""
        return self.silver_table(feed).upsert(clean_and_cast(rows, feed.silver, drop_exact=False), batch_id, self.policy)

    def ingest(self, inbox: str, at: datetime, batch_id: str | None = None) -> DataFrame:
        """One run over an inbox. Returns the manifest of file outcomes.

        Feeds are independent: an error stops its own feed only, and a file with
        rows longer than its header fails without its feed's others.  Silver sees
        the new batch, not the whole bronze table; :meth:`replay` does that.
        Files that an earlier run has processed (same path and time) are left
        out; failed ones are tried again.
        """
        batch_id = batch_id or new_batch_id()
        taken = f"{self.root}/manifest"
        listing = deliveries(list_files(self.spark, inbox, recursive=True))
        if table_exists(self.spark, taken):
            seen = read_table(self.spark, taken).where("status = 'processed'").select("path", "modified_at").distinct()
            listing = listing.join(seen, ["path", "modified_at"], "left_anti")
        listing = stage(route(listing, self.feeds), "listing")
        bronze_errors: dict[int, str] = {}
        silver_errors: dict[int, str] = {}
        faults = self.spark.createDataFrame([], "source_file string, fault string")
        for row in listing.where("feed IS NOT NULL").select("feed").distinct().collect():
            feed = self.feeds[row["feed"]]
            try:
                landed, left_out = self.land_files(feed, self._paths(listing, row["feed"]), batch_id, at)
                faults = faults if left_out is None else faults.unionByName(left_out)
            except Exception as error:  # noqa: BLE001 - any failure is an outcome of the file
                log.exception("bronze failed for %s", feed.bronze_table)
                bronze_errors[row["feed"]] = str(error)
                continue
            if feed.silver is None:
                continue
            try:
                self.refine(feed, landed, batch_id)
            except Exception as error:  # noqa: BLE001
                log.exception("silver failed for %s", feed.silver.table)
                silver_errors[row["feed"]] = str(error)
        states = listing.join(faults.withColumnRenamed("source_file", "path"), "path", "left")
        states = states.withColumns(
            {"bronze_error": F.coalesce(_lookup(bronze_errors), F.col("fault")), "silver_error": _lookup(silver_errors)}
        )
        failed = F.col("feed").isNull() | F.col("bronze_error").isNotNull()
        status = F.when(failed, "failed").otherwise("processed").alias("status")
        write_bronze(states.select("path", "modified_at", "file_name", status, F.lit(batch_id).alias("batch_id")), taken)
        return outcomes(states, batch_id, F.lit(at))

    def replay(self, batch_id: str | None = None) -> dict[str, str]:
        """Upsert the latest row per key of every bronze table into silver; a failing table does not stop the others."""
        batch_id = batch_id or new_batch_id()
        result = {}
        for feed in self.feeds:
            if feed.silver is None:
                continue
            path = self.bronze_path(feed)
            try:
                if not table_exists(self.spark, path):
                    result[feed.silver.table] = "missing"
                    continue
                rows = silver_input(self.spark, feed, path)
                if rows.isEmpty():
                    result[feed.silver.table] = "empty"
                    continue
                self.refine(feed, rows, batch_id)
                result[feed.silver.table] = "done"
            except Exception as error:  # noqa: BLE001
                log.exception("replay failed for %s", feed.silver.table)
                result[feed.silver.table] = f"failed: {error}"
        return result

    def _paths(self, listing: DataFrame, feed: int) -> list[str]:
        """Paths of one feed: configuration-sized input to the reader, not data."""
        return [r["path"] for r in listing.where(F.col("feed") == feed).select("path").toLocalIterator()]


def silver_input(spark: SparkSession, feed: FeedSpec, bronze_path: str, latest_batch: str | None = None) -> DataFrame:
    """Bronze rows a silver run reads: everything, or one batch of an overwritten table."""
    rows = read_table(spark, bronze_path)
    if feed.load_type == "overwrite" and latest_batch is not None:
        return rows.where(F.col("batch_id") == latest_batch)
    return rows


def _lookup(errors: Mapping[int, str]):
    text = F.lit(None).cast("string")
    for feed, error in errors.items():
        text = F.when(F.col("feed") == feed, F.lit(error)).otherwise(text)
    return text


__all__ = ["GRID_PARSERS", "Lake", "PARSERS", "parse", "silver_input"]
