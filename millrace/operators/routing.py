"""Which feed a file belongs to, what its rows carry along, how its load ended."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import FeedSpec
from millrace.functions.casts import DEFAULT_ZONE
from millrace.functions.text import stamped_name


def new_batch_id() -> str:
    return str(uuid4())


def route(df: DataFrame, feeds: Sequence[FeedSpec], name: str = "file_name") -> DataFrame:
    """Add ``feed`` (its position), ``bronze_table`` and ``load_type``; NULL where none matches.

    The rules are configuration, so the first match is a CASE expression:
    no join and no ranking.
    """
    at = F.lit(None).cast("int")
    for i in reversed(range(len(feeds))):
        at = F.when(F.col(name).rlike(f"(?i){feeds[i].pattern}"), F.lit(i)).otherwise(at)
    tables = F.array(*[F.lit(f.bronze_table) for f in feeds])
    loads = F.array(*[F.lit(f.load_type) for f in feeds])
    return df.withColumn("feed", at).withColumns(
        {"bronze_table": F.get(tables, F.col("feed")), "load_type": F.get(loads, F.col("feed"))}
    )


def add_audit(
    df: DataFrame, batch_id: str, ingested_at: datetime | Column, source_file: str | Column | None = None
) -> DataFrame:
    """Add ``ingested_at``, ``source_file`` and ``batch_id``. A scan's own ``source_file`` is kept."""
    at = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    extra = {"ingested_at": at, "batch_id": F.lit(batch_id)}
    if source_file is not None:
        extra["source_file"] = source_file if isinstance(source_file, Column) else F.lit(source_file)
    elif "source_file" not in df.columns:
        raise ValueError("rows carry no source_file and none was given")
    return df.withColumns(extra)


def delivered_name(name: Column, rename: Column, at: Column) -> Column:
    """File name as landed: stamped with the arrival time where the feed renames."""
    return F.when(rename, stamped_name(name, at)).otherwise(name)


def outcomes(
    files: DataFrame, batch_id: str, at: Column, zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Manifest of a run from ``file_name, feed, bronze_error, silver_error``.

    Unrouted files and bronze errors are ``failed``; a silver error does not
    change ``processed``.  Processed files go to a dated folder of the zone.
    """
    failed = F.col("feed").isNull() | F.col("bronze_error").isNotNull()
    error = F.when(F.col("feed").isNull(), "no feed matches the file name").otherwise(
        F.coalesce("bronze_error", "silver_error")
    )
    day = F.date_format(F.convert_timezone(None, F.lit(zone), at.cast("timestamp_ntz")), "yyyy/MMMM/dd")
    folder = F.when(failed, F.lit("failed")).otherwise(F.concat(F.lit("processed/"), day))
    return files.select(
        "file_name",
        F.lit(batch_id).alias("batch_id"),
        F.when(failed, "failed").otherwise("processed").alias("status"),
        error.alias("error"),
        F.concat_ws("/", folder, "file_name").alias("archive_path"),
    )
