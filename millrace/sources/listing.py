"""File discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Files of an inbox as rows; the contents are not read (the column is pruned)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", recursive)
        .load(folder)
        .select(
            F.col("path"),
            F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
            F.col("length"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def deliveries(files: DataFrame, folder: str = r"(?i)\.xls[xmb]?$") -> DataFrame:
    """Listed files, where those inside a folder named like a workbook (a decoded grid) become that one folder."""
    parent = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    inside = parent.rlike(folder)
    named = files.withColumns(
        {
            "file_name": F.when(inside, parent).otherwise(F.col("file_name")),
            "path": F.when(inside, F.regexp_replace("path", r"/[^/]+$", "")).otherwise(F.col("path")),
        }
    )
    return named.groupBy("path", "file_name").agg(F.sum("length").alias("length"), F.max("modified_at").alias("modified_at"))


def unseen_files(listing: DataFrame, manifest: DataFrame, key: str = "file_name") -> DataFrame:
    """Entries of a remote listing that no earlier run has taken; folders are left out."""
    files = listing.where(~F.col("is_directory")) if "is_directory" in listing.columns else listing
    return files.join(manifest.select(key).distinct(), key, "left_anti")
