"""Text log scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.casts import strip
from millrace.sources.grid import file_label


def scan_log(spark: SparkSession, paths: str | Sequence[str], lineage: str = "name") -> DataFrame:
    """Stripped, non-blank lines with their file: ``(source_file, line)``."""
    lines = spark.read.option("recursiveFileLookup", True).text(paths)
    return lines.select(file_label(lineage).alias("source_file"), strip(F.col("value")).alias("line")).where(
        F.col("line") != ""
    )
