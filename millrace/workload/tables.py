"""Reading the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(name: str):
    return F.col(name).cast("string")


def every(n: int, *names: str):
    """Rows whose key columns add up to a multiple of ``n``: marks rows to spoil."""
    total = F.col(names[0])
    for other in names[1:]:
        total = total + F.col(other)
    return total % n == 0
