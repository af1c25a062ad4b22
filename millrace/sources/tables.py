"""Lakehouse table reads."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Partition column of bronze tables: a copy of the batch id, whose type a reader may guess.
PARTITION = "part_batch"


def read_table(
    spark: SparkSession,
    path: str,
    *,
    table_format: str = "parquet",
    schema: T.StructType | None = None,
    merge_schema: bool = True,
    batch_id: str | None = None,
) -> DataFrame:
    """Read a table folder with the union of all its files' columns.

    Merging looks at every footer; pass ``schema`` to skip that on huge tables.
    ``batch_id`` reads one batch of a bronze table, and only its partition.
    """
    reader = spark.read.format(table_format)
    if schema is not None:
        parts = [] if batch_id is None else [T.StructField(PARTITION, T.StringType())]
        df = reader.schema(T.StructType([*schema.fields, *parts])).load(path)
    else:
        df = reader.option("mergeSchema", merge_schema).load(path)
    if batch_id is not None:
        df = df.where((F.col(PARTITION).cast("string") == batch_id) if schema is not None else (F.col("batch_id") == batch_id))
    return df.drop(PARTITION)


def table_exists(spark: SparkSession, path: str, table_format: str = "parquet") -> bool:
    """Whether a readable, non-empty table folder is there."""
    try:
        return len(spark.read.format(table_format).load(path).columns) > 0
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def register_view(spark: SparkSession, name: str, df_or_path: DataFrame | str, **options) -> None:
    """Make a table path (or frame) a SQL relation."""
    df = read_table(spark, df_or_path, **options) if isinstance(df_or_path, str) else df_or_path
    df.createOrReplaceTempView(name)
