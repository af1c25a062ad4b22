"""Bronze writes: append or overwrite, with an evolving or a replaced schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import PARTITION, read_table, table_exists

MODES = ("append", "overwrite")


def write_bronze(
    df: DataFrame,
    path: str,
    mode: str = "append",
    *,
    merge_schema: bool = True,
    table_format: str = "parquet",
) -> None:
    """Write rows that carry the audit columns.

    ``append`` partitions by a copy of ``batch_id`` (the id itself stays in the
    files, as the text it is) and replaces only the partitions it writes: a retried batch takes its own place instead of doubling.  New
    columns need no rewrite, since reads merge the files' schemas.

    ``overwrite`` replaces the rows; columns of the old table that the new rows
    lack stay, as NULL, unless ``merge_schema`` is off.
    """
    if not isinstance(df, DataFrame):
        raise TypeError("df must be a Spark DataFrame")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if "batch_id" not in df.columns:
        raise ValueError("rows carry no batch_id; add the audit columns first")
    rows = df
    if mode == "overwrite" and merge_schema and table_exists(df.sparkSession, path, table_format):
        old = read_table(df.sparkSession, path, table_format=table_format).schema
        gone = {f.name: F.lit(None).cast(f.dataType) for f in old.fields if f.name not in df.columns}
        rows = df.withColumns(gone).select(
            *[f"`{f.name}`" for f in old.fields], *[f"`{c}`" for c in df.columns if c not in old.names]
        )
    rows = rows.withColumn("batch_id", F.col("batch_id").cast("string")).withColumn(PARTITION, F.col("batch_id"))
    writer = rows.write.format(table_format).partitionBy(PARTITION).mode("overwrite")
    if mode == "append":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.option("partitionOverwriteMode", "static")
    writer.save(path)
