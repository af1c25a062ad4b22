"""Grid scans: header-less cells with a dense row number per file.

A grid is ``(source_file, row_no, cells)``; rows count from 0, every ``cells``
array has the full width, missing cells are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.session import stage

GRID = ["source_file", "row_no", "cells"]

# Rows per part of a file in every two-level step; bounds one task's group.
CHUNK_ROWS = 50_000


def _plain(path: Column) -> Column:
    """A path as listings have it: Spark's file metadata are url-encoded (``+`` is not)."""
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def file_label(lineage: str = "name") -> Column:
    if lineage == "name":
        return _plain(F.col("_metadata.file_name"))
    if lineage == "path":
        return _plain(F.col("_metadata.file_path"))
    raise ValueError("lineage must be 'name' or 'path'")


def _scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    width: int,
    delimiter: str,
    multiline: bool,
    lineage: str,
) -> DataFrame:
    # One spare column past the width: Spark cuts longer rows silently, so
    # without it a row that does not fit could not be told from one that does.
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width + 1)])
    # The default null and empty marks make both empty and quoted empty cells NULL.
    raw = (
        spark.read.schema(schema)
        .option("header", False)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("recursiveFileLookup", True)
        .csv(paths)
    )
    return raw.select(
        file_label(lineage).alias("source_file"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_order"),
        F.array(*[F.col(f"c{i}") for i in range(width)]).alias("cells"),
        F.col(f"c{width}").alias("_spare"),
    )


def data_width(spark: SparkSession, paths: str | Sequence[str], delimiter: str = ",") -> int:
    """Cells that a row of the files can have, from one aggregate over their lines.

    A record that goes on over several lines has the delimiters of them all;
    where quotes are left open at a line's end, twice the cells are allowed for.
    A longer row still shows in the spare column.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(paths)
    found = lambda mark: F.length("value") - F.length(F.replace("value", F.lit(mark), F.lit("")))
    row = lines.agg(F.max(found(delimiter)).alias("most"), F.max(found('"') % 2).alias("open")).first()
    return (row.most or 0) * (2 if row.open else 1) + 1


def _number_rows(raw: DataFrame) -> DataFrame:
    """Dense row numbers without any order of the rows.

    The rows are written once, with the scan's running number: those of one
    split (a multi-line file is a single one) follow each other in it.  A row's
    place is that number, less its split's first, plus the row counts of the
    file's earlier splits, which come from one record per split.  Written rows
    keep their splits and numbers, which a second scan need not give again.
    """
    rows = stage(raw, "rows")
    before = Window.partitionBy("_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy("_path", "_split").agg(F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_n"))
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    shifts = stage(splits.select("_path", "_split", shift.alias("_shift")), "splits")
    return rows.join(shifts, ["_path", "_split"]).withColumn("row_no", F.col("_order") + F.col("_shift"))


def fixed_grid(
    spark: SparkSession,
    paths: str | Sequence[str],
    width: int | None = None,
    *,
    delimiter: str = ",",
    multiline: bool = True,
    lineage: str = "name",
    long_rows: str = "error",
    header_row: int = 0,
) -> DataFrame:
    """Grid of a stated width, or of what the files need. Blank lines vanish, short rows are padded.

    ``multiline`` (the default) honours line breaks inside quotes and reads one
    file per task, which suits many small reports; ``multiline=False`` splits
    large files.  ``long_rows`` is ``"error"``, ``"drop"`` or ``"keep"``: what
    lies past the width is then one more cell, which the header row must not
    have.  The files are parsed once, when the grid is made.
    """
    if long_rows not in ("error", "drop", "keep"):
        raise ValueError("long_rows must be 'error', 'drop' or 'keep'")
    width = data_width(spark, paths, delimiter) if width is None else width
    grid = _number_rows(_scan(spark, paths, width, delimiter, multiline, lineage))
    if long_rows == "drop":
        grid = grid.where(F.col("_spare").isNull())
    else:
        message = F.concat(F.lit(f"row wider than {width} cells in "), F.col("source_file"))
        cells = F.when(F.col("_spare").isNull(), F.col("cells"))
        if long_rows == "keep":
            cells = cells.when(F.col("row_no") != header_row, F.array_append("cells", F.col("_spare")))
        grid = grid.withColumn("cells", cells.otherwise(F.raise_error(message)))
    return grid.select(*GRID)


def ragged_grid(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    max_width: int | None = None,
    delimiter: str = ",",
    multiline: bool = True,
    lineage: str = "name",
) -> DataFrame:
    """Grid of rows of any length, or up to ``max_width`` (wider raises, nothing is cut).

    An empty cell followed by a filled one stays ``""``; past the last filled
    cell everything is NULL.
    """
    grid = fixed_grid(spark, paths, max_width, delimiter=delimiter, multiline=multiline, lineage=lineage)
    last = F.size("cells") - F.coalesce(
        F.array_position(F.transform(F.reverse("cells"), lambda c: c.isNotNull()), True) - 1, F.size("cells")
    )
    filled = F.transform("cells", lambda c, i: F.when(i < last, F.coalesce(c, F.lit(""))))
    return grid.withColumn("cells", filled)


def grid_from(df: DataFrame, source_file: str, row_no: str, cells: Sequence[str]) -> DataFrame:
    """View an already decoded sheet (one column per cell) as a grid."""
    return df.select(
        F.col(source_file).alias("source_file"),
        F.col(row_no).cast("long").alias("row_no"),
        F.array(*[F.col(c).cast("string") for c in cells]).alias("cells"),
    )
