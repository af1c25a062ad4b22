"""Delimited files with a header row. Everything lands as text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.blocks import expand_header, promote_header, whole_file
from millrace.sources.grid import GRID, file_label, fixed_grid

ROW_LABEL = "__index_level_0__"
#: Column that names the fault of a marked row.
ERROR = "_error"
#: Where Spark puts the text of a record that has another number of cells than the header.
CORRUPT = "_corrupt_record"
LONG_ROWS = ("error", "drop", "keep", "mark")


def scan_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    delimiter: str = ",",
    multiline: bool = False,
    lineage: str = "name",
    long_rows: str = "error",
) -> DataFrame:
    """Files that share one header. Only empty cells are NULL: ``N/A`` stays text.

    Every file's header is checked against the expected one, so a file with
    other or reordered columns fails the job; such sets go through
    :func:`scan_by_name`.  ``long_rows`` is as there.  All columns are parsed,
    whichever are asked for: a row that is too long could not be told otherwise.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("recursiveFileLookup", True)
    )
    names = list(columns) if columns else reader.csv(paths).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    whole = reader.option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    raw = whole.schema(schema).csv(paths).withColumn("source_file", file_label(lineage))
    return judge_long_rows(raw, len(names), long_rows, delimiter).drop(CORRUPT)


def judge_long_rows(rows: DataFrame, width: int, long_rows: str, delimiter: str = ",") -> DataFrame:
    """Treat records with more than ``width`` filled cells, by their text in ``_corrupt_record``, as ``long_rows`` says.

    ``rows`` has ``source_file``; ``"mark"`` adds ``_error``.
    """
    if long_rows not in LONG_ROWS:
        raise ValueError(f"long_rows must be one of {LONG_ROWS}")
    if long_rows == "keep":
        return rows
    cut = re.escape(delimiter)
    # Spark keeps the text of records that are too short, too; quoted cells count as one sign each.
    cells = F.regexp_replace(F.regexp_replace(CORRUPT, '"([^"]|"")*"', '"'), f"({cut}|\\s)+$", "")
    # Spark reads no plan that uses this column alone, hence the last term, which is never true.
    other = F.coalesce(F.length(F.col(f"`{rows.columns[0]}`")), F.lit(0)) < 0
    fits = F.col(CORRUPT).isNull() | (F.size(F.split(cells, cut)) <= width) | other
    message = F.concat(F.lit("row longer than its header in "), F.col("source_file"))
    if long_rows == "mark":
        return rows.withColumn(ERROR, F.when(~fits, message))
    return rows.where(fits if long_rows == "drop" else F.when(fits, True).otherwise(F.raise_error(message).cast("boolean")))


def scan_by_name(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    width: int | None = None,
    header_row: int = 0,
    long_rows: str = "error",
    **grid_options,
) -> DataFrame:
    """Files whose headers differ: each file's own header names its cells.

    A row with more filled cells than its header fails the job; ``long_rows``
    may say ``"drop"`` (the row), ``"keep"`` (the named cells) or ``"mark"``
    (all rows stay, with the fault of such a row in ``_error``) instead.
    """
    if long_rows not in LONG_ROWS:
        raise ValueError(f"long_rows must be one of {LONG_ROWS}")
    grid = whole_file(_with_field_count(fixed_grid(spark, paths, width, long_rows="keep", header_row=header_row, **grid_options)))
    fits = F.col("_fields") <= F.col("header_size")
    message = F.concat(F.lit("row longer than its header in "), F.col("source_file"))
    if long_rows == "mark":
        rows = promote_header(grid, header_row, columns=columns, keep=("source_file", "_fields", "header_size"))
        return rows.withColumn(ERROR, F.when(~fits, message)).drop("_fields", "header_size")
    if long_rows == "error":
        fits = F.when(fits, True).otherwise(F.raise_error(message).cast("boolean"))
    return promote_header(grid, header_row, columns=columns, row_filter=None if long_rows == "keep" else fits)


def scan_skip_rows(
    spark: SparkSession, paths: str | Sequence[str], skip: int, columns: Sequence[str] | None = None, **options
) -> DataFrame:
    """Leave out ``skip`` leading rows; the next row is the header."""
    return scan_by_name(spark, paths, columns, header_row=skip, **options)


def _with_field_count(grid: DataFrame) -> DataFrame:
    """Number of cells up to the last filled one."""
    trailing = F.array_position(F.transform(F.reverse("cells"), lambda c: c.isNotNull()), True)
    return grid.withColumn(
        "_fields", F.when(trailing > 0, F.size("cells") - trailing + 1).otherwise(0)
    )


def scan_skip_bad_rows(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    width: int | None = None,
    **options,
) -> DataFrame:
    """Rows with more fields than the header are dropped; short rows are padded."""
    grid = whole_file(_with_field_count(fixed_grid(spark, paths, width, long_rows="keep", **options)))
    return promote_header(grid, 0, columns=columns, row_filter=F.col("_fields") <= F.col("header_size"))


def scan_header_shift(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    label: str = ROW_LABEL,
    width: int | None = None,
    **options,
) -> DataFrame:
    """Data one field longer than the header: field 0 is a row label.

    As the files are read, every later field then moves under the name to its
    left, and the label keeps its own name.  The shift is decided per file by
    its first data row; further rows that are too long are dropped.
    """
    grid = whole_file(_with_field_count(fixed_grid(spark, paths, width, long_rows="keep", **options)))
    lookup = expand_header(grid, 0, shift_label=label)
    return promote_header(
        grid, 0, columns=columns, lookup=lookup, row_filter=F.col("_fields") <= F.col("header_size")
    )


__all__ = ["GRID", "scan_by_name", "scan_delimited", "scan_header_shift", "scan_skip_bad_rows", "scan_skip_rows"]
