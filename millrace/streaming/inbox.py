"""An inbox folder as a stream: the checkpoint remembers which files were taken."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from millrace.operators.cleaning import clean_and_cast
from millrace.sinks.bronze import write_bronze
from millrace.sinks.silver import SilverTable
from millrace.sources.delimited import CORRUPT, judge_long_rows



def stream_csv(
    spark: SparkSession,
    inbox: str,
    columns: Sequence[str],
    *,
    header: bool = True,
    files_per_batch: int | None = None,
    keep_corrupt: bool = False,
    long_rows: str = "error",
) -> DataFrame:
    """Delimited files of an inbox as a stream of text rows with ``source_file``.

    A row with more filled cells than the header fails the micro-batch, unless
    ``long_rows`` is ``"drop"``, ``"keep"`` (the named cells) or ``"mark"`` (in ``_error``).
    With ``keep_corrupt`` all rows come, and such rows' texts, for :func:`stream_outcomes`.
    """
    reader = (
        spark.readStream.schema(T.StructType([T.StructField(n, T.StringType()) for n in [*columns, CORRUPT]]))
        .option("header", header)
        .option("enforceSchema", False)  # a file with other or reordered columns fails instead of swapping values
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)  # else rows that are too long are not noticed
        .option("recursiveFileLookup", True)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(inbox).select("*", F.col("_metadata.file_name").alias("source_file"))
    return rows if keep_corrupt else judge_long_rows(rows, len(columns), long_rows).drop(CORRUPT)


def _run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process everything that has arrived, then stop."""
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _audited(rows: DataFrame, run: str, epoch: int) -> DataFrame:
    return rows.withColumns({"ingested_at": F.current_timestamp(), "batch_id": F.lit(f"{run}-{epoch}")})


def stream_bronze(stream: DataFrame, path: str, checkpoint: str, run: str) -> StreamingQuery:
    """Append micro-batches to a bronze table. A replayed batch replaces its own partition."""
    return _run(stream, checkpoint, lambda rows, epoch: write_bronze(_audited(rows, run, epoch), path))


def stream_silver(
    stream: DataFrame, table: SilverTable, checkpoint: str, run: str, policy: str = "on_change"
) -> StreamingQuery:
    """Clean and upsert each micro-batch. A replayed batch finds its commit and does nothing."""

    def each(rows: DataFrame, epoch: int) -> None:
        table.upsert(clean_and_cast(_audited(rows, run, epoch), table.spec, drop_exact=False), f"{run}-{epoch}", policy)

    return _run(stream, checkpoint, each)


def stream_outcomes(stream: DataFrame, path: str, checkpoint: str, run: str) -> StreamingQuery:
    """Manifest rows per file and micro-batch: rows read and rows that did not fit the schema.

    The stream must have been read with ``keep_corrupt``.
    """

    def each(rows: DataFrame, epoch: int) -> None:
        bad = F.count_if(F.col(CORRUPT).isNotNull())
        manifest = rows.groupBy(F.col("source_file").alias("file_name")).agg(
            F.count(F.lit(1)).alias("rows"), bad.alias("bad_rows")
        )
        status = F.when(F.col("bad_rows") < F.col("rows"), "processed").otherwise("failed")
        write_bronze(manifest.withColumns({"status": status, "batch_id": F.lit(f"{run}-{epoch}")}), path)

    return _run(stream, checkpoint, each)
