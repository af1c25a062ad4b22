"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Documents of one Arrow batch.  Texts differ in length by five orders of
#: magnitude, so batches are cut by a low count; a worker holds one batch.  Spark
#: also cuts them by bytes (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB).
BATCH_ROWS = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few documents for the plans that follow in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def rows_of(batches: Iterator, *columns: str) -> Iterator[tuple]:
    """Rows of Arrow record batches as tuples of Python values."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def named(name: str) -> Column:
    """The column of exactly this name."""
    return F.col("`" + name.replace("`", "``") + "`")


def pack(docs: DataFrame, **own: Column) -> DataFrame:
    """``docs`` as one struct column ``doc`` beside an operator's own columns, so that no names can clash."""
    return docs.select(F.struct(*map(named, docs.columns)).alias("doc"), *[c.alias(name) for name, c in own.items()])


def unpack(packed: DataFrame, *more: Column) -> DataFrame:
    """The columns that ``pack`` put away, and ``more``."""
    return packed.select("doc.*", *more)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def find_spans(text: Column, pattern: str, group: int, least: int, quick: str) -> Column:
    """array<start, end, token> of all leftmost non-overlapping matches whose measured group is long enough.

    Positions count code points.  Texts without a match of ``quick`` are passed
    over; the rest are split at the matches, whose places follow from the
    lengths of the parts.
    """
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(whole)).alias("gap"), whole.alias("whole"), measured.alias("own"))
    none = F.array().cast("array<struct<start:int,end:int,token:string>>")
    zero = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(acc, m):
        start = acc["at"] + F.length(m["gap"])
        end = start + F.length(m["whole"])
        found = F.struct(start.alias("start"), end.alias("end"), m["own"].alias("token"))
        spans = F.when(F.length(m["own"]) >= least, F.array_append(acc["spans"], found)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.when(text.rlike(quick), F.aggregate(parts, zero, step, lambda acc: acc["spans"])).otherwise(none)
