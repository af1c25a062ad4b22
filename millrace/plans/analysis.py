"""Relations that an analyst draws from tables: filled keys, excluded values, code pieces, borrowed values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_fallback(df: DataFrame, name: str, first: str, *others: str, unless: tuple[str, object] | None = None) -> DataFrame:
    """``name`` in front: the first filled of several columns; NULL where a column is NULL or holds the value of ``unless``."""
    value = F.coalesce(first, *others)
    if unless:
        column, excluded = unless
        value = F.when(F.col(column) != F.lit(excluded), value)
    return df.select(value.alias(name), "*")


def distinct_where(df: DataFrame, columns: Sequence[str], equal: Mapping[str, object], excluded: Mapping[str, Sequence]) -> DataFrame:
    """Distinct rows of ``columns`` with the values of ``equal`` and none of those of ``excluded`` (NULL is never taken)."""
    kept = F.lit(True)
    for name, value in equal.items():
        kept = kept & (F.col(name) == F.lit(value))
    for name, values in excluded.items():
        kept = kept & ~F.col(name).isin(*values)
    return df.where(kept).select(*columns).distinct()


def distinct_pieces(df: DataFrame, **pieces: Column) -> DataFrame:
    """Distinct rows of named expressions, such as the code pieces of :mod:`millrace.functions.text`."""
    return df.select(*[c.alias(name) for name, c in pieces.items()]).distinct()


def borrow_missing(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct rows, with a missing ``value`` taken from every row of the same key that has one.

    Both sides are made distinct before they meet, and rows that have a value
    do not join at all, so no pairs are built that the result does not need.
    """
    rows = df.distinct()
    known = rows.where(F.col(value).isNotNull()).select(F.col(key).alias("_key"), F.col(value).alias("_value")).distinct()
    lacking = rows.where(F.col(value).isNull()).join(known, F.col(key) == F.col("_key"), "left")
    filled = lacking.select(*[F.col("_value").alias(value) if c == value else F.col(c) for c in df.columns])
    return rows.where(F.col(value).isNotNull()).unionByName(filled).distinct()
