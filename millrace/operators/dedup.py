"""Duplicate removal. Each form pre-reduces on the map side, so a key that holds
most of the rows sends at most a few of them per task through the exchange:
``row_number() <= k`` becomes a per-partition top-k before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RANK = "_rank"


def exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def exact_with_count(df: DataFrame) -> DataFrame:
    """Distinct rows, each with the number of copies that were removed."""
    return df.groupBy(*df.columns).agg((F.count(F.lit(1)) - 1).alias("removed"))


def total_order(df: DataFrame, first: Sequence[Column], skip: Sequence[str]) -> list[Column]:
    """Extend an order by all further columns: reruns choose the same row."""
    return [*first, *[F.col(f"`{c}`").desc_nulls_last() for c in sorted(df.columns) if c not in skip]]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], timestamp: str, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """The row with the highest timestamp per key (NULL timestamps rank last)."""
    newest = F.col(f"`{timestamp}`").desc_nulls_last()
    if tie_break is None:
        order = total_order(df, [newest], [*keys, timestamp])
    else:
        order = [newest, *[F.col(c).desc_nulls_last() for c in tie_break]]
    ranked = df.withColumn(RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(RANK) == 1).drop(RANK)


def any_key(keys: Sequence[str]) -> Column:
    return F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull()


def key_pattern(keys: Sequence[str]) -> Column:
    """``full``, ``partial`` or ``none`` by how many key parts are present."""
    present = reduce(lambda a, b: a + b, [F.col(k).isNotNull().cast("int") for k in keys])
    return F.when(present == len(keys), "full").when(present > 0, "partial").otherwise("none")


def key_pattern_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts per null pattern of the key."""
    return df.groupBy(key_pattern(keys).alias("pattern"), *[F.col(k).isNull().alias(f"{k}_null") for k in keys]).agg(
        F.count(F.lit(1)).alias("rows")
    )


def latest_by_null_pattern(
    df: DataFrame, keys: Sequence[str], timestamp: str, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """As :func:`latest_per_key` for keys with missing parts.

    Rows compare on their present parts only, within the same null pattern;
    grouping treats NULL as equal to NULL, which is just that.  Rows without
    any key part are left out (:func:`key_pattern_profile` counts them).
    """
    return latest_per_key(df.where(any_key(keys)), keys, timestamp, tie_break)


def unique_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key, ``first`` or ``last`` in the given order; ``none`` drops repeated keys."""
    if keep not in ("first", "last", "none"):
        raise ValueError("keep must be 'first', 'last' or 'none'")
    by = [F.col(c).desc_nulls_last() if keep == "last" else F.col(c).asc_nulls_first() for c in order]
    window = Window.partitionBy(*keys)
    ranked = df.withColumn(RANK, F.row_number().over(window.orderBy(*by)))
    if keep != "none":
        return ranked.where(F.col(RANK) == 1).drop(RANK)
    two = ranked.where(F.col(RANK) <= 2).withColumn("_most", F.max(RANK).over(window))
    return two.where(F.col("_most") == 1).drop(RANK, "_most")


def union_evolving(*frames: DataFrame) -> DataFrame:
    """Union by name over the union of all columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
