"""Position roll-up: one row per key, first value of each column, summed amounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import before_dash


def position_rollup(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
    clean_keys: Sequence[str] = (),
) -> DataFrame:
    """Group by ``keys`` (rows with a NULL key are left out) in the input's column order.

    ``clean_keys`` are cut at the first dash before grouping.  Other columns
    take their first non-NULL value in the order of ``order``, an explicit
    column, since rows have no order of their own.  All aggregates combine on
    the map side.
    """
    cleaned = df.withColumns({k: before_dash(F.col(f"`{k}`")) for k in clean_keys})
    present = cleaned.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    others = [c for c in df.columns if c not in keys and c not in sums and c != order]
    firsts = [
        F.min_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col(order))).alias(c) for c in others
    ]
    totals = [F.sum(f"`{c}`").alias(c) for c in sums]
    grouped = present.groupBy(*[f"`{k}`" for k in keys]).agg(*totals, *firsts)
    return grouped.select(*[f"`{c}`" for c in df.columns if c != order])
