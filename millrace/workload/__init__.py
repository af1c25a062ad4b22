"""Every operator run over the given tables, next to the SQL that states its result.

Each family module has ``QUERIES``: name to ``(query, oracle SQL or None)``.
A query takes ``(spark, folder)`` and returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, tuple[Query, str | None]]:
    from millrace.workload import (
        bronze,
        cleaning,
        dedup,
        files,
        grids,
        logs,
        quality,
        scans,
        sql,
        streams,
        transforms,
        upserts,
        vendor,
    )

    families = (
        cleaning, transforms, dedup, upserts, grids, scans, files, bronze, sql, logs, vendor, quality, streams,
    )
    merged: dict[str, tuple[Query, str | None]] = {}
    for family in families:
        for name, entry in family.QUERIES.items():
            if name in merged:
                raise ValueError(f"query {name} is defined twice")
            merged[name] = entry
    return merged
