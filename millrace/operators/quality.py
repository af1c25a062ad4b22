"""Row identity, validity and key linking, as the data conventions describe them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(df: DataFrame, columns: Sequence[str] | None = None, output: str = "_derived_hash_id") -> DataFrame:
    """SHA-256 over the columns; NULL and empty text hash differently."""
    parts = [
        F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in (columns or df.columns)
    ]
    return df.withColumn(output, F.sha2(F.concat_ws("\u001f", *parts), 256))


def flag_validity(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``rules`` map a reason to a condition that must hold (NULL counts as broken)."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in rules.items()])
    )
    return df.withColumn("_error_reason", F.nullif(F.array_join(broken, "; "), F.lit(""))).withColumn(
        "_is_valid", F.col("_error_reason").isNull()
    )


def quarantine(flagged: DataFrame) -> dict[str, DataFrame]:
    return {"valid": flagged.where("_is_valid"), "quarantine": flagged.where("NOT _is_valid")}


def link_reference(df: DataFrame, reference: DataFrame, on: Mapping[str, str], take: Sequence[str]) -> DataFrame:
    """Left join to a reference table with unique keys; rows without a partner stay."""
    keys = list(on.items())
    side = reference.select(*[F.col(r).alias(f"_r{n}") for n, (_, r) in enumerate(keys)], *take)
    cond = [F.col(left) == F.col(f"_r{n}") for n, (left, _) in enumerate(keys)]
    return df.join(side, cond, "left").drop(*[f"_r{n}" for n in range(len(keys))])
