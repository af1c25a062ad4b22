"""Small table building blocks and their chain."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import plain_snake_case, require_unique, snake_case

# Type names accepted by cast_columns, and what they are here.
CAST_TYPES = {"Float64": "double", "Int64": "bigint", "Date": "date", "Utf8": "string", "Boolean": "boolean"}


def _renamed(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    names = [rule(c) for c in df.columns]
    require_unique(names)
    return df.toDF(*names)


def snake_case_columns(df: DataFrame) -> DataFrame:
    return _renamed(df, snake_case)


def normalize_column_names(df: DataFrame) -> DataFrame:
    return _renamed(df, plain_snake_case)


def cast_columns(df: DataFrame, cast_map: Mapping[str, str]) -> DataFrame:
    """Casts that give NULL instead of failing; columns the table lacks are skipped."""
    for name in cast_map.values():
        if name not in CAST_TYPES:
            raise ValueError(f"unknown type {name!r}; known: {', '.join(CAST_TYPES)}")
    return df.withColumns({c: F.col(f"`{c}`").try_cast(CAST_TYPES[t]) for c, t in cast_map.items() if c in df.columns})


def rename_columns(df: DataFrame, rename_map: Mapping[str, str]) -> DataFrame:
    """Strict: an unknown name raises (Spark alone would ignore it)."""
    validate_columns(df, list(rename_map))
    return df.withColumnsRenamed(dict(rename_map))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def validate_columns(df: DataFrame, required_columns: Sequence[str]) -> DataFrame:
    """Raise when columns are missing, else hand the table on."""
    missing = sorted(set(required_columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def filter_rows(df: DataFrame, filter_fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return df.transform(filter_fn)


def split_table(
    df: DataFrame, split_fn: Callable[[DataFrame], Mapping[str, DataFrame]]
) -> dict[str, DataFrame]:
    return dict(split_fn(df))


def apply_transformations(df: DataFrame, transformations: Sequence[tuple[Callable, Mapping]]):
    """Run ``(function, arguments)`` steps in order. A split gives a dict, so it comes last."""
    result = df
    for step, (fn, kwargs) in enumerate(transformations):
        if not isinstance(result, DataFrame):
            raise ValueError(f"step {step} follows a split; a split must be the last step")
        result = fn(result, **kwargs)
    return result
