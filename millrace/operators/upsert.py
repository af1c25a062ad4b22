"""Versioned upsert (SCD type 2) on null-safe keys.

Both sides hold each key at most once, so no join group can grow.  Every batch
meets the current rows in one full outer join that hashes both sides by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import AUDIT_COLUMNS, SilverSpec
from millrace.operators.dedup import latest_by_null_pattern

POLICIES = ("on_change", "insert_new", "always")
CURRENT = "is_current"


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def left_join_indicator(left: DataFrame, right: DataFrame, keys: Sequence[str], flag: str = "is_match") -> DataFrame:
    """Left join on NULL-matching keys against the distinct keys of ``right``."""
    known = right.select(*keys).distinct().withColumn(flag, F.lit(True))
    joined = left.join(known, same_key(left, known, keys), "left")
    return joined.select(*[left[c] for c in left.columns], F.coalesce(known[flag], F.lit(False)).alias(flag))


def initial_version(incoming: DataFrame, spec: SilverSpec) -> DataFrame:
    """First load: the latest row per key, all current."""
    return latest_by_null_pattern(incoming, spec.primary_keys, spec.dedup_timestamp).withColumn(CURRENT, F.lit(True))


def current_rows(table: DataFrame) -> DataFrame:
    return table.where(CURRENT)


def align_types(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast columns that the target table already has to its types; a value that does not fit becomes NULL.

    :func:`alignment_loss` counts such values.
    """
    known = {f.name: f.dataType for f in target.fields}
    return df.select(*[F.col(f"`{c}`").try_cast(known[c]).alias(c) if c in known else F.col(f"`{c}`") for c in df.columns])


def misfits(df: DataFrame, target: T.StructType) -> dict[str, Column]:
    """For every column that changes its type, how many values the target's type cannot hold."""
    own = {f.name: f.dataType for f in df.schema.fields}
    changed = [f for f in target.fields if f.name in own and own[f.name] != f.dataType]
    return {
        f.name: F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()) for f in changed
    }


def alignment_loss(df: DataFrame, target: T.StructType) -> DataFrame:
    """One row: per column that changes its type, the values that the target's type cannot hold."""
    return df.agg(*[c.alias(name) for name, c in misfits(df, target).items()] or [F.lit(0).alias("none")])


def _union_schema(a: T.StructType, b: T.StructType) -> list[T.StructField]:
    names = {f.name for f in a.fields}
    return [*a.fields, *[f for f in b.fields if f.name not in names]]


def _differs(e: Column, i: Column, columns: Sequence[str]) -> Column:
    if not columns:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [~e[c].eqNullSafe(i[c]) for c in columns])


def compare_versions(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    policy: str = "on_change",
    ignore: Sequence[str] = AUDIT_COLUMNS,
) -> DataFrame:
    """Pair current and incoming rows by key: ``(action, before, after)``.

    ``action`` is ``keep`` (no incoming row, or one the policy skips; the
    skipped ones have ``after`` set), ``insert`` or ``replace``.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    if CURRENT in incoming.columns:
        raise ValueError(f"incoming rows must not carry {CURRENT}")
    before = current.drop(CURRENT)
    after = align_types(incoming, before.schema)
    compared = [c for c in after.columns if c in before.columns and c not in keys and c not in ignore]
    added = [c for c in after.columns if c not in before.columns and c not in ignore]

    left = before.select(*_key_copies(keys, "_e"), F.struct("*").alias("before"))
    right = after.select(*_key_copies(keys, "_i"), F.struct("*").alias("after"))
    on = _copies_match(len(keys), "_e", "_i")
    pair = left.join(right, on, "full_outer")

    changed = _differs(F.col("before"), F.col("after"), compared)
    for c in added:
        changed = changed | F.col("after")[c].isNotNull()
    replaces = {"always": F.lit(True), "insert_new": F.lit(False), "on_change": changed}[policy]
    action = (
        F.when(F.col("before").isNull(), "insert")
        .when(F.col("after").isNull() | ~replaces, "keep")
        .otherwise("replace")
    )
    return pair.select(action.alias("action"), "before", "after")


def _key_copies(keys: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(f"`{k}`").alias(f"{prefix}{n}") for n, k in enumerate(keys)]


def _copies_match(n_keys: int, a: str, b: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}{n}").eqNullSafe(F.col(f"{b}{n}")) for n in range(n_keys)])


def versions(compared: DataFrame) -> DataFrame:
    """Expand compared pairs to table rows with ``is_current``; a replaced row gives two."""
    before = compared.schema["before"].dataType
    after = compared.schema["after"].dataType
    fields = _union_schema(before, after)

    def row(side: str, schema: T.StructType, is_current: bool) -> Column:
        have = set(schema.names)
        return F.struct(
            *[
                (F.col(side)[f.name] if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in fields
            ],
            F.lit(is_current).alias(CURRENT),
        )

    old, new = row("before", before, True), row("after", after, True)
    closed = row("before", before, False)
    rows = (
        F.when(F.col("action") == "keep", F.array(old))
        .when(F.col("action") == "insert", F.array(new))
        .otherwise(F.array(closed, new))
    )
    return compared.select(F.inline(rows))


def outcome_counts() -> list[Column]:
    """Of compared pairs: incoming keys that were inserted, that replaced a row, that were skipped."""
    return [
        F.count_if(F.col("action") == "insert").alias("inserted"),
        F.count_if(F.col("action") == "replace").alias("replaced"),
        F.count_if((F.col("action") == "keep") & F.col("after").isNotNull()).alias("skipped"),
    ]


def upsert_stats(compared: DataFrame) -> DataFrame:
    """One row of :func:`outcome_counts`."""
    return compared.agg(*outcome_counts())


def upsert(
    existing: DataFrame, incoming: DataFrame, spec: SilverSpec, policy: str = "on_change"
) -> DataFrame:
    """The whole table after an upsert. Closed rows pass through untouched.

    Writing is up to :class:`millrace.sinks.silver.SilverTable`, which stores
    closed rows apart so that they are not rewritten.
    """
    fresh = latest_by_null_pattern(incoming, spec.primary_keys, spec.dedup_timestamp)
    compared = compare_versions(existing.where(CURRENT), fresh, spec.primary_keys, policy)
    return versions(compared).unionByName(existing.where(~F.col(CURRENT)), allowMissingColumns=True)
