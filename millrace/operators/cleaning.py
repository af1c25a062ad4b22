"""Rename, type and trim a raw table by its silver spec; report what casting lost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.config import ColumnMap, SilverSpec
from millrace.functions import casts
from millrace.functions.names import require_unique, snake_case

UNTOUCHED = ("ingested_at",)
SAMPLES = 5


def _columns_of(spec: SilverSpec | Mapping[str, ColumnMap]) -> Mapping[str, ColumnMap]:
    return spec.columns if isinstance(spec, SilverSpec) else spec


def _plan(df: DataFrame, columns: Mapping[str, ColumnMap]) -> list[tuple[T.StructField, str, ColumnMap | None]]:
    """(source field, target name, mapping or None) per column, checked before any work."""
    for source, m in columns.items():
        if m.dtype not in casts.CONVERTERS:
            raise ValueError(f"column {source!r}: unknown type {m.dtype!r}")
    planned = []
    for f in df.schema.fields:
        m = columns.get(f.name)
        planned.append((f, m.target if m else snake_case(f.name), m))
    require_unique(target for _, target, _ in planned)
    return planned


def _is_text(f: T.StructField, target: str, m: ColumnMap | None) -> bool:
    """Whether the column goes through text (else it is taken as it is)."""
    return target not in UNTOUCHED if m is None else not casts.passes(m.dtype, f.dataType)


def _with_tidy(df: DataFrame, planned: list) -> DataFrame:
    """Add each text column tidied, as ``_tidy{n}``: a projection of its own, so
    that conversions which look at their input more than once tidy it once."""
    return df.withColumns(
        {f"_tidy{n}": casts.tidy(F.col(f"`{f.name}`")) for n, (f, t, m) in enumerate(planned) if _is_text(f, t, m)}
    )


def _typed(n: int, f: T.StructField, target: str, m: ColumnMap | None) -> Column:
    c = F.col(f"_tidy{n}") if _is_text(f, target, m) else F.col(f"`{f.name}`")
    return c if m is None else casts.CONVERTERS[m.dtype](c, f.dataType, m, tidied=_is_text(f, target, m))


def clean_and_cast(
    df: DataFrame, spec: SilverSpec | Mapping[str, ColumnMap], *, drop_exact: bool = True
) -> DataFrame:
    """Exact duplicates out, mapped columns renamed and cast, the rest snake-cased text.

    Mapped columns that the input lacks are skipped.  Apart from the duplicate
    removal this is projections only.
    """
    planned = _plan(df, _columns_of(spec))
    rows = _with_tidy(df.dropDuplicates() if drop_exact else df, planned)
    return rows.select(*[_typed(n, *p).alias(p[1]) for n, p in enumerate(planned)])


def cast_loss(df: DataFrame, spec: SilverSpec | Mapping[str, ColumnMap], samples: int = SAMPLES) -> DataFrame:
    """Per mapped column: how many values the cast nulled, how many of them were
    empty text, and the smallest few distinct lost values.

    Only columns with a loss are listed.  Lost cells are counted per (column,
    value) before any exchange, so neither a column nor one frequent bad value
    gathers its rows in a task; the samples come from a per-column top-n that
    Spark limits on the map side.
    """
    planned = [p for p in _plan(df, _columns_of(spec)) if p[2] is not None]
    if not planned:
        raise ValueError("no mapped column is present")
    cells = []
    for n, (f, target, m) in enumerate(planned):
        raw = F.col(f"`{f.name}`")
        lost = raw.isNotNull() & _typed(n, f, target, m).isNull()
        cells.append(F.when(lost, F.struct(F.lit(target).alias("column"), raw.cast("string").alias("value"))))
    # Exploded whole and filtered after: a filter on the array would take the casts out of generated code.
    cell = F.explode(F.array(*cells)).alias("cell")
    lost = _with_tidy(df, planned).select(cell).where(F.col("cell").isNotNull()).select("cell.*")
    counted = lost.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counted.groupBy("column").agg(
        F.sum("n").alias("lost"),
        F.sum(F.when(casts.tidy(F.col("value")).isNull(), F.col("n")).otherwise(0)).alias("empty"),
    )
    ranked = counted.withColumn("_rank", F.row_number().over(Window.partitionBy("column").orderBy("value")))
    few = (
        ranked.where(F.col("_rank") <= samples)
        .groupBy("column")
        .agg(F.sort_array(F.collect_list(F.struct("value", "n"))).alias("few"))
    )
    samples_only = F.transform("few", lambda s: s["value"]).alias("samples")
    return totals.join(few, "column").select("column", "lost", "empty", samples_only)


def _presentable(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Tidy text without null words. Two projections, as each step reads its input more than once."""
    tidied = df.withColumns({n: casts.tidy(F.col(f"`{n}`")) for n in columns})
    return tidied.withColumns({n: casts.null_words(F.col(f"`{n}`")) for n in columns})


def infer_types(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    date_layouts: Sequence[str] = ("yyyyMMdd", "yyyy-M-d"),
) -> dict[str, str]:
    """Choose datetime, int, float or str per text column: the first type every
    non-missing value fits. One aggregate job over the input.

    Whole numbers that are also valid ``yyyyMMdd`` dates count as dates, as a
    column is a date column only if *all* its values are.
    """
    names = list(columns) if columns is not None else df.columns
    checks = []
    for i, n in enumerate(names):
        text, figure = F.col(f"`{n}`"), F.col(f"_figure{i}")
        present = text.isNotNull()
        checks += [
            F.count(text).alias(f"n{i}"),
            F.count_if(present & casts.mixed_date(text, date_layouts).isNull()).alias(f"d{i}"),
            F.count_if(present & (figure.isNull() | (figure != F.rint(figure)))).alias(f"i{i}"),
            F.count_if(present & figure.isNull()).alias(f"f{i}"),
        ]
    texts = _presentable(df.select(*[f"`{n}`" for n in names]), names)
    figures = {f"_figure{i}": casts.currency_number(F.col(f"`{n}`")) for i, n in enumerate(names)}
    misfits = texts.withColumns(figures).agg(*checks).first()
    chosen = {}
    for i, n in enumerate(names):
        fits = [t for t, k in (("datetime", "d"), ("int", "i"), ("float", "f")) if misfits[f"{k}{i}"] == 0]
        chosen[n] = fits[0] if fits and misfits[f"n{i}"] > 0 else "str"
    return chosen


def clean_by_type(
    df: DataFrame,
    types: Mapping[str, str],
    date_layouts: Sequence[str] = ("yyyyMMdd", "yyyy-M-d"),
) -> DataFrame:
    """Cast text columns to chosen types, with null words, currency signs and mixed dates."""

    def typed(n: str) -> Column:
        text = F.col(f"`{n}`")
        kind = types.get(n, "str")
        if kind == "datetime":
            return casts.mixed_date(text, date_layouts)
        if kind == "int":
            return F.rint(casts.currency_number(text)).try_cast("long")
        return casts.currency_number(text) if kind == "float" else text

    return _presentable(df, df.columns).select(*[typed(n).alias(n) for n in df.columns])


def clean_inferred(df: DataFrame, declared: Mapping[str, str] | None = None) -> DataFrame:
    """Schema-less cleaning: declared types first, the others inferred from the values."""
    declared = dict(declared or {})
    rest = [n for n in df.columns if n not in declared]
    return clean_by_type(df, {**declared, **(infer_types(df, rest) if rest else {})})
