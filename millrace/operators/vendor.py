"""Landed vendor responses to flat tables.

A response row is ``ticker`` plus an array of entries; entries hold their
fields in a map, so fields may be absent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import compact_date, field_value
from millrace.operators.columns import cast_columns


def ticker_universe(df: DataFrame, ticker: str, suffix: str) -> DataFrame:
    """Non-NULL tickers with the vendor's suffix."""
    return df.where(F.col(ticker).isNotNull()).select(F.concat(F.col(ticker), F.lit(suffix)).alias("ticker"))


def request_dates(df: DataFrame, day: str) -> DataFrame:
    """Distinct dates as ``yyyyMMdd`` text."""
    return df.select(day).distinct().select(compact_date(F.col(day)).alias("request_date"))


def history_rows(responses: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``(ticker, entries array<struct<date, fields map<string,double>>>)`` to ``[Ticker, Date, fields…]``."""
    return responses.select(F.col("ticker").alias("Ticker"), F.explode("entries").alias("e")).select(
        "Ticker", F.col("e.date").alias("Date"), *[F.col("e.fields")[f].alias(f) for f in fields]
    )


def history_on_dates(history: DataFrame, tickers: DataFrame, dates: DataFrame) -> DataFrame:
    """History of some tickers on some dates (distinct key lists on both sides)."""
    return history.join(tickers.distinct(), "Ticker", "left_semi").join(dates.distinct(), "Date", "left_semi")


def reference_rows(responses: DataFrame, fields: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """``securities array<struct<ticker, fields map<string,string>>>`` to ``[Ticker, fields…]``.

    Field text is unwrapped; a mapping gives types, a plain list leaves text.
    """
    types = dict(fields) if isinstance(fields, Mapping) else {f: "string" for f in fields}
    flat = responses.select(F.explode("securities").alias("s"))

    def value(f: str) -> Column:
        text = field_value(F.col("s.fields")[f])
        return text if types[f] == "string" else text.try_cast(types[f])

    return flat.select(F.col("s.ticker").alias("Ticker"), *[value(f).alias(f) for f in types])


def bulk_elements(responses: DataFrame) -> list[str]:
    """Names of the elements that any entry carries (a vendor's field list, sorted)."""
    entries = responses.select(F.explode("entries").alias("e"))
    names = entries.select(F.explode(F.map_keys("e")).alias("name")).distinct()
    return sorted(r["name"] for r in names.collect())


def bulk_rows(
    responses: DataFrame, elements: Sequence[str] | None = None, cast_map: Mapping[str, str] | None = None
) -> DataFrame:
    """``(ticker, entries array<map<string,string>>)``: one text row per entry, plus its ticker.

    All tickers in one table; casts apply to the elements that are present.
    Without ``elements`` every element that occurs becomes a column, which
    takes a pass over the entries.
    """
    elements = bulk_elements(responses) if elements is None else elements
    flat = responses.select("ticker", F.explode("entries").alias("e")).select(
        *[F.col("e")[n].alias(n) for n in elements], "ticker"
    )
    return cast_columns(flat, cast_map or {})
