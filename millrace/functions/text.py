"""Text pieces used by the analysis queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.casts import strip


def split_part(c: Column, separator: str, n: int) -> Column:
    """The n-th part (from 1); NULL past the end."""
    return F.try_element_at(F.split(c, f"\\Q{separator}\\E"), F.lit(n))


def before_dash(c: Column) -> Column:
    """``123 - PB`` -> ``123``."""
    return strip(F.substring_index(c, "-", 1))


def compact_date(c: Column) -> Column:
    """``2024-01-31`` -> ``20240131``."""
    return F.replace(c.cast("string"), F.lit("-"), F.lit(""))


def fund_code(ticker: Column) -> Column:
    """Drop leading quotes, write the share class with a slash."""
    return F.replace(F.ltrim(ticker, F.lit("'")), F.lit("."), F.lit("/"))


def long_code_class(long_code: Column) -> Column:
    """Fifth character of a long code, present only past six characters."""
    return F.when(F.length(long_code) > 6, F.substring(long_code, 5, 1))


def field_value(c: Column) -> Column:
    """``NAME = "value"`` -> ``value``; text without ``=`` only loses blanks and quotes."""
    text = strip(c)
    after = F.when(text.contains("="), F.regexp_extract(text, r"(?s)^[^=]*=(.*)$", 1)).otherwise(text)
    return strip(F.trim(strip(after), F.lit('"')))


def stamped_name(name: Column, at: Column) -> Column:
    """``a.csv`` delivered at 09:30 -> ``a_20240102_0930.csv``."""
    stem = F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 1)
    suffix = F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 2)
    return F.concat(stem, F.lit("_"), F.date_format(at, "yyyyMMdd_HHmm"), suffix)
