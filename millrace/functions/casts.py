"""Lenient typed casts: text in, typed value or NULL out, never an error."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import ColumnMap

# The characters a unicode-aware strip removes.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)

# Words accepted as booleans.
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")

# Words that stand for a missing value in schema-less input.
NULL_WORDS = ("N/A", "NULL")

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$"

DEFAULT_ZONE = "America/New_York"

# strptime directive -> (pattern letters between separators, fixed-width letters)
_DIRECTIVES = {
    "Y": ("yyyy", "yyyy"),
    "y": ("yy", "yy"),
    "m": ("M", "MM"),
    "d": ("d", "dd"),
    "b": ("MMM", "MMM"),
    "B": ("MMMM", "MMMM"),
    "H": ("H", "HH"),
    "I": ("h", "hh"),
    "M": ("m", "mm"),
    "S": ("s", "ss"),
    "p": ("a", "a"),
}


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def tidy(c: Column) -> Column:
    """Strip white space, then every leading quote; what is left empty becomes NULL.

    Most cells need nothing: text that starts and ends with a printable ASCII
    character past the quote is passed on after two comparisons.
    """
    text = c.cast("string")
    plain = text.between("*", "~") & F.right(text, F.lit(1)).between("!", "~")
    return F.when(plain, text).otherwise(F.nullif(F.ltrim(strip(text), F.lit("'")), F.lit("")))


def spark_layout(strptime_format: str) -> str:
    """Translate a strptime layout; directives that touch each other need fixed width."""
    tokens: list[tuple[bool, str]] = []
    i = 0
    while i < len(strptime_format):
        if strptime_format[i] == "%":
            letter = strptime_format[i + 1]
            if letter not in _DIRECTIVES:
                raise ValueError(f"unsupported date directive %{letter}")
            tokens.append((True, letter))
            i += 2
        else:
            tokens.append((False, strptime_format[i]))
            i += 1
    out = []
    for n, (directive, text) in enumerate(tokens):
        if not directive:
            out.append(f"'{text}'" if text.isalpha() else text)
            continue
        touches = (n > 0 and tokens[n - 1][0]) or (n + 1 < len(tokens) and tokens[n + 1][0])
        out.append(_DIRECTIVES[text][1 if touches else 0])
    return "".join(out)


def number(text: Column) -> Column:
    """Text to double. Tested first: the plain cast would also take ``1.0d`` and
    hex floats, and a cast that fails is far more expensive than the test.
    """
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


_SHAPES = {"yyyy": r"\d{4}", "MMMM": r"\p{L}+", "MMM": r"\p{L}{3}", "a": r"\p{L}{2}"}


def layout_shape(layout: str) -> str:
    """Regular expression for text that may fit a layout.

    Parsing text that does not fit costs an exception inside the parser, many
    times the price of this test.
    """
    parts = []
    for run in re.finditer(r"([A-Za-z])\1*|'[^']*'|.", layout):
        text = run[0]
        if text[0] == "'":
            parts.append(re.escape(text[1:-1]))
        elif text.isalpha():
            parts.append(_SHAPES.get(text, r"\d{1,2}" if len(text) == 1 else rf"\d{{{len(text)}}}"))
        else:
            parts.append(re.escape(text))
    return "^" + "".join(parts) + "$"


def parse_timestamp(text: Column, layout: str) -> Column:
    return F.when(text.rlike(layout_shape(layout)), F.try_to_timestamp(text, F.lit(layout)))


def local_timestamp(text: Column, layout: str, zone: str = DEFAULT_ZONE) -> Column:
    """Parse wall-clock text of ``zone`` to an instant, whatever the session zone is."""
    zoned = F.try_to_timestamp(F.concat(text, F.lit(f" {zone}")), F.lit(f"{layout} VV"))
    return F.when(text.rlike(layout_shape(layout)), zoned)


# Each converter takes a column, its type, its mapping, and whether it is tidy
# text already (so that a caller can tidy once in an earlier projection).


def _text(c: Column, tidied: bool) -> Column:
    return c if tidied else tidy(c)


def to_str(c: Column, _from: T.DataType, _m: ColumnMap, tidied: bool = False) -> Column:
    return _text(c, tidied)


def to_float(c: Column, source: T.DataType, _m: ColumnMap, tidied: bool = False) -> Column:
    if passes("float", source):
        return c
    return number(F.replace(_text(c, tidied), F.lit(","), F.lit("")))


def to_int(c: Column, source: T.DataType, _m: ColumnMap, tidied: bool = False) -> Column:
    """Round half to even; whole numbers keep all digits, what a long cannot hold becomes NULL."""
    if passes("int", source):
        return c.cast("long")
    text = F.replace(_text(c, tidied), F.lit(","), F.lit(""))
    whole = text.rlike(r"^[+-]?\d+$")
    return F.when(whole, text.try_cast("long")).otherwise(F.rint(number(text)).try_cast("long"))


def to_bool(c: Column, source: T.DataType, _m: ColumnMap, tidied: bool = False) -> Column:
    if passes("bool", source):
        return c
    words = [F.lit(v) for w in TRUE_WORDS for v in (w, True)] + [F.lit(v) for w in FALSE_WORDS for v in (w, False)]
    return F.try_element_at(F.create_map(*words), F.lower(_text(c, tidied)))


def to_pct(c: Column, _from: T.DataType, _m: ColumnMap, tidied: bool = False) -> Column:
    """Percent text to a fraction; always divides by 100, sign or no sign."""
    return number(F.translate(_text(c, tidied), "%,", "")) / F.lit(100.0)


def to_datetime(c: Column, source: T.DataType, m: ColumnMap, tidied: bool = False) -> Column:
    if passes("datetime", source):
        return c
    if not m.datetime_format:
        raise ValueError(f"column for {m.target!r}: a datetime needs a format")
    return local_timestamp(_text(c, tidied), spark_layout(m.datetime_format))


_PASSED = {
    "float": (T.FloatType, T.DoubleType),
    "int": (T.IntegralType,),
    "bool": (T.BooleanType,),
    "datetime": (T.TimestampType, T.TimestampNTZType),
}


def passes(dtype: str, source: T.DataType) -> bool:
    """Whether a column of this type is taken as it is."""
    return isinstance(source, _PASSED.get(dtype, ()))


Converter = Callable[..., Column]

CONVERTERS: dict[str, Converter] = {
    "datetime": to_datetime,
    "str": to_str,
    "float": to_float,
    "int": to_int,
    "bool": to_bool,
    "pct": to_pct,
}


def converter(dtype: str) -> Converter:
    if dtype not in CONVERTERS:
        raise ValueError(f"unknown type {dtype!r}; known: {', '.join(CONVERTERS)}")
    return CONVERTERS[dtype]


def null_words(c: Column, words: Sequence[str] = NULL_WORDS) -> Column:
    """Opt-in: words such as ``N/A`` become NULL (any letter case)."""
    return F.when(~F.upper(c).isin(*[w.upper() for w in words]), c)


def currency_number(text: Column) -> Column:
    """Tidy number text that may carry a currency sign and thousands separators."""
    return number(F.translate(text, "$,", ""))


def mixed_date(text: Column, layouts: Sequence[str] = ("yyyyMMdd", "yyyy-M-d")) -> Column:
    """Tidy date text whose layout changes from row to row: the first layout that fits wins."""
    return F.coalesce(*[parse_timestamp(text, f) for f in layouts]).cast("date")
