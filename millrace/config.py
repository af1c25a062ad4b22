"""Declarative records: how a column, a silver table and a feed are described."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

COLUMN_TYPES = ("str", "float", "int", "bool", "pct", "datetime")

AUDIT_COLUMNS = ("ingested_at", "source_file", "batch_id")


@dataclass(frozen=True)
class ColumnMap:
    """One source column: its declared type, silver name and, for dates, its layout."""

    dtype: str
    target: str
    datetime_format: str | None = None


@dataclass(frozen=True)
class SilverSpec:
    """Target table of a feed: keys, typed columns and the column that ranks versions."""

    table: str
    primary_keys: tuple[str, ...]
    columns: Mapping[str, ColumnMap] = field(default_factory=dict)
    dedup_timestamp: str = "ingested_at"
    table_type: str = "fact"

    def __post_init__(self) -> None:
        if isinstance(self.primary_keys, str):
            object.__setattr__(self, "primary_keys", (self.primary_keys,))
        else:
            object.__setattr__(self, "primary_keys", tuple(self.primary_keys))
        if self.table_type not in ("fact", "reference"):
            raise ValueError(f"table_type must be 'fact' or 'reference', not {self.table_type!r}")


@dataclass(frozen=True)
class FeedSpec:
    """One feed: which file names belong to it, how to parse them, where they land.

    ``parser`` takes ``(spark, paths)`` and returns the raw rows of *all* given
    files, each with a ``source_file`` column.
    """

    pattern: str
    parser: Callable | str
    bronze_table: str
    rename: bool = False
    load_type: str = "append"
    silver: SilverSpec | None = None
    options: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self) -> None:
        re.compile(self.pattern)
        if self.load_type not in ("append", "overwrite"):
            raise ValueError(f"load_type must be 'append' or 'overwrite', not {self.load_type!r}")

    def with_columns(self, columns: Mapping[str, ColumnMap]) -> FeedSpec:
        return replace(self, silver=replace(self.silver, columns=dict(columns)))


_ENTRY = re.compile(r"`(?P<source>[^`]+)`→(?P<target>\w+):(?P<dtype>\w+)(?:\[(?P<layout>[^\]]+)\])?")
_TABLE = re.compile(r"^\* \*\*(?P<table>\w+)\*\*")


def column_map(text: str) -> dict[str, ColumnMap]:
    """Read column maps from notation such as ``` `Trade Date`→trade_date:datetime[%m/%d/%Y]; … ```."""
    found = {}
    for m in _ENTRY.finditer(text):
        if m["dtype"] not in COLUMN_TYPES:
            raise ValueError(f"column {m['source']!r}: unknown type {m['dtype']!r}")
        found[m["source"]] = ColumnMap(m["dtype"], m["target"], m["layout"])
    return found


def column_maps_from_text(lines: Sequence[str]) -> dict[str, dict[str, ColumnMap]]:
    """Read a mapping document: one ``* **table** …: entries`` line per bronze table."""
    maps = {}
    for line in lines:
        head = _TABLE.match(line)
        if head:
            maps[head["table"]] = column_map(line)
    return maps
