"""Report grids: blocks, promoted headers, key/value metrics, totals and anchors.

All operators take the grid columns ``source_file, row_no, cells``; blocked
grids add ``block_id`` (from 1), ``block_row`` (from 0) and ``block_size``.

Nothing here orders or gathers a whole file or block in one task: running
values go through parts of ``CHUNK_ROWS`` rows plus one summary record per
part, and block-level values reach the rows through :func:`attach`, whose join
key also carries the part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.casts import strip
from millrace.session import stage

CHUNK_ROWS = 50_000
# Rows whose block starts are looked up together.
START_ROWS = 1_000
MAX_COLUMNS = 5_000
BLOCK = ["source_file", "block_id"]

# Labels of total rows and columns.
TOTAL_LABELS = ("TOTAL", "GRAND TOTAL", "TOTALS")


def cell(i: int | Column, cells: str = "cells") -> Column:
    return F.get(F.col(cells), F.lit(i) if isinstance(i, int) else i)


def _part(chunk_rows: int) -> Column:
    return F.floor(F.col("row_no") / F.lit(chunk_rows)).cast("long")


def attach(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Inner join of rows to one record per key, safe for a key that holds most rows.

    The record is repeated once per part of the key that has rows, so every
    join group is at most ``chunk_rows`` long.  Where the lookup knows its row
    range (``_from``, ``_to``) the parts follow from that, else the rows are
    asked.  A lookup that turns out small is broadcast by the optimizer on its
    own size estimate.
    """
    parted = rows.withColumn("_part", _part(chunk_rows))
    if "_from" in lookup.columns:
        first, last = (F.floor(F.col(c) / chunk_rows).cast("long") for c in ("_from", "_to"))
        spread = lookup.withColumn("_part", F.explode(F.sequence(first, last))).drop("_from", "_to")
    else:
        spread = parted.select(*keys, "_part").distinct().join(lookup, list(keys))
    return parted.join(spread, [*keys, "_part"]).drop("_part")


def number_blocks(
    grid: DataFrame, marker: str, *, sized: bool = True, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Split files into blocks at rows whose first cell starts with ``marker`` (any case).

    Rows before a file's first marker belong to no block and are left out.
    Without ``sized`` the rows carry their file's end instead of their block's
    size.  One window counts a part's starts up to each row; where its block
    begins and ends is then looked up among the starts of the part, and those
    before and after it, which come to the rows by one join.
    """
    starts = F.upper(cell(0)).startswith(marker.upper())
    parted = grid.withColumn("_part", _part(min(chunk_rows, START_ROWS)))

    # One record per marker row, and one for all other rows of a part.
    found = parted.select("source_file", "_part", "row_no", F.when(starts, F.col("row_no")).alias("_start"))
    found = found.groupBy("source_file", "_part", "_start").agg(F.max("row_no").alias("_end"))
    summary = found.groupBy("source_file", "_part").agg(
        F.sort_array(F.collect_list("_start")).alias("_starts"), F.max("_end").alias("_end")
    )
    # What follows is found by running backwards: a frame that reaches to the
    # end of its group would be evaluated anew for every row.
    by_file = Window.partitionBy("source_file")
    earlier = by_file.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    later = by_file.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        "source_file",
        "_part",
        "_starts",
        F.coalesce(F.sum(F.size("_starts")).over(earlier), F.lit(0)).alias("_blocks_before"),
        F.max(F.array_max("_starts")).over(earlier).alias("_start_before"),
        F.min(F.array_min("_starts")).over(later).alias("_start_after"),
        (F.max("_end").over(by_file) + 1).alias("file_end"),
    )

    upto = F.count(F.when(starts, F.col("row_no"))).over(
        Window.partitionBy("source_file", "_part").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = parted.join(carry, ["source_file", "_part"]).withColumn("_upto", upto.cast("int")).withColumns(
        {
            "block_id": F.col("_blocks_before") + F.col("_upto"),
            "_from": F.coalesce(F.get("_starts", F.col("_upto") - 1), F.col("_start_before")),
        }
    )
    place = ["block_id", (F.col("row_no") - F.col("_from")).alias("block_row")]
    if sized:
        end = F.coalesce(F.get("_starts", F.col("_upto")), F.col("_start_after"), F.col("file_end"))
        place.append((end - F.col("_from")).alias("block_size"))
    else:
        place.append("file_end")
    return placed.where(F.col("block_id") > 0).select(*grid.columns, *place)


def whole_file(grid: DataFrame) -> DataFrame:
    """Treat each file as one block."""
    return grid.withColumn("block_id", F.lit(1).cast("long")).withColumn("block_row", F.col("row_no"))


def pairs(cells: Column) -> Column:
    """Cells (0,1), (2,3), … of a row as key/value structs; an odd last cell is left over."""
    return F.transform(
        F.filter(F.sequence(F.lit(0), F.size(cells)), lambda i: (i % 2 == 0) & (i + 1 < F.size(cells))),
        lambda i: F.struct(F.get(cells, i).alias("key"), F.get(cells, i + 1).alias("value")),
    )


def key_values(rows: DataFrame, entries: Column, by: Sequence[str] = BLOCK) -> DataFrame:
    """One row per ``by`` and key; the last entry of a key wins, even with a NULL value."""
    long = (
        rows.select(*by, "row_no", F.posexplode(entries).alias("pos", "entry"))
        .where(F.col("entry.key").isNotNull())
        .select(*by, "row_no", "pos", F.col("entry.key").alias("key"), F.struct("entry.value").alias("_v"))
    )
    return (
        long.groupBy(*by, "key")
        .agg(F.max_by("_v", F.struct("row_no", "pos")).alias("_v"))
        .select(*by, "key", F.col("_v.value").alias("value"))
    )


def metrics_map(kv: DataFrame, by: Sequence[str] = BLOCK) -> DataFrame:
    """Gather key/value rows per block into a map. Only for fixed-size heads and tails."""
    return kv.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("metrics"))


def _numbered_names(cells: Column) -> Column:
    """Repeat names get ``.1``, ``.2``, … so that each cell keeps a name of its own."""

    def name(c: Column, i: Column) -> Column:
        earlier = F.size(F.filter(F.slice(cells, F.lit(1), i), lambda x: x == c))
        return F.when(earlier > 0, F.concat(c, F.lit("."), earlier.cast("string"))).otherwise(c)

    return F.transform(cells, name)


def _header_of(cells: Column) -> list[Column]:
    """Names, their positions and the length of a header given as cells."""
    named = _numbered_names(cells)
    at = F.filter(F.transform(named, lambda n, i: F.when(n.isNotNull(), i)), lambda i: i.isNotNull())
    return [
        F.filter(named, lambda n: n.isNotNull()).alias("names"),
        at.alias("positions"),
        F.coalesce(F.array_max(at) + 1, F.lit(0)).alias("header_size"),
    ]


def expand_header(
    grid: DataFrame,
    header_row: int,
    *,
    names: Column | None = None,
    shift_label: str | None = None,
) -> DataFrame:
    """Header of each block: its names, their cell positions, the header's length and the block's rows.

    ``names`` replaces the plain ``cells`` by an expression over them.  With
    ``shift_label`` a first data row one longer than the header (``_fields``)
    moves all names one cell to the right, behind the label.
    """
    cells = F.col("cells") if names is None else names

    def at(row: int, value: Column) -> Column:
        return F.max(F.when(F.col("block_row") == row, value))

    # Only the special rows are gathered: arrays of cells make Spark order all rows that it aggregates.
    rows = grid.where(F.col("block_row").isin(header_row, header_row + 1) if shift_label else F.col("block_row") == header_row)
    sized = "block_size" in grid.columns
    first = F.col("row_no") - F.col("block_row")
    header = rows.groupBy(*BLOCK).agg(
        at(header_row, cells).alias("_header"),
        (at(header_row + 1, F.col("_fields")) if shift_label else F.lit(None)).alias("_first"),
        # With sizes the range follows from any row.
        *([F.min(first).alias("_from"), F.max(first + F.col("block_size") - 1).alias("_to")] if sized else []),
    )
    if not sized:
        header = header.join(grid.groupBy(*BLOCK).agg(F.min("row_no").alias("_from"), F.max("row_no").alias("_to")), BLOCK)
    header = header.where(F.col("_header").isNotNull()).select(
        *BLOCK, *_header_of(F.col("_header")), "_first", "_from", "_to"
    )
    if shift_label is None:
        return header.drop("_first")
    shifted = F.coalesce(F.col("_first") == F.col("header_size") + 1, F.lit(False))
    return header.select(
        *BLOCK,
        F.when(shifted, F.concat(F.array(F.lit(shift_label)), "names")).otherwise(F.col("names")).alias("names"),
        F.when(shifted, F.concat(F.array(F.lit(0)), F.transform("positions", lambda p: p + 1)))
        .otherwise(F.col("positions"))
        .alias("positions"),
        (F.col("header_size") + shifted.cast("int")).alias("header_size"),
        "_from",
        "_to",
    )


def last_entries(entries: Column) -> Column:
    """Entries with a key, without those whose key comes again later."""
    keyed = F.filter(entries, lambda e: e["key"].isNotNull())
    return F.filter(
        keyed,
        lambda e, i: ~F.exists(F.slice(keyed, i + 2, F.size(keyed)), lambda later: later["key"] == e["key"]),
    )


def block_heads(
    blocks: DataFrame,
    header_row: int,
    sections: Sequence[tuple[Column, Column]],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Header and metrics of every block in one pass over its few special rows.

    ``sections`` are (condition, entries) pairs, each naming a fixed number of
    rows per block; later sections and rows overwrite earlier keys.  With
    ``columns`` other keys are dropped before anything is exchanged.
    """
    special = F.col("block_row") == header_row
    lists = []
    for n, (holds, entries) in enumerate(sections):
        special = special | holds
        wanted = entries if columns is None else F.filter(entries, lambda e: e["key"].isin(list(columns)))
        lists.append(
            F.sort_array(F.collect_list(F.when(holds, F.struct("row_no", wanted.alias("entries"))))).alias(f"_s{n}")
        )
    if "block_size" in blocks.columns:
        end = F.col("row_no") - F.col("block_row") + F.col("block_size")
    elif "file_end" in blocks.columns:
        end = F.col("file_end")
    else:  # whole files: their end is seen only by reading them
        end, special = F.col("row_no") + 1, F.lit(True)
    heads = blocks.where(special).groupBy(*BLOCK).agg(
        F.max(F.when(F.col("block_row") == header_row, F.col("cells"))).alias("_header"),
        F.min(F.col("row_no") - F.col("block_row")).alias("_from"),
        F.max(end).alias("_end"),
        *lists,
    )
    following = F.lead("_from").over(Window.partitionBy("source_file").orderBy("block_id"))
    heads = heads.withColumn("_to", F.coalesce(following, F.col("_end")) - 1)
    entries = F.flatten(F.concat(*[F.transform(f"_s{n}", lambda r: r["entries"]) for n in range(len(sections))]))
    return (
        heads.where(F.col("_header").isNotNull())
        .withColumn("_entries", entries)
        .select(
            *BLOCK, *_header_of(F.col("_header")), "_from", "_to",
            F.map_from_entries(last_entries(F.col("_entries"))).alias("metrics"),
        )
    )


def discover_columns(lookup: DataFrame, with_metrics: bool) -> list[str]:
    """Union of all header names and metric keys, headers first. Runs a job over headers only."""
    named = lookup.select(F.posexplode("names").alias("at", "name")).select(F.lit(0).alias("kind"), "at", "name")
    if with_metrics:
        keys = lookup.select(F.posexplode(F.map_keys("metrics")).alias("at", "name"))
        named = named.unionByName(keys.select(F.lit(1).alias("kind"), "at", "name"))
    found = (
        named.groupBy("name").agg(F.min(F.struct("kind", "at")).alias("first")).limit(MAX_COLUMNS + 1).collect()
    )
    if len(found) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} different column names; is the header row right?")
    return [r["name"] for r in sorted(found, key=lambda r: (r["first"]["kind"], r["first"]["at"], r["name"]))]


def promote_header(
    grid: DataFrame,
    header_row: int,
    *,
    columns: Sequence[str] | None = None,
    metrics: DataFrame | None = None,
    lookup: DataFrame | None = None,
    data: Column | None = None,
    row_filter: Column | None = None,
    keep: Sequence[str] = ("source_file",),
) -> DataFrame:
    """Name the cells below a header row and spread block metrics over the rows.

    ``lookup`` is a prepared header (:func:`expand_header`) or header with
    metrics (:func:`block_heads`).  A metric replaces a table column of the same
    name.  ``data`` picks the data rows before the join, ``row_filter`` after
    it, when further lookup columns are at hand.  With ``columns`` the plan stays lazy; without, one job over the headers finds their names.
    Columns a block does not have are NULL.
    """
    if lookup is None:
        lookup = expand_header(grid, header_row)
    if metrics is not None:
        lookup = lookup.join(metrics, BLOCK, "left").withColumn(
            "metrics", F.coalesce("metrics", F.create_map().cast("map<string,string>"))
        )
    with_metrics = "metrics" in lookup.columns
    if columns is None:  # the headers are read for their names, and then meet the rows
        lookup = stage(lookup, "headers")
    wanted = list(columns) if columns is not None else discover_columns(lookup, with_metrics)

    want = F.array(*[F.lit(n) for n in wanted]) if wanted else F.array().cast("array<string>")
    own = {*BLOCK, "names", "positions", "metrics"}
    slim = [
        *BLOCK,
        *[c for c in lookup.columns if c not in own],
        F.transform(want, lambda n: F.get("positions", F.array_position("names", n).cast("int") - 1)).alias("_at"),
    ]
    if with_metrics:
        slim.append(F.transform(want, lambda n: F.map_contains_key(F.col("metrics"), n)).alias("_has"))
        slim.append(F.transform(want, lambda n: F.col("metrics")[n]).alias("_value"))
    body = grid.where(F.col("block_row") > header_row if data is None else data)
    joined = attach(body, lookup.select(*slim), BLOCK)
    if row_filter is not None:
        joined = joined.where(row_filter)

    def output(k: int) -> Column:
        here = F.get("cells", F.get("_at", F.lit(k)))
        if not with_metrics:
            return here
        return F.when(F.get("_has", F.lit(k)), F.get("_value", F.lit(k))).otherwise(here)

    kept = [c for c in keep if c not in wanted]
    return joined.select(*kept, *[output(k).alias(n) for k, n in enumerate(wanted)])


def blank_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cells of white space only become NULL."""
    names = list(columns) if columns is not None else df.columns
    return df.withColumns({n: F.when(strip(F.col(f"`{n}`")) != "", F.col(f"`{n}`")) for n in names})


def drop_empty_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns) if columns is not None else df.columns
    return df.where(F.coalesce(*[F.col(f"`{n}`").cast("string") for n in names]).isNotNull())


def drop_empty_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Leave out columns without any value. One aggregate job over the input."""
    names = list(columns) if columns is not None else df.columns
    if not names:
        return df
    counts = df.agg(*[F.count(F.col(f"`{n}`")).alias(str(i)) for i, n in enumerate(names)]).first()
    return df.drop(*[n for i, n in enumerate(names) if counts[str(i)] == 0])


def find_anchor(grid: DataFrame, label: str, within: int = 6, required: bool = True) -> DataFrame:
    """First cell, row by row, whose stripped text is ``label``, in the top-left square.

    One row ``(source_file, anchor_row, anchor_col)`` per file.  A file without
    the anchor raises when ``required``.
    """
    corner = grid.where(F.col("row_no") < within).select(
        "source_file", "row_no", F.posexplode(F.slice("cells", 1, within)).alias("pos", "text")
    )
    hit = F.upper(strip(F.col("text"))) == label.upper()
    found = corner.groupBy("source_file").agg(F.min(F.when(hit, F.struct("row_no", "pos"))).alias("_at"))
    if required:
        message = F.concat(F.lit(f"no {label!r} cell in the first {within} rows and columns of "), F.col("source_file"))
        at = F.when(F.col("_at").isNotNull(), F.col("_at")).otherwise(F.raise_error(message))
        found = found.withColumn("_at", at)
    return found.select("source_file", F.col("_at.row_no").alias("anchor_row"), F.col("_at.pos").alias("anchor_col"))


def is_total(c: Column, labels: Sequence[str] = TOTAL_LABELS) -> Column:
    return F.coalesce(F.upper(c).isin(*labels), F.lit(False))


def anchored_tables(grid: DataFrame, label: str, within: int = 6) -> DataFrame:
    """Where the table of each sheet starts and stops, and its header, in one pass over the grid.

    The table starts at the anchor (see :func:`find_anchor`) and stops before
    the first row below whose cell under the anchor is a total label.  Only the
    few top rows of a sheet are gathered.
    """
    top = F.col("row_no") < within
    sheets = grid.groupBy("source_file").agg(
        F.sort_array(F.collect_list(F.when(top, F.struct("row_no", "cells")))).alias("_top"),
        *[F.min(F.when(~top & is_total(cell(p)), F.col("row_no"))).alias(f"_total{p}") for p in range(within)],
        F.min("row_no").alias("_from"),
        F.max("row_no").alias("_to"),
    )

    def hits(row: Column) -> Column:
        marked = F.transform(
            F.slice(row["cells"], 1, within),
            lambda c, i: F.when(
                F.upper(strip(c)) == label.upper(),
                F.struct(row["row_no"].alias("row_no"), i.alias("col"), row["cells"].alias("cells")),
            ),
        )
        return F.filter(marked, lambda h: h.isNotNull())

    message = F.concat(F.lit(f"no {label!r} cell in the first {within} rows and columns of "), F.col("source_file"))
    found = F.get(F.flatten(F.transform("_top", hits)), F.lit(0))
    placed = sheets.withColumn("_at", F.when(found.isNotNull(), found).otherwise(F.raise_error(message))).withColumns(
        {"anchor_row": F.col("_at.row_no"), "anchor_col": F.col("_at.col")}
    )
    total_in_top = F.transform(
        F.filter(
            "_top",
            lambda r: (r["row_no"] > F.col("anchor_row")) & is_total(F.get(r["cells"], F.col("anchor_col"))),
        ),
        lambda r: r["row_no"],
    )
    total_below = F.get(F.array(*[F.col(f"_total{p}") for p in range(within)]), F.col("anchor_col"))
    header = placed.select(
        "source_file",
        F.lit(1).cast("long").alias("block_id"),
        "anchor_row",
        "anchor_col",
        F.least(F.array_min(total_in_top), total_below).alias("stop_row"),
        *_header_of(F.slice("_at.cells", F.col("anchor_col") + 1, F.size("_at.cells"))),
        "_from",
        "_to",
    )
    return header.withColumn("positions", F.transform("positions", lambda p: p + F.col("anchor_col")))


def drop_total_columns(df: DataFrame, labels: Sequence[str] = TOTAL_LABELS) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.upper() in labels])
