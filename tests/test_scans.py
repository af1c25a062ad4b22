"""Scans lose no cell and no row without saying so; batch ids and types stay what they are."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.blocks import expand_header, whole_file
from millrace.operators.upsert import align_types, alignment_loss
from millrace.sinks.bronze import write_bronze
from millrace.sources.delimited import scan_by_name, scan_delimited, scan_header_shift, scan_skip_bad_rows
from millrace.sources.grid import ragged_grid
from millrace.sources.tables import read_table
from millrace.streaming.inbox import stream_bronze, stream_csv

WIDE = 90


def csv(folder, name, *rows):
    (folder / name).write_text("\n".join(",".join(map(str, r)) for r in rows) + "\n")
    return str(folder / name)


def test_wide_files_keep_all_columns(spark, folder):
    header = [f"h{i}" for i in range(WIDE)]
    path = csv(folder, "wide.csv", header, range(WIDE), [*range(WIDE), "more"])
    kept = scan_skip_bad_rows(spark, path)
    assert set(header) <= set(kept.columns) and [r["h89"] for r in kept.collect()] == ["89"]
    shifted = scan_header_shift(spark, csv(folder, "shift.csv", header, ["label", *range(WIDE)]))
    assert [(r["h89"], r["h0"]) for r in shifted.collect()] == [("89", "0")]
    assert max(len([c for c in r.cells if c]) for r in ragged_grid(spark, path).collect()) == WIDE + 1


def test_bad_row_at_the_edge_of_a_stated_width(spark, folder):
    path = csv(folder, "edge.csv", "abcd", [1, 2, 3, 4], [1, 2, 3, 4, 5])
    assert scan_skip_bad_rows(spark, path, width=4).count() == 1
    with pytest.raises(PySparkException, match="wider than"):
        scan_skip_bad_rows(spark, csv(folder, "header.csv", "abcde", [1]), width=4).count()


def test_long_rows_are_an_error_unless_stated(spark, folder):
    path = csv(folder, "long.csv", "ab", [1, 2], [3, 4, 5])
    with pytest.raises(PySparkException, match="longer than its header"):
        scan_by_name(spark, path).collect()
    assert scan_by_name(spark, path, long_rows="drop").count() == 1
    assert scan_by_name(spark, path, long_rows="keep").count() == 2


def test_line_breaks_in_quotes_widen_a_row(spark, folder):
    path = folder / "quoted.csv"
    path.write_text('a,b,c,d\n1,"x\ny",3,4\n"p\nq",2,"r\ns",4\n')
    assert [r["d"] for r in scan_by_name(spark, str(path)).collect()] == ["4", "4"]


def test_streamed_files_with_other_headers_fail(spark, folder):
    (folder / "in").mkdir()
    csv(folder / "in", "one.csv", "BA", [1, 2])
    query = stream_bronze(stream_csv(spark, str(folder / "in"), ["A", "B"]), str(folder / "t"), str(folder / "cp"), "r")
    with pytest.raises(PySparkException):
        query.awaitTermination()


@pytest.mark.parametrize("batch", ["007", "2024-01-31", "1e3"])
def test_batch_ids_stay_text(spark, folder, batch):
    rows = spark.range(2).withColumns({"ingested_at": F.lit(dt.datetime(2024, 1, 1)), "batch_id": F.lit(batch)})
    path = str(folder / "t")
    write_bronze(rows, path)
    write_bronze(rows.withColumn("batch_id", F.lit("7")), path)
    assert {r.batch_id for r in read_table(spark, path).collect()} == {batch, "7"}
    own = read_table(spark, path, schema=rows.schema, batch_id=batch)
    assert own.columns == rows.columns and {r.batch_id for r in own.collect()} == {batch}


def test_values_that_do_not_fit_the_target(spark):
    df = spark.createDataFrame([("1", "x"), ("oops", None)], "n string, s string")
    target = spark.createDataFrame([], "n int, s string").schema
    assert [r.n for r in align_types(df, target).collect()] == [1, None]
    assert alignment_loss(df, target).first().asDict() == {"n": 1}


def test_offset_of_an_extreme_row(spark):
    from millrace.operators.calendar import business_day_offset

    df = spark.createDataFrame([(dt.date(2024, 1, 5), 1), (dt.date(2024, 1, 5), 2_000_000_000)], "d date, n int")
    holidays = spark.createDataFrame([(dt.date(2024, 1, 8),)], "date date")
    got = {r.n: r.offset_at for r in business_day_offset(df, "d", "n", holidays).collect()}
    assert got == {1: dt.date(2024, 1, 9), 2_000_000_000: None}


@pytest.mark.parametrize("multiline", [False, True])
def test_delimited_scans_lose_no_cell(spark, folder, multiline):
    (folder / "a.csv").write_text('A,B\n1,2\n"x, ""y""",4\n3,4,LOST\n5\n6,7,,\n8,9,,more\n')
    scan = lambda **o: scan_delimited(spark, str(folder), multiline=multiline, **o)
    with pytest.raises(Exception, match="longer than its header in a.csv"):
        scan().select("A").collect()
    fitting = [("1", "2"), ('x, "y"', "4"), ("5", None), ("6", "7")]
    assert [tuple(r)[:2] for r in scan(long_rows="drop").collect()] == fitting
    assert scan(long_rows="drop").count() == 4 and scan(long_rows="drop").select("source_file").count() == 4
    assert len(scan(long_rows="keep").collect()) == 6
    marked = scan(long_rows="mark").select("A", "_error").collect()
    assert [r.A for r in marked if r._error] == ["3", "8"] and len(marked) == 6
    with pytest.raises(ValueError):
        scan(long_rows="cut")


def test_streams_lose_no_cell(spark, folder):
    from millrace.streaming import stream_bronze, stream_csv

    inbox = folder / "inbox"
    inbox.mkdir()
    (inbox / "a.csv").write_text("A,B\n1,2\n3,4,LOST\n5\n")
    run = lambda name, **o: stream_bronze(
        stream_csv(spark, str(inbox), ["A", "B"], **o), f"{folder}/{name}", f"{folder}/{name}-check", name
    ).awaitTermination()
    with pytest.raises(Exception, match="longer than its header"):
        run("error")
    run("drop", long_rows="drop")
    assert sorted((r.A, r.B) for r in spark.read.parquet(f"{folder}/drop").collect()) == [("1", "2"), ("5", None)]
    run("mark", long_rows="mark")
    assert sorted((r.A, r._error is None) for r in spark.read.parquet(f"{folder}/mark").collect()) == [("1", True), ("3", False), ("5", True)]


def test_business_days_against_numpy(spark):
    import random
    from datetime import date, timedelta

    import numpy as np

    from millrace.operators.calendar import business_day_offset

    rng = random.Random(5)
    off = sorted({date(2019, 1, 1) + timedelta(rng.randrange(1500)) for _ in range(90)})
    rows = [(date(2020, 1, 1) + timedelta(rng.randrange(900)), rng.choice([0, 1, -1, rng.randrange(-300, 300)])) for _ in range(400)]
    holidays = spark.createDataFrame([(d,) for d in off], "date date")
    want = [np.busday_offset(d, n, roll="backward" if n > 0 else "forward", holidays=off).astype(object) for d, n in rows]
    for some in (rows, [(None, 1), (date(2020, 1, 1), None), (date(9999, 12, 30), 9), (date(1, 1, 3), -9), (date(2020, 1, 1), 2**62)]):
        got = business_day_offset(spark.createDataFrame(some, "d date, n bigint"), "d", "n", holidays).collect()
        assert [r.offset_at for r in got] == (want if some is rows else [None] * 5)
    none = business_day_offset(spark.createDataFrame(rows, "d date, n bigint"), "d", "n", holidays.limit(0)).collect()
    assert [r.offset_at for r in none] == [np.busday_offset(d, n, roll="backward" if n > 0 else "forward").astype(object) for d, n in rows]


def test_scanned_rows_are_never_ordered(spark, folder):
    """Row numbers and headers of whole files come to the rows without an order of them, whatever files a task reads."""
    for n in range(12):
        names = ["a", "b"] if n % 2 else ["b", "a", "c"]
        csv(folder, f"{n:02}.csv", names, *[[f"{x}{n}-{i}" for x in names] for i in range(n)])
    out = scan_by_name(spark, str(folder))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    want = [(f"{n:02}.csv", f"a{n}-{i}", f"b{n}-{i}", None if n % 2 else f"c{n}-{i}") for n in range(12) for i in range(n)]
    assert sorted((r.source_file, r.a, r.b, r.c) for r in out.collect()) == sorted(want)


def test_headers_are_taken_from_their_own_rows(spark):
    grid = spark.createDataFrame(
        [("f", 0, ["a", "b"], 2), ("f", 1, ["1", "2", "3"], 3), ("f", 2, ["4"], 1), ("g", 0, ["c"], 1)],
        "source_file string, row_no long, cells array<string>, _fields int",
    )
    found = expand_header(whole_file(grid), 0, shift_label="l")
    assert re.search(r"Filter .*row_no#\d+L (= 0|IN \(0,1\))", found._jdf.queryExecution().optimizedPlan().toString())
    got = sorted((r.source_file, r.names, r.positions, r.header_size, r._from, r._to) for r in found.collect())
    assert got == [("f", ["l", "a", "b"], [0, 1, 2], 3, 0, 2), ("g", ["c"], [0], 1, 0, 0)]
