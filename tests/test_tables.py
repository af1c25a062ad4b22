from __future__ import annotations

import datetime as dt
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.__main__ import arguments, main
from millrace.config import ColumnMap, FeedSpec, SilverSpec
from millrace.operators import columns, dedup, upsert, vendor
from millrace.operators.calendar import business_day_offset, holiday_dates
from millrace.operators.logs import elapsed, parse_messages, type_messages
from millrace.operators.rollup import position_rollup
from millrace.operators.routing import add_audit, route
from millrace.plans.medallion import Lake
from millrace.session import workspace
from millrace.sinks.bronze import write_bronze
from millrace.sinks.silver import SilverTable
from millrace.sources.tables import read_table, table_exists

SPEC = SilverSpec("t", ("k",), dedup_timestamp="at")


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v long, at long")


def existing(spark):
    rows = [("a", 1, 1, True), (None, 9, 1, True), ("z", 0, 0, False)]
    return spark.createDataFrame(rows, "k string, v long, at long, is_current boolean")


def state(df):
    return sorted(((r["k"] or "", r["v"], r["is_current"]) for r in df.collect()))


OLD = [("", 9, True), ("z", 0, False)]


def test_policies(spark, monkeypatch):
    real = upsert.compare_versions
    monkeypatch.setattr(upsert, "compare_versions", lambda *a, **k: real(*a, **{**k, "ignore": ("at",)}))
    incoming = frame(spark, [("a", 1, 2), ("b", 2, 2), (None, 3, 2)])
    assert state(upsert.upsert(existing(spark), incoming, SPEC, "always")) == sorted([*OLD, ("a", 1, False), ("a", 1, True), ("b", 2, True)])
    assert state(upsert.upsert(existing(spark), incoming, SPEC, "insert_new")) == sorted([*OLD, ("a", 1, True), ("b", 2, True)])
    assert state(upsert.upsert(existing(spark), incoming, SPEC, "on_change")) == sorted([*OLD, ("a", 1, True), ("b", 2, True)])
    changed = frame(spark, [("a", 5, 2)])
    assert state(upsert.upsert(existing(spark), changed, SPEC, "on_change")) == sorted([*OLD, ("a", 1, False), ("a", 5, True)])
    with pytest.raises(ValueError):
        upsert.upsert(existing(spark), incoming, SPEC, "sometimes")


def test_partial_keys_match_null_to_null(spark):
    current = spark.createDataFrame([("a", None, 1), (None, "y", 2)], "p string, q string, v long")
    incoming = spark.createDataFrame([("a", None, 1), (None, "y", 3), (None, None, 4)], "p string, q string, v long")
    fresh = dedup.latest_by_null_pattern(incoming, ["p", "q"], "v")
    got = upsert.compare_versions(current, fresh, ["p", "q"]).collect()
    assert sorted((r["action"], r["after"]["v"]) for r in got) == [("keep", 1), ("replace", 3)]


def test_new_and_missing_columns(spark):
    incoming = spark.createDataFrame([("a", "7", "n")], "k string, v string, extra string").withColumn("at", F.lit(2))
    out = upsert.upsert(existing(spark), incoming, SPEC)
    assert out.schema["v"].dataType.typeName() == "long"
    assert state(out) == sorted([*OLD, ("a", 1, False), ("a", 7, True)])
    assert {r["extra"] for r in out.collect()} == {None, "n"}


def test_silver_table_is_idempotent_and_keeps_history(spark):
    silver = SilverTable(spark, workspace(spark, "silver"), SPEC)
    assert not silver.exists()
    assert silver.upsert(frame(spark, [("a", 1, 1), ("a", 0, 0), ("b", 2, 1), (None, 3, 1)]), "1")
    assert silver.upsert(frame(spark, [("a", 4, 2), ("b", 2, 2)]), "2")
    first = state(silver.read())
    assert silver.upsert(frame(spark, [("a", 99, 9)]), "2") is False
    assert state(silver.read()) == first
    assert silver.upsert(frame(spark, [("c", 5, 3)]), "3")
    assert state(silver.read()) == [("a", 1, False), ("a", 4, True), ("b", 2, False), ("b", 2, True), ("c", 5, True)]
    per_key = silver.current().groupBy("k").count()
    assert per_key.where("count > 1").isEmpty()
    assert len(silver.last_commit()["closed"]) == 1


def test_a_batch_that_dies_before_its_commit_leaves_no_trace(spark, monkeypatch):
    silver = SilverTable(spark, workspace(spark, "silver"), SPEC)
    silver.upsert(frame(spark, [("a", 1, 1)]), "1")
    monkeypatch.setattr(SilverTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        silver.upsert(frame(spark, [("a", 2, 2)]), "2")
    monkeypatch.undo()
    assert state(silver.read()) == [("a", 1, True)]
    assert silver.upsert(frame(spark, [("a", 2, 2)]), "2")
    assert state(silver.read()) == [("a", 1, False), ("a", 2, True)]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_one_is_reduced_before_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"))
    for out in (dedup.latest_per_key(df, ["k"], "at"), dedup.unique_by(df, ["k"], ["at"]), dedup.unique_by(df, ["k"], ["at"], "none")):
        plan = plan_of(out)
        assert plan.index("Partial") > plan.index("Exchange hashpartitioning")  # printed from the top down


def test_no_plan_builds_pairs(spark):
    from millrace.workload import all_queries

    for name in ("scd2_on_change", "route_files", "log_elapsed", "pcf_report", "sql_cte_self_join", "join_left_indicator", "business_day_offset"):
        plan = plan_of(all_queries()[name][0](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_dedup_is_idempotent(spark):
    df = frame(spark, [("a", 1, None), ("a", 2, 5), (None, 3, 1), (None, 4, 1), ("b", 5, None)])
    once = dedup.latest_by_null_pattern(df, ["k", "v"], "at")
    twice = dedup.latest_by_null_pattern(once, ["k", "v"], "at")
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()
    assert sorted(r["v"] for r in dedup.latest_per_key(df, ["k"], "at").collect()) == [2, 4, 5]


def test_unique_none(spark):
    df = frame(spark, [("a", 1, 1), ("a", 2, 2), ("b", 3, 3)])
    assert [r["k"] for r in dedup.unique_by(df, ["k"], ["at"], "none").collect()] == ["b"]
    with pytest.raises(ValueError):
        dedup.unique_by(df, ["k"], ["at"], "some")


def test_column_blocks(spark):
    df = spark.createDataFrame([("1", "x")], ["a", "b"])
    with pytest.raises(ValueError, match="missing"):
        columns.validate_columns(df, ["a", "zz"])
    with pytest.raises(ValueError, match="missing"):
        columns.rename_columns(df, {"zz": "y"})
    with pytest.raises(ValueError, match="unknown type"):
        columns.cast_columns(df, {"a": "Money"})
    with pytest.raises(ValueError, match="last step"):
        columns.apply_transformations(df, [(columns.split_table, {"split_fn": lambda d: {"one": d}}), (columns.drop_columns, {"columns": []})])
    split = columns.apply_transformations(df, [(columns.split_table, {"split_fn": lambda d: {"one": d}})])
    assert list(split) == ["one"]


@pytest.mark.parametrize(
    ("anchor", "days", "want"),
    [("2024-01-06 00:00", 0, "2024-01-08 00:00"), ("2024-01-06 00:00", 1, "2024-01-08 00:00"), ("2024-01-06 00:00", -1, "2024-01-05 00:00"),
     ("2024-01-01 00:00", 0, "2024-01-02 00:00"), ("2024-01-01 00:00", 1, "2024-01-02 00:00"), ("2023-12-29 15:30", 1, "2024-01-02 15:30"),
     ("2024-01-03 00:00", 300, None)],
)
def test_business_days(spark, anchor, days, want):
    holidays = spark.createDataFrame([("Ontario", dt.date(2024, 1, 1))], "region string, date date")
    df = spark.createDataFrame([(datetime.fromisoformat(anchor), days)], "a timestamp_ntz, n int")
    got = business_day_offset(df, "a", "n", holiday_dates(holidays, "Nowhere")).first()["offset_at"]
    assert got is not None
    if want:
        assert got == datetime.fromisoformat(want)


def test_log_lines(spark):
    lines = [
        "2026-03-31 09:30:01.123456 AM: INFO: app.core: Update : 09:30 AM : Port 12 : ABC.TO BUY 1,000 (user1)",
        "2026-03-31 09:30:02.5 PM: INFO: app.core: Order : 09:30 PM : NEW BUY 500 ABC CN FILLED 500 @ 10.25 (user1)",
        "some other line",
    ]
    df = type_messages(parse_messages(spark.createDataFrame([(x,) for x in lines], "line string")))
    got = {r["msg_type"]: r for r in df.collect()}
    assert got["Update"]["log_ts"] == datetime(2026, 3, 31, 9, 30, 1, 123456)
    assert (got["Update"]["port"], got["Update"]["quantity"], got["Update"]["direction"]) == (12.0, 1000.0, "BUY")
    assert got["Order"]["log_ts"] == datetime(2026, 3, 31, 21, 30, 2, 500000)
    assert (got["Order"]["trade_time"], got["Order"]["security"], got["Order"]["price"]) == ("21:30:00", "ABC CN", 10.25)
    assert got["UNKNOWN"]["raw"] == "some other line"


def test_elapsed_across_days_and_ties(spark):
    stamps = ["2024-01-01 10:00:00", "2024-01-01 10:00:00", "2024-01-03 00:00:01.5", "2024-01-03 00:00:01.75", None]
    df = spark.createDataFrame([(i, datetime.fromisoformat(s) if s else None) for i, s in enumerate(stamps)], "id int, ts timestamp_ntz")
    got = [r["elapsed_s"] for r in elapsed(df, "ts", "id").orderBy("id").collect()]
    assert got == [None, 0.0, 136801.5, 0.25, None]


def test_rollup_takes_first_present_value(spark):
    rows = [(0, "1 - A", "s", None, 5), (1, "1 - B", "s", "x", 6), (2, "1", "s", "y", 7), (3, "2", None, "z", 8)]
    df = spark.createDataFrame(rows, "row_no int, FundID string, Sup string, Other string, Shares long")
    got = position_rollup(df, ["FundID", "Sup"], "row_no", ["Shares"], ["FundID"])
    assert got.columns == ["FundID", "Sup", "Other", "Shares"]
    assert [tuple(r) for r in got.collect()] == [("1", "s", "x", 18)]


def test_routing_first_match_wins(spark):
    feeds = [FeedSpec("a_.*csv", "csv", "one"), FeedSpec("csv$", "csv", "two", load_type="overwrite")]
    df = spark.createDataFrame([("A_1.CSV",), ("b.csv",), ("c.txt",)], "file_name string")
    assert [r["bronze_table"] for r in route(df, feeds).orderBy("file_name").collect()] == ["one", "two", None]
    with pytest.raises(ValueError):
        FeedSpec("x", "csv", "t", load_type="merge")


def test_bronze_checks_and_retry(spark):
    path = workspace(spark, "bronze")
    rows = add_audit(spark.createDataFrame([("1",)], ["a"]), "b1", datetime(2024, 1, 1), "f.csv")
    with pytest.raises(ValueError, match="mode"):
        write_bronze(rows, path, "merge")
    with pytest.raises(TypeError):
        write_bronze([1], path)
    with pytest.raises(ValueError, match="batch_id"):
        write_bronze(rows.drop("batch_id"), path)
    with pytest.raises(ValueError, match="source_file"):
        add_audit(spark.createDataFrame([("1",)], ["a"]), "b1", datetime(2024, 1, 1))
    assert not table_exists(spark, path)
    for _ in range(2):
        write_bronze(rows, path)
    assert read_table(spark, path).count() == 1


def test_lake_run_with_failures(spark, folder):
    inbox = folder / "inbox"
    inbox.mkdir()
    (inbox / "good_1.csv").write_text("Id,Amount\n1,\"1,000\"\n2,x\n")
    (inbox / "good_2.csv").write_text("Amount,Id,Extra\n5,3,e\n")
    (inbox / "clash.csv").write_text("A B,a_b\n1,2\n")
    (inbox / "wide.csv").write_text("A\n" + "1," * 100 + "1\n")
    (inbox / "unknown.bin").write_text("?")
    feeds = [
        FeedSpec("^good", "csv", "good", rename=True, silver=SilverSpec("good", ("id",), {"Id": ColumnMap("int", "id"), "Amount": ColumnMap("float", "amount")})),
        FeedSpec("^clash", "csv", "clash", silver=SilverSpec("clash", ("a_b",))),
        FeedSpec("^wide", "csv", "wide"),
    ]
    lake = Lake(spark, str(folder / "lake"), feeds)
    manifest = {r["file_name"]: r for r in lake.ingest(str(inbox), datetime(2024, 1, 2, 14, 30), "run-1").collect()}
    assert {k: r["status"] for k, r in manifest.items()} == {
        "good_1.csv": "processed", "good_2.csv": "processed", "clash.csv": "processed", "wide.csv": "failed", "unknown.bin": "failed"}
    assert "clash" in manifest["clash.csv"]["error"]
    assert manifest["good_1.csv"]["archive_path"] == "processed/2024/January/02/good_1.csv"
    assert manifest["unknown.bin"]["archive_path"] == "failed/unknown.bin"
    silver = lake.silver_table(feeds[0]).current().orderBy("id").collect()
    assert [(r["id"], r["amount"], r["extra"], r["source_file"]) for r in silver] == [
        (1, 1000.0, None, "good_1_20240102_1430.csv"), (2, None, None, "good_1_20240102_1430.csv"), (3, 5.0, "e", "good_2_20240102_1430.csv")]
    again = {r["file_name"]: r["status"] for r in lake.ingest(str(inbox), datetime(2024, 1, 3), "run-1b").collect()}
    assert again == {"wide.csv": "failed", "unknown.bin": "failed"}  # files taken before are left out
    before = lake.silver_table(feeds[0]).read().count()
    assert lake.replay("run-2")["good"] == "done"
    assert lake.silver_table(feeds[0]).read().count() == before


def test_a_faulty_file_fails_alone(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "part 1.csv").write_text("id,v\n1,a\n")
    (inbox / "part 2.csv").write_text("id,v\n2,b,too,long\n7,c\n")
    (inbox / "part3.csv").write_text("v,id,more\nc,3,m\n")
    (inbox / "loose.csv").write_text("id\n4,5\n")
    feeds = [
        FeedSpec("^part", "csv", "parts", silver=SilverSpec("parts", ("id",))),
        FeedSpec("^loose", "csv", "loose", options={"long_rows": "keep"}),
    ]
    lake = Lake(spark, str(tmp_path / "lake"), feeds)
    got = {r["file_name"]: r for r in lake.ingest(str(inbox), datetime(2024, 1, 2), "run-1").collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        "part 1.csv": "processed", "part 2.csv": "failed", "part3.csv": "processed", "loose.csv": "processed"}
    assert "longer than its header" in got["part 2.csv"]["error"] and got["part3.csv"]["error"] is None
    assert sorted((r["id"], r["v"], r["more"]) for r in lake.silver_table(feeds[0]).current().collect()) == [("1", "a", None), ("3", "c", "m")]
    sources = lake.silver_table(feeds[0]).current().select("source_file").distinct().collect()
    assert {r["source_file"] for r in sources} == {"part 1.csv", "part3.csv"}
    (inbox / "part 2.csv").write_text("id,v\n2,b\n")
    again = lake.ingest(str(inbox), datetime(2024, 1, 3), "run-2").collect()
    assert [(r["file_name"], r["status"]) for r in again] == [("part 2.csv", "processed")]
    assert sorted(r["id"] for r in lake.silver_table(feeds[0]).current().collect()) == ["1", "2", "3"]


def test_decoded_workbooks_go_through_the_lake(spark, tmp_path):
    inbox = tmp_path / "inbox"
    rows = [("Depot.xlsx", 0, ["Code", "Units"]), ("Depot.xlsx", 1, ["a", "3"]), ("Depot.xlsx", 2, ["b", "x"])]
    sheet = spark.createDataFrame(rows, "source_file string, row_no long, cells array<string>")
    sheet.repartition(2).write.parquet(str(inbox / "Depot.xlsx"))
    spec = SilverSpec("depot", ("code",), {"Code": ColumnMap("str", "code"), "Units": ColumnMap("int", "units")})
    lake = Lake(spark, str(tmp_path / "lake"), [FeedSpec(r"^Depot\.xlsx$", "sheet", "depot", silver=spec)])
    got = lake.ingest(str(inbox), datetime(2024, 1, 2), "run-1").collect()
    assert [(r["file_name"], r["status"], r["error"]) for r in got] == [("Depot.xlsx", "processed", None)]
    assert sorted((r["code"], r["units"]) for r in lake.silver_table(lake.feeds[0]).current().collect()) == [("a", 3), ("b", None)]
    assert lake.ingest(str(inbox), datetime(2024, 1, 3), "run-2").count() == 0


def test_commits_name_only_what_they_closed(spark):
    table = SilverTable(spark, workspace(spark, "silver"), SPEC)
    for n, value in enumerate((1, 2, 2, 3)):
        assert table.upsert(frame(spark, [("a", value, 1), ("b", 0, 1)]), f"batch-{n}")
    assert state(table.read()) == [("a", 1, False), ("a", 2, False), ("a", 3, True), ("b", 0, True)]
    assert [len(r["closed"]) for r in table.commits().orderBy("version").collect()] == [0, 1, 0, 1]


def files_of(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def test_an_upsert_touches_only_the_buckets_of_its_keys(spark, folder):
    table = SilverTable(spark, str(folder), SPEC, bucket_rows=20)
    keys = [f"k{i}" for i in range(200)]
    assert table.upsert(frame(spark, [(k, 0, 0) for k in keys]), "0") == {"inserted": 200, "replaced": 0, "skipped": 0, "misfits": {}}
    first, held = files_of(folder), table.directory()
    assert len(held) > 5 and table.last_commit()["buckets"] == 10
    assert table.upsert(frame(spark, [("k7", 5, 1), (None, 1, 1)]), "1") == {"inserted": 0, "replaced": 1, "skipped": 0, "misfits": {}}
    second = files_of(folder)
    assert all(second[f] == t for f, t in first.items()) and len(second) == len(first) + 2
    assert sum(held[b] != f for b, f in table.directory().items()) == 1
    assert state(table.read()) == sorted([("k7", 0, False), ("k7", 5, True), *((k, 0, True) for k in keys if k != "k7")])
    # The replaced bucket goes after the delay, and nothing else.
    assert table.remove_unreferenced() == []
    gone = table.remove_unreferenced(timedelta(seconds=-5))
    assert len(gone) == 1 and set(files_of(folder)) == {f for f in second if not f.startswith(gone[0].removeprefix(f"{folder}/"))}
    assert len(table.read().collect()) == 201


def test_buckets_grow_with_the_table(spark, folder):
    table = SilverTable(spark, str(folder), SPEC, bucket_rows=5)
    for n in range(4):
        table.upsert(frame(spark, [(f"{n}-{i}", n, n) for i in range(25)]), str(n))
    assert [r["buckets"] for r in table.commits().orderBy("version").collect()] == [5, 5, 5, 5]
    for n in range(4, 7):
        table.upsert(frame(spark, [(f"{n}-{i}", n, n) for i in range(25)] + [("0-0", n, n)]), str(n))
    assert table.last_commit()["buckets"] > 5 and table.last_commit()["n_rows"] == 175
    assert sorted(r["k"] for r in table.current().collect()) == sorted(f"{n}-{i}" for n in range(7) for i in range(25))
    assert [r[1] for r in state(table.read()) if r[0] == "0-0"] == [0, 4, 5, 6]


def test_upserts_report_misfits_and_new_columns(spark, folder):
    table = SilverTable(spark, str(folder), SPEC)
    table.upsert(frame(spark, [("a", 1, 1), ("b", 2, 1)]), "0")
    texts = spark.createDataFrame([("a", "x", "n"), ("c", "3", None)], "k string, v string, extra string").withColumn("at", F.lit(2))
    assert table.upsert(texts, "1") == {"inserted": 1, "replaced": 1, "skipped": 0, "misfits": {"v": 1}}
    rows = {(r["k"], r["v"], r["extra"], r["is_current"]) for r in table.read().collect()}
    assert rows == {("a", 1, None, False), ("a", None, "n", True), ("b", 2, None, True), ("c", 3, None, True)}


def test_an_empty_table_takes_rows_later(spark, folder):
    table = SilverTable(spark, str(folder), SPEC)
    assert table.upsert(frame(spark, []), "0") == {"inserted": 0, "replaced": 0, "skipped": 0, "misfits": {}}
    assert table.read().count() == 0 and table.upsert(frame(spark, [("a", 1, 1)]), "1")["inserted"] == 1
    assert state(table.read()) == [("a", 1, True)]


def test_all_elements_of_bulk_entries(spark):
    rows = [("t", [{"Paid": "1"}, {"Kind": "k", "Paid": "2"}]), ("u", [])]
    got = vendor.bulk_rows(spark.createDataFrame(rows, "ticker string, entries array<map<string,string>>"))
    assert got.columns == ["Kind", "Paid", "ticker"]
    assert sorted((r["Paid"], r["Kind"]) for r in got.collect()) == [("1", None), ("2", "k")]


def test_command_line(spark, tmp_path):
    with pytest.raises(SystemExit):
        arguments(["ingest", "--lake", "l", "--client", "c"])
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "nobody.bin").write_text("?")
    lake = ["--lake", str(tmp_path / "lake"), "--client", "Acme"]
    assert main(["ingest", *lake, "--inbox", str(inbox)]) == 1
    assert main(["replay", *lake]) == 0


def test_workspace_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from millrace import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

    class Fake:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.workspace(Fake())


def test_a_task_writes_one_bucket(spark, folder):
    """Else the rows of a task grow with the table: tasks of a hash of the bucket would hold several buckets."""
    table = SilverTable(spark, str(folder), SPEC, bucket_rows=5)
    table.upsert(frame(spark, [(str(i), i, 0) for i in range(100)]), "1")
    written = [p for p in (folder / "rows").rglob("part-*.parquet")]
    assert len({p.name.split("-")[1] for p in written}) == len({p.parent for p in written}) == len(table.directory())
    assert state(table.read()) == sorted((str(i), i, True) for i in range(100))
