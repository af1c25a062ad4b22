from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import ColumnMap, SilverSpec, column_map, column_maps_from_text
from millrace.functions import casts, names, text
from millrace.operators import cleaning

METER = {
    "No": ColumnMap("int", "meter"),
    "Reading": ColumnMap("float", "kwh"),
    "Pulses": ColumnMap("int", "pulses"),
    "Sealed": ColumnMap("bool", "sealed"),
    "Loss": ColumnMap("pct", "loss"),
    "Read on": ColumnMap("datetime", "read_on", "%d.%m.%Y"),
    "Place": ColumnMap("str", "place"),
}


@pytest.fixture
def meters(spark):
    rows = [
        ("11", "7.25", "1234567890123456789", "yes", "3.5%", "09.02.2023", " Cellar ", "p"),
        ("12", "12,345.5", "6,001", "0", "125", "31.07.2022", "Roof", "q"),
        ("13", "n/k", "many", "maybe", "%", "31.02.2023", None, "r"),
        ("14", None, "99999999999999999999", "TRUE", "-1%", None, "", "s"),
    ]
    return spark.createDataFrame(rows, [*METER, "left_alone"])


def test_all_types(meters):
    rows = cleaning.clean_and_cast(meters, METER).orderBy("meter").collect()
    assert [r["kwh"] for r in rows] == [7.25, 12345.5, None, None]
    assert [r["pulses"] for r in rows] == [1234567890123456789, 6001, None, None]
    assert [r["sealed"] for r in rows] == [True, False, None, True]
    assert [r["loss"] for r in rows] == [0.035, 1.25, None, -0.01]
    assert [r["place"] for r in rows] == ["Cellar", "Roof", None, None]
    assert [r["left_alone"] for r in rows] == list("pqrs")


def test_dates_are_midnight_of_the_zone(meters):
    rows = cleaning.clean_and_cast(meters, METER).orderBy("meter").select(F.unix_seconds("read_on").alias("s")).collect()
    winter, summer = (dt.timezone(dt.timedelta(hours=h)) for h in (-5, -4))
    want = [dt.datetime(2023, 2, 9, tzinfo=winter), dt.datetime(2022, 7, 31, tzinfo=summer), None, None]
    assert [r["s"] for r in rows] == [int(w.timestamp()) if w else None for w in want]


def test_dates_do_not_depend_on_the_session_zone(spark, meters):
    seconds = cleaning.clean_and_cast(meters, METER).select(F.unix_seconds("read_on").alias("s"))
    utc = sorted(r["s"] for r in seconds.collect() if r["s"])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert sorted(r["s"] for r in seconds.collect() if r["s"]) == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_loss_audit(meters):
    loss = {r["column"]: (r["lost"], r["empty"]) for r in cleaning.cast_loss(meters, METER).collect()}
    assert loss == {
        "kwh": (1, 0), "pulses": (2, 0), "sealed": (1, 0), "loss": (1, 0), "read_on": (1, 0), "place": (1, 1),
    }


def test_loss_samples_are_few_and_distinct(spark):
    df = spark.range(1000).select((F.col("id") % 9).cast("string").alias("v")).select(F.concat(F.lit("x"), "v").alias("v"))
    row = cleaning.cast_loss(df, {"v": ColumnMap("int", "v")}).first()
    assert (row["lost"], row["samples"]) == (1000, ["x0", "x1", "x2", "x3", "x4"])


def test_identifiers_keep_ingested_at(spark):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("ABC", "bad_cusip", "100", at, " source1 "), ("XYZ", "", "not_int", at, "'")],
        "`ss id` string, id_cusip string, dda string, ingested_at timestamp, extra_metadata string",
    )
    out = cleaning.clean_and_cast(df, {"dda": ColumnMap("int", "dda_id")})
    assert out.schema["ingested_at"].dataType == T.TimestampType()
    assert [tuple(r) for r in out.drop("ingested_at").orderBy("ss_id").collect()] == [
        ("ABC", "bad_cusip", 100, "source1"), ("XYZ", None, None, None)]


def test_exact_duplicates_go_first(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "x"), ("1 ", "x")], ["a", "b"])
    assert cleaning.clean_and_cast(df, {"a": ColumnMap("int", "a")}).count() == 2


def test_types_pass_through(spark):
    df = spark.createDataFrame([(1.5, 7, True, dt.datetime(2024, 1, 1))], "f double, i int, b boolean, t timestamp")
    spec = {"f": ColumnMap("float", "f"), "i": ColumnMap("int", "i"), "b": ColumnMap("bool", "b"), "t": ColumnMap("datetime", "t", "%Y")}
    assert tuple(cleaning.clean_and_cast(df, spec).first()) == (1.5, 7, True, dt.datetime(2024, 1, 1))


def test_unknown_type_and_clash_raise(spark):
    df = spark.createDataFrame([("1", "2")], ["A B", "a_b"])
    with pytest.raises(ValueError, match="unknown type"):
        cleaning.clean_and_cast(df, {"zzz": ColumnMap("money", "m")})
    with pytest.raises(ValueError, match="clash"):
        cleaning.clean_and_cast(df, {})
    with pytest.raises(ValueError):
        casts.converter("money")


@pytest.mark.parametrize(
    ("value", "want"),
    [("  'abc  ", "abc"), ("' x", " x"), ("''", None), ("　\xa0x\t", "x"), ("'", None), ("", None), ("N/A", "N/A"), (None, None)],
)
def test_tidy(spark, value, want):
    assert spark.createDataFrame([(value,)], "v string").select(casts.tidy(F.col("v"))).first()[0] == want


@pytest.mark.parametrize(
    ("value", "want"),
    [("1,234.5", 1234.5), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("-7", -7.0), ("1.0d", None), ("1f", None), ("0x1p3", None),
     ("$789.00", None), ("nan", None), ("inf", float("inf")), ("1 2", None), ("'12", 12.0)],
)
def test_float(spark, value, want):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(casts.to_float(F.col("v"), T.StringType(), None)).first()[0] == want


@pytest.mark.parametrize(
    ("value", "want"),
    [("2.5", 2), ("3.5", 4), ("-2.5", -2), ("9007199254740993", 9007199254740993), ("inf", None), ("1e30", None), ("1,000", 1000)],
)
def test_int_rounds_half_to_even(spark, value, want):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(casts.to_int(F.col("v"), T.StringType(), None)).first()[0] == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=8), min_size=1, max_size=40))
def test_tidy_agrees_with_python(spark, values):
    got = spark.createDataFrame([(v,) for v in values], "v string").select(casts.tidy(F.col("v"))).collect()
    assert [r[0] for r in got] == [v.strip().lstrip("'") or None for v in values]


@pytest.mark.parametrize(
    ("layout", "want"),
    [("%Y%m%d", "yyyyMMdd"), ("%m/%d/%Y", "M/d/yyyy"), ("%Y-%m-%d", "yyyy-M-d"), ("%d %b %Y %H:%M:%S", "d MMM yyyy H:m:s")],
)
def test_layouts(layout, want):
    assert casts.spark_layout(layout) == want


def test_layout_of_mainframe_stamp(spark):
    m = ColumnMap("datetime", "t", "%d %b %Y %H:%M:%S")
    df = spark.createDataFrame([("05 JAN 2024 9:05:00",), ("2024015",)], "v string")
    got = df.select(F.date_format(casts.to_datetime(F.col("v"), T.StringType(), m), "yyyy-MM-dd HH:mm")).collect()
    assert [r[0] for r in got] == ["2024-01-05 14:05", None]


def test_snake_case_rules():
    assert names.snake_case("Shares/Par Value") == "shares_par_value"
    assert names.snake_case("$ Change NAV") == "_change_nav"
    assert names.snake_case("Ex-Date") == "ex_date"
    assert names.snake_case("SUPPLEMENTAL_ID_1 ") == "supplemental_id_1"
    assert names.plain_snake_case("Fund Code") == "fund_code"
    assert names.plain_snake_case("Position-ID") == "position_id"
    assert names.plain_snake_case("Shares/Par Value") == "sharespar_value"


def test_inference_of_types(spark):
    df = spark.createDataFrame([("20260220", "1,000", "  'abc  "), ("2026-02-21", "2000", "def")], ["date_col", "num_col", "name"])
    assert cleaning.infer_types(df) == {"date_col": "datetime", "num_col": "int", "name": "str"}
    rows = cleaning.clean_inferred(df).orderBy("date_col").collect()
    assert [tuple(r) for r in rows] == [(dt.date(2026, 2, 20), 1000, "abc"), (dt.date(2026, 2, 21), 2000, "def")]


def test_inference_with_null_words_and_quotes(spark):
    df = spark.createDataFrame([("100", "valid", "'quoted"), ("N/A", "NULL", "normal"), ("null", "N/A", "x")], ["value", "text", "q"])
    rows = cleaning.clean_inferred(df).collect()
    assert [tuple(r) for r in rows] == [(100, "valid", "quoted"), (None, None, "normal"), (None, None, "x")]


def test_declared_types_with_currency(spark):
    df = spark.createDataFrame([("20260220", "1,234.56", "10"), ("2026-02-21", "$789.00", "20"), ("30/30/2026", "x", "'5")], ["D", "NAV", "COUNT"])
    rows = cleaning.clean_inferred(df, {"D": "datetime", "NAV": "float"}).collect()
    assert [tuple(r) for r in rows] == [
        (dt.date(2026, 2, 20), 1234.56, 10), (dt.date(2026, 2, 21), 789.0, 20), (None, None, 5)]


def test_text_functions(spark):
    row = spark.range(1).select(
        text.split_part(F.lit("a/b"), "/", 2).alias("second"), text.split_part(F.lit("a"), "/", 2).alias("none"),
        text.split_part(F.lit("a.b"), ".", 1).alias("literal"), text.before_dash(F.lit("12 - PB")).alias("dash"),
        text.fund_code(F.lit("'HXT.U")).alias("code"), text.field_value(F.lit('NAME = "x = y"\n')).alias("field"),
        text.stamped_name(F.lit("a.b.csv"), F.lit("2024-01-02 09:30:00").cast("timestamp")).alias("stamp"),
        text.stamped_name(F.lit("plain"), F.lit("2024-01-02 09:30:00").cast("timestamp")).alias("bare"),
    ).first()
    assert tuple(row) == ("b", None, "a", "12", "HXT/U", "x = y", "a.b_20240102_0930.csv", "plain_20240102_0930")


def test_column_map_notation():
    got = column_map("`Trade Date`→trade_date:datetime[%m/%d/%Y]; ` Side`→quantity:int")
    assert got == {"Trade Date": ColumnMap("datetime", "trade_date", "%m/%d/%Y"), " Side": ColumnMap("int", "quantity")}
    with pytest.raises(ValueError, match="unknown type"):
        column_map("`A`→b:money")


def test_every_documented_feed_maps():
    from millrace.feeds import catalogue

    maps = column_maps_from_text((Path(__file__).parent.parent / "FIXTURES.md").read_text(encoding="utf-8").splitlines())
    feeds = catalogue("Acme", maps)
    assert len(feeds) == 33
    assert sum(f.silver is not None for f in feeds) == 31
    typed = [f for f in feeds if f.silver and f.silver.columns]
    assert len(typed) == 29  # one feed maps nothing, one is listed under the client's own name
    for f in typed:
        for m in f.silver.columns.values():
            assert m.dtype in casts.CONVERTERS
            if m.dtype == "datetime":
                casts.spark_layout(m.datetime_format)


def test_spec_records():
    assert SilverSpec("t", "id").primary_keys == ("id",)
    with pytest.raises(ValueError):
        SilverSpec("t", ("id",), table_type="other")
