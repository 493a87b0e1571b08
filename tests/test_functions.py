import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martforge.functions import (after_colon, calendar_columns, cell_number, concat_key, half_even, ratio,
                                 serial_to_date, strip_copy_suffix, strip_unit, zfill)
from martforge.functions.mathx import half_even_float
from martforge.functions.text import header_without_copy_suffix, header_without_unit


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_half_even_decimal(spark):  # Q1
    got = one(spark, half_even(F.col("x"), 2), [(Decimal("0.125"),), (Decimal("0.375"),), (Decimal("2.5"),)],
              "x decimal(10,3)")
    assert got == [Decimal("0.12"), Decimal("0.38"), Decimal("2.50")]
    assert one(spark, half_even(F.col("x"), 0), [(Decimal("2.5"),), (Decimal("3.5"),)], "x decimal(5,1)") == [
        Decimal("2"), Decimal("4")]


def test_half_even_float(spark):
    got = one(spark, half_even_float(F.col("x"), 2), [(0.125,), (0.375,), (2.675,)], "x double")
    assert got == [0.12, 0.38, 2.68]


def test_zfill_never_truncates(spark):  # Q2
    got = one(spark, zfill(F.col("s"), 4), [("7",), ("123",), ("12345",)], "s string")
    assert got == ["0007", "0123", "12345"]


def test_week_labels(spark):  # Q3
    df = spark.createDataFrame(
        [(dt.date(2016, 1, 1),), (dt.date(2017, 1, 1),), (dt.date(2014, 12, 29),), (dt.date(2016, 6, 15),)], "d date")
    legacy = df.withColumns(calendar_columns("d", "x"))
    rows = {r.d: r for r in legacy.collect()}
    assert rows[dt.date(2016, 1, 1)].week == "53" and rows[dt.date(2016, 1, 1)].x_week == "2015 53"
    # week 52 in January keeps the calendar year in the legacy label
    assert rows[dt.date(2017, 1, 1)].x_week == "2017 52"
    # week 01 in December keeps the calendar year in the legacy label
    assert rows[dt.date(2014, 12, 29)].x_week == "2014 01"
    assert rows[dt.date(2016, 6, 15)].x_month == "2016 06"
    iso = {r.d: r.x_week for r in df.withColumns(calendar_columns("d", "x", iso=True)).collect()}
    assert iso[dt.date(2017, 1, 1)] == "2016 52" and iso[dt.date(2014, 12, 29)] == "2015 01"
    unpadded = df.withColumns(calendar_columns("d", "x", padded=False)).collect()
    assert {r.x_month for r in unpadded} >= {"2016 1", "2016 6"}


def test_missing_tokens_leave_text_unchanged(spark):  # Q6
    assert one(spark, strip_unit(F.col("s")), [("Corn (lb)",), ("Corn",)], "s string") == ["Corn", "Corn"]
    assert one(spark, after_colon(F.col("s")), [("Group: G1",), ("G1",)], "s string") == ["G1", "G1"]
    assert header_without_unit("Soy (bu)") == "Soy" and header_without_unit("Soy") == "Soy"


def test_copy_suffixes(spark):  # Q7
    got = one(spark, strip_copy_suffix(F.col("s")), [("Corn.1",), ("Corn.2",), ("Corn.3",), ("Corn.4",)], "s string")
    assert got == ["Corn", "Corn", "Corn", "Corn.4"]
    assert header_without_copy_suffix("Corn.4", r"\.\d+$") == "Corn"


def test_cell_number(spark):  # Q8
    data = [("-5",), ("",), ("-",), ("12.5",), ("abc",), (None,)]
    got = one(spark, cell_number(F.col("s")), data, "s string")
    assert got[:4] == [Decimal(0), Decimal(0), Decimal(0), Decimal("12.5")]
    assert got[4] is None
    kept = one(spark, cell_number(F.col("s"), clip_negative=False), data[:1], "s string")
    assert kept == [Decimal("-5")]


def test_zero_denominators(spark):  # Q9
    got = one(spark, ratio(F.col("a"), F.col("b")), [(0.0, 0.0), (3.0, 0.0), (3.0, 2.0)], "a double, b double")
    assert got == [None, None, 1.5]


def test_concat_propagates_null(spark):  # F1
    got = one(spark, concat_key(F.col("a"), F.col("b"), sep="-"), [("1", "x"), ("1", None)], "a string, b string")
    assert got == ["1-x", None]


def test_serial_dates(spark):  # F11
    assert one(spark, serial_to_date(F.col("s")), [("42370",), ("",)], "s string") == [dt.date(2016, 1, 1), None]
