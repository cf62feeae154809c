"""Readers and cleaning steps on small tables with known answers."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import parse
from keelson.operators import clean


def read(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_money(spark):
    raw = ["$999", "450000", "  $450,000  ", "$450,000.50", "-5", None, "", "   ", "Not number",
           "$", "call for price", "1e5", "\t$1 000\n"]
    assert read(spark, parse.money, raw) == [
        999.0, 450000.0, 450000.0, 450000.5, -5.0, None, None, None, None, None, None, None, 1000.0]


def test_boolean(spark):
    raw = ["Yes", "No", "Y", "N", "1", "0", "True", "False", "yes", "NO", "  Y  ", "t", "f",
           None, "", "maybe", "2", "1.0"]
    assert read(spark, parse.boolean, raw) == [
        True, False, True, False, True, False, True, False, True, False, True, True, False,
        None, None, None, None, None]


def test_day_reads_three_shapes_and_never_day_first(spark):
    raw = ["2023-07-15", "07/15/2023", "15-Jul-2023", "  2023-07-15  ", "01/02/2023", "03-Mar-2020",
           "20/09/2026", "2023-13-45", "2023-02-29", "not a date", "", None, "2023-jul-15",
           "15-Jux-2023", "2023-07-15T00:00:00", "7/5/2023"]
    assert read(spark, parse.day, raw) == [
        date(2023, 7, 15)] * 4 + [date(2023, 1, 2), date(2020, 3, 3)] + [None] * 9 + [date(2023, 7, 5)]


def test_zipcode_invents_no_zero(spark):
    raw = ["90210", "  90210  ", "02134", "9021", "902101", "abcde", "", None]
    assert read(spark, parse.zipcode, raw) == ["90210", "90210", "02134"] + [None] * 5


def test_zipcode_from_numbers(spark):
    df = spark.createDataFrame([(94107.0, 90210), (2134.0, 2134), (94107.5, 1)], "d double, n int")
    got = df.select(clean.read_as("zipcode", F.col("d"), T.DoubleType()),
                    clean.read_as("zipcode", F.col("n"), T.IntegerType())).collect()
    assert [tuple(r) for r in got] == [("94107", "90210"), (None, None), (None, None)]


def test_words(spark):
    raw = ["NEW YORK", "New_York", "  New York  ", "New-York", "Multi-Family", "New   York",
           "new \t york", "___", "   ", None, "CA"]
    assert read(spark, parse.words, raw) == ["new york"] * 4 + [
        "multi family", "new york", "new york", None, None, None, "ca"]


def test_number_refuses_suffixes(spark):
    raw = ["1", "-1.5", "1e3", " 3 ", "1d", "1f", "n/a", "", None, ".5", "5."]
    assert read(spark, parse.number, raw) == [
        1.0, -1.5, 1000.0, 3.0, None, None, None, None, None, 0.5, 5.0]


def test_moments_convert_offsets(spark):
    raw = ["2026-09-20T23:30:00+02:00", "2021-01-01", "2026-09-20T23:30:00", "junk", None]
    assert read(spark, parse.moment, raw) == [
        datetime(2026, 9, 20, 21, 30), datetime(2021, 1, 1), datetime(2026, 9, 20, 23, 30), None, None]


def test_text_of_doubles_equals_python(spark):
    values = [250000.0, 1e7, 12345678.9, 0.0001, 0.00012345, 1e16, 1.5e17, 1e-5, 1.25e-12, 0.0,
              -12345678.0, 0.1, 1e100]
    got = read(spark, lambda c: parse.as_text(c, T.DoubleType()), values, "double")
    assert got == [str(v) for v in values]


def test_text_of_booleans_and_missing(spark):
    assert read(spark, lambda c: parse.as_text(c, T.BooleanType()), [True, False, None],
                "boolean") == ["True", "False", None]


def test_levels_put_both_lines_into_warning(spark):
    assert read(spark, lambda c: parse.level(c, 5.0, 20.0), [4.9, 5.0, 20.0, 20.1], "double") == [
        "ok", "warning", "warning", "high"]


def test_clip_keeps_missing(spark, spec):
    df = spark.createDataFrame([("-1",), ("3",), ("999",), ("n/a",), (None,)], "bedrooms string")
    assert [r[0] for r in clean.clip_outliers(df, spec).collect()] == [0.0, 3.0, 20.0, None, None]


def test_clip_treats_nan_as_missing(spark):
    got = read(spark, lambda c: parse.clip(c, 0, 1), [float("nan"), 2.0, -1.0, None], "double")
    assert got == [None, 1.0, 0.0, None]


def test_clean_table_keeps_rows_extras_and_skips_absent(spark, spec):
    df = spark.createDataFrame(
        [("$450,000", "NEW_YORK", "Yes", "09/20/2026", "kept as-is")],
        "list_price string, city string, has_pool string, listing_date string, note string")
    row = clean.clean_table(df, spec).first()
    assert row.asDict() == {"list_price": 450000.0, "city": "new york", "has_pool": True,
                            "listing_year": 2026, "listing_month": 9, "note": "kept as-is"}


def test_blank_is_not_null_until_asked(spark):
    df = spark.createDataFrame([("boston", 1), ("", 2), ("   ", 3)], "city string, n int")
    assert [r[0] for r in clean.blanks_as_null(df).orderBy("n").collect()] == ["boston", None, None]


def test_select_columns_adds_and_drops(spark):
    df = spark.createDataFrame([("boston", 1)], "city string, sale_price int")
    out = clean.select_columns(df, ["bedrooms", "city"])
    assert out.columns == ["bedrooms", "city"]
    assert tuple(out.first()) == (None, "boston")


def test_features_by_task(spec):
    assert "condition" in spec.features("regression")
    assert not {"sale_price", "list_price", "price_category", "property_id"} & set(
        spec.features("regression"))
    assert "condition" not in spec.features("classification")
    numeric, categorical = spec.encoded_features("regression")
    assert numeric[-2:] == ["listing_year", "listing_month"]
    assert categorical == ["city", "state", "zipcode", "property_type", "condition"]
    assert spec.of_kind("money") == ["list_price", "sale_price"]
    assert spec.of_kind("nonsense") == []
    with pytest.raises(ValueError):
        spec.features("ranking")


def test_classification_label_prefers_the_observed_one(spark, spec):
    df = spark.createDataFrame(
        [("Poor", None), ("GOOD", None), ("fair", "False"), ("unknown", None), ("good", "True")],
        "condition string, needs_renovation string")
    got = [r[0] for r in df.select(clean.task_label(df, spec, "classification")).collect()]
    assert got == [True, False, False, None, True]


def test_label_needs_its_source(spark, spec):
    with pytest.raises(KeyError):
        clean.task_label(spark.createDataFrame([("x",)], "city string"), spec, "regression")


def test_feedback_rows_without_moment_are_an_error(spark, spec):
    df = spark.createDataFrame([("p1", "2020-01-01", "feedback")],
                               "property_id string, listing_date string, record_source string")
    with pytest.raises(Exception, match="predicted_at"):
        df.select(clean.event_day(df, spec)).collect()
