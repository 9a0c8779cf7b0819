import datetime

import pytest
from pyspark.sql import functions as F

from orelode.functions import parsing


def read(spark, function, *values):
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    return [row[0] for row in frame.select(function(F.col("v"))).collect()]


def test_integers_are_digits_only(spark):
    values = ["12", "-3", "+4", "", " 12 ", "12.5", "x", "99999999999999999999", None]
    assert read(spark, parsing.safe_integer, *values) == [
        12, -3, 4, None, None, None, None, None, None,
    ]


def test_doubles(spark):
    values = ["1.5", "-5.5", "0", " 2.5 ", ".5", "5.", "1e3", "n/a", "", "NaN", None]
    assert read(spark, parsing.safe_double, *values) == [
        1.5, -5.5, 0.0, 2.5, 0.5, 5.0, 1000.0, None, None, None, None,
    ]


def test_only_finite_numbers_in_digits_are_doubles(spark):
    values = ["Infinity", "-Infinity", "inf", "5d", "5f", "5D", "1e400", "1e15", "0x1p3", "1_000"]
    assert read(spark, parsing.safe_double, *values) == [None] * len(values)


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Europe/Paris"])
def test_timestamps_are_strict_and_zone_free(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        good = "2026-03-29 02:30:00"
        bad = ["", "31/02/2026", "2026-02-31 00:00:00", "2026-1-05 00:00:00", "2026-01-05",
               "2026-01-05 00:00:00 ", "2026-01-05 00:00:0Z", "2026-01-05 25:00:00", None]
        found = read(spark, parsing.safe_timestamp, good, *bad)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [datetime.datetime(2026, 3, 29, 2, 30)] + [None] * len(bad)


def test_further_date_formats(spark):
    found = read(
        spark, lambda c: parsing.safe_timestamp(c, ["dd/MM/yyyy"]), "28/02/2026", "31/02/2026"
    )
    assert found == [datetime.datetime(2026, 2, 28), None]


def test_spelling_key_trims_all_white_space(spark):
    assert read(spark, parsing.spelling_key, "\t France \n", "U.K.", None) == [
        "france", "u.k.", None,
    ]


def test_results_do_not_depend_on_ansi_mode(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert read(spark, parsing.safe_integer, "12.5", "7") == [None, 7]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_plain_numbers_are_read_like_others(spark):
    values = ["7", "12.50", "123456789.123456789", "1234567890", "12\n", "12\u0085", "1.2.3", ".", "٣", "+1", "1."]
    expected = [7.0, 12.5, 123456789.123456789, 1234567890.0, 12.0, None, None, None, None, 1.0, 1.0]
    assert read(spark, parsing.safe_double, *values) == expected
    text = spark.createDataFrame([], "v string").select(parsing.safe_double(F.col("v")))._jdf.queryExecution()
    assert parsing.PLAIN_NUMBER in text.optimizedPlan().toString()
