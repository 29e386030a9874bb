import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimweave.functions import (
    clean_date,
    clean_double,
    clean_int,
    clean_long,
    clean_string,
    format_tin,
    md5_hex,
    norm_name,
    pass_years,
    rolling_12_months,
)


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_clean_numbers(spark):
    df = texts(spark, "12", "+7", "-7", "", None, "x", " 5 ", "5.5", "3000000000", "99999999999999999999")
    assert column(df, clean_int("v")) == [12, 7, -7, 0, 0, 0, 0, 0, 0, 0]
    assert column(df, clean_long("v")) == [12, 7, -7, 0, 0, 0, 0, 0, 3000000000, 0]


def test_clean_double(spark):
    df = texts(spark, "1.5", "", None, "x", " 2.5 ", "1e3")
    assert column(df, clean_double("v")) == [1.5, 0.0, 0.0, 0.0, 2.5, 1000.0]


def test_clean_string_and_name(spark):
    df = texts(spark, None, "", " Ab ")
    assert column(df, clean_string("v")) == ["", "", " Ab "]
    assert column(df, norm_name("v")) == [None, "", "AB"]


def test_clean_date(spark):
    lenient = texts(spark, "32/01/2018", "05/03/2018 10:00", "5/3/2018", "01/13/2018")
    read = column(lenient, clean_date("v", "dd/MM/yyyy"))
    assert read == [dt.date(2018, 2, 1), dt.date(2018, 3, 5), dt.date(2018, 3, 5), dt.date(2019, 1, 1)]
    df = texts(spark, "31/12/2018", "2018-12-31", "", None)
    unreadable = dt.date(7777, 1, 1)
    assert column(df, clean_date("v", "dd/MM/yyyy")) == [dt.date(2018, 12, 31), unreadable, unreadable, unreadable]


def test_md5(spark):
    assert column(texts(spark, "abc", None), md5_hex("v")) == ["900150983cd24fb0d6963f7d28e17f72", None]


@pytest.mark.parametrize(
    "tin, reference, padded",
    [
        (None, None, None),
        (7, "0-07", "00-0000007"),
        (123456, "0-0123456", "00-0123456"),
        (1234567, "0-1234567", "00-1234567"),
        (12345678, "01-2345678", "01-2345678"),
        (123456789, "12-3456789", "12-3456789"),
        (1234567890, "1234567890", "1234567890"),
    ],
)
def test_format_tin(spark, tin, reference, padded):
    df = spark.createDataFrame([(tin,)], "tin bigint")
    assert df.select(format_tin("tin"), format_tin("tin", "padded")).first() == (reference, padded)


def test_rolling_12_months(spark):
    days = ["2017-06-30", "2017-07-01", "2018-06-30", "2018-07-01"]
    df = texts(spark, *days).select(F.col("v").cast("date").alias("d"))
    assert column(df, rolling_12_months("d", "2018-07-31")) == [False, True, True, False]
    assert column(df, rolling_12_months("d", dt.date(2018, 7, 1))) == [False, True, True, False]


def test_pass_years():
    assert pass_years("2018-07-31") == (2018, 2017, 2016)
