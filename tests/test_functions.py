import datetime as dt
import warnings

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions.cells import is_missing, key_text, number
from plumbline.functions.scores import accuracy_score, clamp01, precision_score, shift_for_signs
from plumbline.functions.times import (dated_names, instant, parse_time, range_end, spark_pattern, timestamp)


def values(df, column):
    return [r[0] for r in df.select(column.alias("v")).collect()]


def test_missing_markers(rows):
    df = rows([(None,), ("",), ("null",), ("nan",), ("NaN",), (" ",), ("x",)], "v string")
    assert values(df, is_missing(df, "v")) == [True, True, True, True, False, False, False]
    numbers = rows([(None,), (float("nan"),), (0.0,)], "v double")
    assert values(numbers, is_missing(numbers, "v")) == [True, True, False]
    whole = rows([(None,), (3,)], "v int")
    assert values(whole, is_missing(whole, "v")) == [True, False]


def test_numbers_in_texts(rows):
    texts = ["5", "-5.5", "5,5", "1e5", "0002075900", " 7 ", ".5", "5.", "abc", "12d", "1f", "0x1p3", "nan", "", None,
             "1,2,3", "inf"]
    df = rows([(t,) for t in texts], "x string")
    assert values(df, number(df, "x")) == [5.0, -5.5, 5.5, 1e5, 2075900.0, 7.0, 0.5, 5.0, None, None, None, None, None,
                                           None, None, None, float("inf")]
    assert values(df, number(df, "x", digits_only=True))[:6] == [None, None, 5.5, None, 2075900.0, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.floats(-1e9, 1e9).map(repr), st.text("0123456789eE+-., xdf", max_size=6)), min_size=20, max_size=60))
def test_numbers_read_as_python_reads_them(spark, texts):
    def python_number(text):
        try:
            return float(text.replace(",", "."))
        except ValueError:
            return None
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert values(df, number(df, "x")) == [python_number(t) for t in texts]


def test_odd_column_names(rows):
    df = rows([("a", "1,5")], "`my.key` string, `a number` string")
    assert values(df, number(df, "a number")) == [1.5]
    assert values(df, key_text(["my.key", "a number"])) == ["a,1,5"]


def test_key_text_writes_nulls(rows):
    df = rows([("a", None), (None, 2)], "k string, n int")
    assert values(df, key_text(["k", "n"])) == ["a,null", "null,2"]


def test_patterns():
    assert spark_pattern("%d/%m/%y %H:%M:%S,%f") == "d/M/yy H:m:s,SSSSSS"
    assert spark_pattern("%Y%m%d%H") == "yyyyMMddHH"
    assert spark_pattern("%Y-%m-%dT%H") == "yyyy-M-d'T'H"
    assert spark_pattern("%d %% at 'x'") == "d' % at ''x'''"
    with pytest.raises(ValueError, match="%Q"):
        spark_pattern("%Q")


@pytest.mark.parametrize("time_format,text,expected", [
    ("%d/%m/%y %H:%M:%S,%f", "02/05/17 17:26:30,000000", dt.datetime(2017, 5, 2, 17, 26, 30)),
    ("%d/%m/%y %H:%M:%S,%f", "2/5/17 7:6:3,5", dt.datetime(2017, 5, 2, 7, 6, 3, 500000)),
    ("%d/%m/%y %H:%M:%S,%f", "02/05/69 00:00:00,0", dt.datetime(1969, 5, 2)),
    ("%d/%m/%y %H:%M:%S,%f", "02/05/68 00:00:00,0", dt.datetime(2068, 5, 2)),
    ("%d/%m/%y %H:%M:%S,%f", "31/02/17 00:00:00,0", None),
    ("%d/%m/%y %H:%M:%S,%f", "null", None),
    ("%Y%m%d%H", "2017050215", dt.datetime(2017, 5, 2, 15)),
    ("%Y%m%d%H", "201705021", None),
    ("%Y-%m-%dT%H:%M", "2017-05-02T15:30", dt.datetime(2017, 5, 2, 15, 30)),
    ("doc%Y%m%d", "doc20170502", dt.datetime(2017, 5, 2)),
    ("%d o'clock %m", "02 o'clock 05", dt.datetime(1900, 5, 2)),
    ("%d %b %Y", "02 May 2017", dt.datetime(2017, 5, 2)),
    ("%I:%M %p %d.%m.%Y", "03:05 PM 02.05.2017", dt.datetime(2017, 5, 2, 15, 5)),
    ("%Y/%j", "2017/032", dt.datetime(2017, 2, 1)),
])
def test_parse_like_strptime(rows, time_format, text, expected):
    df = rows([(text,), (None,)], "t string")
    assert values(df, parse_time(F.col("t"), time_format)) == [expected, None]
    if expected is not None:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore", DeprecationWarning)     # a day without a year
            assert dt.datetime.strptime(text, time_format) == expected


def test_timestamp_of_typed_columns(rows):
    df = rows([(dt.datetime(2024, 1, 2, 3), dt.date(2024, 1, 2), "x")], "t timestamp_ntz, d date, s string")
    assert values(df, timestamp(df, "t")) == [dt.datetime(2024, 1, 2, 3)]
    assert values(df, timestamp(df, "d")) == [dt.datetime(2024, 1, 2)]
    with pytest.raises(ValueError, match="format"):
        timestamp(df, "s")


def test_instants(rows):
    df = rows([(1,)], "x int")
    assert values(df, range_end("02/05/2017 17.26.30")) == [dt.datetime(2017, 5, 2, 17, 26, 30)]
    assert values(df, instant("2018-04-03 14:42:17.844840")) == [dt.datetime(2018, 4, 3, 14, 42, 17, 844840)]
    aware = dt.datetime(2018, 4, 3, 14, 42, 17, 5, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert values(df, F.unix_micros(instant(aware))) == [int(aware.timestamp()) * 10**6 + 5]


def test_dated_names():
    assert dated_names("doc%Y%m%d.txt", "doc20170501.txt", "doc20170505.txt", 2) == [
        "doc20170501.txt", "doc20170503.txt", "doc20170505.txt"]
    assert dated_names("doc%Y%m%d.txt", "doc20170501.txt", "doc20170504.txt", 2)[-1] == "doc20170503.txt"
    assert dated_names("doc%Y%m%d.txt", "doc20170505.txt", "doc20170501.txt", 2) == []
    assert dated_names("doc%Y%m%d.txt", "doc20170505.txt", "doc20170504.txt", 7) == []
    assert dated_names("doc%Y%m%d.txt", "nonsense", "doc20170501.txt", 1) == []


def test_scores(rows):
    df = rows([(25.0,), (35.0,), (30.0,), (100.0,), (None,)], "x double")
    assert values(df, accuracy_score(F.col("x"), 25, 20)) == [1.0, 0.0, 0.5, 0.0, None]
    with pytest.raises(ValueError):
        accuracy_score(F.col("x"), 25, 0)
    pairs = rows([(-1.0, 2.0), (0.0, 2.0), (-3.0, -1.0)], "a double, b double")
    assert values(pairs, shift_for_signs(F.col("a"), F.col("b"))) == [1.0, 0.0, 0.0]
    centres = rows([(1.0, 2.0), (3.0, 2.0), (1.0, -4.0), (0.0, 0.0), (None, 1.0)], "s double, m double")
    assert values(centres, precision_score(F.col("s"), F.col("m"))) == [0.5, 0.0, 0.75, None, None]
    assert values(rows([(2.0,), (-1.0,), (0.5,), (None,)], "x double"), clamp01(F.col("x"))) == [1.0, 0.0, 0.5, None]
