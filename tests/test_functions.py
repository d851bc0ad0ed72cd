import datetime as dt
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ombuds.functions.casts import try_date, try_timestamp
from ombuds.functions.dates import day_of_week, hours_between, month_name, seconds_between, years_between
from ombuds.functions.keys import surrogate_key

T = dt.datetime

TIMESTAMPS = {
    "2025-01-02 03:04:05": T(2025, 1, 2, 3, 4, 5),
    "2025-01-02T03:04:05.123456": T(2025, 1, 2, 3, 4, 5, 123456),
    "2025-01-02": T(2025, 1, 2),
    "2025-01-02 10:00:00+02:00": T(2025, 1, 2, 10),
    "11/20/2025": T(2025, 11, 20),
    "1/5/2025 7:08:09": T(2025, 1, 5, 7, 8, 9),
    "5-Jan-2025": T(2025, 1, 5),
    "1700000000": T(2023, 11, 14, 22, 13, 20),
    "1700000000123": T(2023, 11, 14, 22, 13, 20, 123000),
    "1700000000123456": T(2023, 11, 14, 22, 13, 20, 123456),
    "1700000000123456789": T(2023, 11, 14, 22, 13, 20, 123456),
    "99999999999999999999999": None,
    "2025-13-01": None,
    "2025-02-30 00:00:00": None,
    "bad-ts": None,
    "": None,
    "2025-11": None,
    None: None,
}
DATES = {
    "2025-11-20": dt.date(2025, 11, 20),
    "2025-11-20 23:59:59": dt.date(2025, 11, 20),
    "11/20/2025": dt.date(2025, 11, 20),
    "20-Nov-2025": dt.date(2025, 11, 20),
    "2025-02-30": None,
    "not-a-date": None,
    "13/45/2025": None,
    None: None,
}


@pytest.mark.parametrize("cast,expected", [(try_timestamp, TIMESTAMPS), (try_date, DATES)])
def test_tolerant_casts(spark, cast, expected):
    df = spark.createDataFrame([(text,) for text in expected], "s string")
    found = {row.s: row.v for row in df.select("s", cast("s").alias("v")).collect()}
    assert found == expected


def test_timestamp_has_no_zone(spark):
    df = spark.createDataFrame([("2025-01-02",)], "s string").select(try_timestamp("s").alias("v"))
    assert dict(df.dtypes)["v"] == "timestamp_ntz"


BOUNDARIES = [
    # start, end, seconds, hours
    (T(2025, 1, 1, 10, 59, 59), T(2025, 1, 1, 11, 0, 1), 2, 1),
    (T(2025, 1, 1, 0, 0, 0, 900000), T(2025, 1, 1, 0, 0, 1, 100000), 1, 0),
    (T(2025, 1, 1, 11, 1), T(2025, 1, 1, 10, 59), -120, -1),
    (T(2024, 12, 31, 23, 59), T(2025, 1, 1, 0, 1), 120, 1),
    (T(1969, 12, 31, 23, 30), T(1970, 1, 1, 0, 30), 3600, 1),
    (None, T(2025, 1, 1), None, None),
]


def test_boundary_differences(spark):
    df = spark.createDataFrame([row[:2] for row in BOUNDARIES], "a timestamp_ntz, b timestamp_ntz")
    found = df.select(seconds_between("a", "b"), hours_between("a", "b")).collect()
    assert [tuple(row) for row in found] == [row[2:] for row in BOUNDARIES]


def test_differences_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(T(2025, 3, 30, 0, 30), T(2025, 3, 30, 3, 30))], "a timestamp_ntz, b timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert tuple(df.select(seconds_between("a", "b"), hours_between("a", "b")).first()) == (10800, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(*[st.datetimes(T(1900, 1, 1), T(2100, 1, 1))] * 2), min_size=20, max_size=60))
def test_seconds_equal_floor_difference(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    cut = [tuple(value.replace(microsecond=0) for value in pair) for pair in pairs]
    expected = [int((b - a).total_seconds()) for a, b in cut]
    assert [row[0] for row in df.select(seconds_between("a", "b")).collect()] == expected


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2000, 12, 31), dt.date(2001, 1, 1))], "a date, b date")
    row = df.select(years_between("a", "b"), month_name("a"), day_of_week("a"), day_of_week("b")).first()
    assert tuple(row) == (1, "Dec", 0, 1)


def test_surrogate_key(spark):
    df = spark.createDataFrame([("7", "Web Form"), (None, "Web Form")], "id string, channel string")
    found = [row[0] for row in df.select(surrogate_key("id", F.col("channel"))).collect()]
    texts = ["7-Web Form", "_dbt_utils_surrogate_key_null_-Web Form"]
    assert found == [hashlib.md5(text.encode()).hexdigest() for text in texts]
