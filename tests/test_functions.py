import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from hourgrid.functions import clock, guards
from hourgrid.functions.measures import clip, reindex, truncate_text
from hourgrid.session import session_setting


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("132", 132), ("132.0", 132), ("132.5", 132), ("133.5", 134), ("-1", None), ("1e3", None),
        ("", None), (" 5", None), ("5\n", None), ("abc", None), (None, None), ("99999999999", None),
    ],
)
def test_uint_from_text(spark, text, expected):
    assert one(spark, guards.safe_uint(F.lit(text).cast("string"), StringType())) == expected


def test_doubles_from_text(spark):
    text = F.lit("-3.5")
    assert one(spark, guards.safe_double(text, StringType())) == -3.5
    assert one(spark, guards.safe_udouble(text, StringType())) is None


@pytest.mark.parametrize(
    ("number", "unsigned", "signed"),
    [
        (0.0005, 0.0005, 0.0005), (12345678.5, 12345678.5, 12345678.5), (-0.5, None, -0.5),
        (float("nan"), None, None), (float("inf"), None, None), (float("-inf"), None, None),
    ],
)
def test_doubles_from_numbers(spark, number, unsigned, signed):
    column = F.lit(number).cast("double")
    assert one(spark, guards.safe_udouble(column, DoubleType())) == unsigned
    assert one(spark, guards.safe_double(column, DoubleType())) == signed


def test_uint_from_numbers_rounds_half_even(spark):
    got = [one(spark, guards.safe_uint(F.lit(x), DoubleType())) for x in (132.5, 133.5, 3e10)]
    assert got == [132, 134, None]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2025-01-05 10:00:00", dt.datetime(2025, 1, 5, 10)), ("2025-01-05", dt.datetime(2025, 1, 5)),
        ("05/01/2025", None), ("2025-13-40", None), (None, None),
    ],
)
def test_timestamp_from_text(spark, text, expected):
    assert one(spark, guards.safe_timestamp(F.lit(text).cast("string"), StringType())) == expected


def test_calendar(spark):
    sunday, saturday = clock.ntz("2025-01-05 00:00:00"), clock.ntz("2025-01-04 00:00:00")
    assert [one(spark, clock.day_of_week(d)) for d in (sunday, saturday)] == [0, 6]
    assert [one(spark, clock.day_of_week(d, monday_first=True)) for d in (sunday, saturday)] == [6, 5]
    assert one(spark, clock.is_weekend(sunday)) and one(spark, clock.is_weekend(saturday))
    assert not one(spark, clock.is_weekend(clock.ntz("2025-01-06")))


def test_durations(spark):
    a, b = clock.ntz("2025-01-01 10:00:00"), clock.ntz("2025-01-01 10:01:30.5")
    assert one(spark, clock.duration_minutes(a, b)) == pytest.approx(90.5 / 60)
    assert one(spark, clock.duration_minutes(b, a)) == pytest.approx(-90.5 / 60)
    assert one(spark, clock.duration_seconds(a, b)) == 91
    assert one(spark, clock.duration_seconds(b, a)) == -91
    assert one(spark, clock.speed_mph(F.lit(10.0), F.lit(0))) is None
    assert one(spark, clock.speed_mph(F.lit(10.0), F.lit(1800))) == 20.0


def test_clock_does_not_depend_on_the_session_zone(spark):
    with session_setting(spark, "spark.sql.session.timeZone", "America/New_York"):
        hours = clock.month_hours(clock.as_date("2025-03-01"))
        assert one(spark, F.size(hours)) == 744
        lost = clock.ntz("2025-03-09 02:30:10.25")
        assert one(spark, clock.hour_floor(lost).cast("string")) == "2025-03-09 02:00:00"
        across = clock.duration_minutes(clock.ntz("2025-03-09 01:30:00"), clock.ntz("2025-03-09 04:30:00"))
        assert one(spark, across) == 180.0
        summer = clock.at_time_zone(clock.ntz("2025-07-01 00:00:00"), "America/New_York")
        assert one(spark, F.unix_seconds(summer)) == 1751342400


def test_hour_floor_before_1970(spark):
    assert one(spark, clock.hour_floor(clock.ntz("1969-12-31 23:59:59.9"))) == dt.datetime(1969, 12, 31, 23)


def test_small_helpers(spark):
    assert one(spark, clip(F.lit(-1.0), low=0.0)) == 0.0
    assert one(spark, clip(F.lit(None).cast("double"), low=0.0)) is None
    assert one(spark, truncate_text(F.lit("abcdef"), 3)) == "abc"
    df = reindex(spark.range(1).withColumn("b", F.lit(2.0)), ["b", "missing"], fill=0.0)
    assert df.columns == ["b", "missing"] and tuple(df.first()) == (2.0, 0.0)
