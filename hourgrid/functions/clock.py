"""Calendar arithmetic on zone-less timestamps.

Nothing here depends on the session time zone: no step goes through an
instant, so hours are neither lost nor repeated when clocks change.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIX_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def ntz(value: Column | str | dt.datetime | dt.date) -> Column:
    """A zone-less timestamp column from a column, text, date or datetime."""
    return (value if isinstance(value, Column) else F.lit(str(value))).cast("timestamp_ntz")


def instant(value: Column | str | dt.datetime) -> Column:
    """A point in time. Text and zone-less datetimes are read in the session zone."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return F.timestamp_micros(F.lit((value - UNIX_EPOCH) // dt.timedelta(microseconds=1)))
    return F.lit(str(value)).cast("timestamp")


def as_date(value: Column | str | dt.date) -> Column:
    return (value if isinstance(value, Column) else F.lit(str(value))).cast("date")


def add_hours(ts: Column, hours: int | Column) -> Column:
    hours = hours if isinstance(hours, Column) else F.lit(hours)
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"))


def hour_floor(ts: Column) -> Column:
    """Start of the hour, still without a zone."""
    return ts - F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts), F.date_part(F.lit("SECOND"), ts)
    )


def month_floor(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "MM")


def hours_between(start: Column, end_inclusive: Column) -> Column:
    """Array of every hour from ``start`` to ``end_inclusive``."""
    return F.sequence(start, end_inclusive, F.expr("interval 1 hour"))


def month_hours(month: Column) -> Column:
    """Array of every hour of the month that starts at ``month``."""
    return hours_between(ntz(month), add_hours(ntz(F.add_months(month, 1)), -1))


def _exact_seconds(start: Column, end: Column) -> Column:
    return (end - start).cast("interval second").cast("decimal(18,6)")


def lasts_between(start: Column, end: Column, above: float, at_most: float) -> Column:
    """Is the duration over ``above`` and at most ``at_most`` seconds, to the microsecond?

    Compares intervals, which is integer arithmetic; cheaper in a filter than
    computing the minutes once per comparison.
    """
    length = end - start

    def seconds(n: float) -> Column:
        return F.make_dt_interval(secs=F.lit(n).cast("decimal(18,6)"))

    return (length > seconds(above)) & (length <= seconds(at_most))


def duration_minutes(start: Column, end: Column) -> Column:
    """Fractional minutes, exact to the microsecond; negative when reversed."""
    return _exact_seconds(start, end).cast("double") / 60.0


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds, half away from zero."""
    return F.round(_exact_seconds(start, end), 0).try_cast("int")


def speed_mph(distance: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, distance / (seconds / 3600.0))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("short")


def day_of_week(ts: Column, monday_first: bool = False) -> Column:
    """Sunday=0 … Saturday=6, or Monday=0 … Sunday=6."""
    return (F.weekday(ts) if monday_first else F.dayofweek(ts) - 1).cast("short")


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def at_time_zone(ts: Column, zone: str) -> Column:
    """The instant at which clocks in ``zone`` show the zone-less ``ts``."""
    return F.make_timestamp_ltz(
        F.year(ts),
        F.month(ts),
        F.dayofmonth(ts),
        F.hour(ts),
        F.minute(ts),
        F.date_part(F.lit("SECOND"), ts),
        F.lit(zone),
    )
