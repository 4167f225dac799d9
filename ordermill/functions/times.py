"""Time expressions.  Moments arrive as arguments; nothing reads the clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed

Moment = datetime | date | str


def moment(value: Moment) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value)


def literal(value: Moment) -> Column:
    """A text literal: it takes the type of the column it meets, so the filter reaches the scan."""
    return F.lit(moment(value).isoformat(sep=" "))


def on_or_after(ts: Column, value: Moment | None) -> Column:
    return F.lit(True) if value is None else ts >= literal(value)


def before(ts: Column, value: Moment | None) -> Column:
    return F.lit(True) if value is None else ts < literal(value)


def within(ts: Column, as_of: Moment, **span: float) -> Column:
    """Not older than ``span`` (``days=7``, ``minutes=10``) at ``as_of``."""
    return ts >= literal(moment(as_of) - timedelta(**span))


def bucket_start(ts: Column, minutes: int, shift_hours: int = 0) -> Column:
    """Start of the ``minutes``-wide slot of the hour, after an optional zone shift."""
    if shift_hours:
        ts = ts + F.make_dt_interval(hours=F.lit(shift_hours))
    past = F.minute(ts) % minutes
    return F.date_trunc("minute", ts) - F.make_dt_interval(mins=past)


def sunday_first(ts: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(ts) - 1


def weekday_label(ts: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in fixed.WEEKDAY_LABELS]), F.dayofweek(ts))


def hour_label(ts: Column) -> Column:
    return F.concat(F.hour(ts).cast("string"), F.lit(fixed.HOUR_SUFFIX))


def week_of_month(day: Column) -> Column:
    """Calendar week of the month, Monday first, 1 to 4; later days stay in week 4."""
    lead = F.weekday(F.trunc(day, "MM"))
    return F.least(F.lit(4), F.floor((F.dayofmonth(day) + lead - 1) / 7) + 1).cast("int")


def weekday_factor(day: Column) -> Column:
    return (
        F.when(F.weekday(day) >= 5, fixed.WEEKEND_FACTOR)
        .when(F.weekday(day) == 4, fixed.FRIDAY_FACTOR)
        .otherwise(fixed.WEEKDAY_FACTOR)
    )


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
