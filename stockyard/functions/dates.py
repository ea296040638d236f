"""Date and time expressions: week start, local dates, spines, nth weekday."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from .cleaning import cast_date


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_start(c) -> Column:
    """Monday of the week of ``c``, as a date (weeks start on Monday)."""
    return F.date_trunc("week", _c(c)).cast("date")


def weekday_index(c) -> Column:
    """Weekday with Monday = 0 .. Sunday = 6."""
    return F.weekday(_c(c))


def local_wallclock(df: DataFrame, ts: str, zone: str) -> Column:
    """Wall-clock time in ``zone`` of the instant in column ``ts``.

    A ``timestamp_ntz`` column is read as a UTC wall clock; a ``timestamp``
    (instant) column is converted from the session zone. Either way the
    result does not depend on the session time zone.
    """
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(ts))
    # source zone omitted: the instant is taken in the session zone first
    return F.convert_timezone(None, F.lit(zone), F.col(ts))


def local_date(df: DataFrame, ts: str, zone: str) -> Column:
    """Calendar date in ``zone`` of the instant in ``ts``."""
    return F.to_date(local_wallclock(df, ts, zone))


def utc_date(df: DataFrame, ts: str) -> Column:
    """Calendar date in UTC of the instant in ``ts``."""
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        return cast_date(ts)
    return cast_date(F.convert_timezone(None, F.lit("UTC"), F.col(ts)))


def date_spine(df: DataFrame, start: str, end: str, out: str = "event_date") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive, per input row
    (other columns kept). Spines are built per key from a per-key range, so
    their size is the number of days, never a product of two tables."""
    keep = [c for c in df.columns if c not in (start, end)]
    return df.select(*keep, F.explode(F.sequence(F.col(start), F.col(end),
                                                 F.expr("INTERVAL 1 DAY"))).alias(out))


def future_spine(df: DataFrame, last: str, days: int, out: str = "event_date") -> DataFrame:
    """``days`` dates after ``last`` (last + 1 .. last + days) per input row."""
    keep = [c for c in df.columns if c != last]
    return df.select(*keep, F.explode(F.sequence(F.date_add(F.col(last), 1),
                                                 F.date_add(F.col(last), days))).alias(out))


def second_sunday(year: Column, month: int) -> Column:
    """Second Sunday of ``month`` in ``year``."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), "SUN"), 7)


def last_friday(year: Column, month: int) -> Column:
    """Last Friday of ``month`` in ``year``."""
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.next_day(F.date_sub(last, 7), "FRI")


def next_monday_after(d: Column) -> Column:
    """First Monday strictly after ``d``."""
    return F.next_day(d, "MON")


def plus_seconds(c, seconds) -> Column:
    """Timestamp plus a (possibly negative, possibly column) number of seconds."""
    s = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return _c(c) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), s.cast("decimal(18,6)"))
