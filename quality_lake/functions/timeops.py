"""Zone-less (TIMESTAMP_NTZ) time expressions.

Every expression here keeps NTZ values NTZ, so the session time zone never
changes a result.  ``date_trunc`` is avoided on purpose: it returns a zoned
timestamp and moves wall-clock times that fall in a DST gap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: wall-clock text accepted for a time column (HH:mm, 00:00-23:59).
TIME_OF_DAY_PATTERN = r"^([01][0-9]|2[0-3]):[0-5][0-9]$"


def hour_bucket(ts: Column) -> Column:
    """Truncate an NTZ timestamp to its hour, staying NTZ (null stays null).

    Rebuilt from its own fields, so it can never be invalid and no zone is
    consulted (02:30 on a spring-forward day stays 02:00).
    """
    return F.try_make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))


def local_hour_bucket(utc_ts: Column, tz: str) -> Column:
    """UTC wall clock -> local wall clock of ``tz`` -> hour, all NTZ."""
    return hour_bucket(F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_ts))


def timestamp_from_date_time(date_col: Column, time_col: Column) -> Column:
    """``date`` + ``HH:mm`` text -> NTZ timestamp.

    Null date, null time or a time outside 00:00-23:59 (``24:00``, ``9:05``)
    gives null.  The date part is the date's ISO text form.
    """
    ok = date_col.isNotNull() & time_col.isNotNull() & time_col.rlike(TIME_OF_DAY_PATTERN)
    text = F.concat_ws(" ", date_col.cast("string"), time_col)
    return F.when(ok, text.try_cast("timestamp_ntz"))


def timestamp_from_parts(year: Column, month: Column, day: Column,
                         hour: Column, minute: Column, second: Column) -> Column:
    """NTZ timestamp from parts; an impossible date or time gives null."""
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, second)


def duration_seconds(start: Column, end: Column) -> Column:
    """Wall-clock seconds between two NTZ timestamps (no zone applied)."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)
