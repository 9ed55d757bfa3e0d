"""Wall-clock arithmetic on TIMESTAMP_NTZ columns.

Order times are local business times without a zone, so nothing here may pass
through the session zone: dates, intervals and tumbling windows on TIMESTAMP_NTZ
never do, and they stay inside whole-stage codegen.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def wall(moment: datetime) -> Column:
    """TIMESTAMP_NTZ literal.  A plain literal of a datetime is an instant, and its wall clock depends on two zones."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def width_seconds(width: str) -> int:
    """Seconds in a width such as ``"15 minutes"`` or ``"1 day"``."""
    count, unit = width.split()
    seconds = int(count) * _UNIT_SECONDS[unit.rstrip("s")]
    if seconds <= 0:
        raise ValueError(f"bucket width must be positive: {width!r}")
    return seconds


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds of wall-clock time since 1970-01-01 00:00:00.

    The time of day is an interval; a million times its length, read in seconds, is its microseconds.
    """
    ts = _col(ts)
    day = F.to_date(ts)
    of_day = ((ts - day.cast("timestamp_ntz")) * 1_000_000).cast("interval second").cast("long")
    return F.unix_date(day).cast("long") * 86_400_000_000 + of_day


def time_bucket(width: str, ts: Column | str, origin: datetime = datetime(1970, 1, 1)) -> Column:
    """Start of the fixed-width bucket holding ``ts``; buckets are aligned to ``origin``.

    Tumbling windows on TIMESTAMP_NTZ are pure integer arithmetic on the wall
    clock.  They skip rows without a time, so those are led around the window
    and keep a NULL bucket.  One width per projection.
    """
    ts, seconds = _col(ts), width_seconds(width)
    shift = int((origin - datetime(1970, 1, 1)).total_seconds()) % seconds
    present = F.coalesce(ts.cast("timestamp_ntz"), wall(origin))
    start = F.window(present, f"{seconds} seconds", startTime=f"{shift} seconds")["start"]
    return F.when(ts.isNotNull(), start)


def hours_between(start: Column | str, end: Column | str) -> Column:
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(3.6e9)


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(6.0e7)


def clock_hms(millis: Column | str) -> Column:
    """Milliseconds as ``HH:MM:SS``; hours run past 23 for long steps."""
    seconds = F.floor(_col(millis) / 1000).cast("long")
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(seconds / 3600).cast("long"),
        F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("long"),
        F.pmod(seconds, F.lit(60)),
    )


def to_business_time(ts: Column | str, zone: str, source_zone: str = "UTC") -> Column:
    """Move a wall clock from one zone to another.  Off by default: stored times are already local."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), _col(ts))
