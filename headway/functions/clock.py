"""Service-day clock times and local time-of-day windows."""

from __future__ import annotations

from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_DAY = 24 * 60 * MICROS_PER_MINUTE


def service_seconds(clock: Column) -> Column:
    """`HH:MM:SS` to seconds since the start of the service day.

    Hours may pass 24, as schedules write a trip after midnight on the day before.
    """
    parts = F.split(clock, ":")
    hours, minutes, seconds = (parts.getItem(i).cast("int") for i in range(3))
    return hours * 3600 + minutes * 60 + seconds


def service_clock(seconds: Column) -> Column:
    """Seconds since the start of the service day as zero-padded `HH:MM:SS`."""
    pieces = [
        F.floor(seconds / 3600),
        F.floor(seconds / 60) % 60,
        seconds % 60,
    ]
    padded = [F.lpad(p.cast("string"), 2, "0") for p in pieces]
    # lpad cuts longer text, and hours can have three digits
    padded[0] = F.when(pieces[0] > 99, pieces[0].cast("string")).otherwise(padded[0])
    return F.concat(padded[0], F.lit(":"), padded[1], F.lit(":"), padded[2])


def seconds_to_interval(seconds: Column) -> Column:
    return F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def zone_or_utc(zone: str | None) -> str:
    """The zone if it is known, else UTC."""
    try:
        ZoneInfo(zone or "UTC")
    except (ZoneInfoNotFoundError, ValueError):
        return "UTC"
    return zone or "UTC"


def _bound_micros(clock: str) -> int:
    hours, minutes = (int(part) for part in clock.split(":"))
    if not (0 <= hours <= 23 and 0 <= minutes <= 59):
        raise ValueError(f"not a time of day: {clock!r}")
    return (hours * 60 + minutes) * MICROS_PER_MINUTE


def in_local_window(
    instant: Column, start: str | None, end: str | None, zone: str | None = None
) -> Column:
    """Is the instant's local time of day inside `start..end`, both ends included?

    A missing bound opens the window fully, an unknown zone means UTC, and a
    window whose end is not after its start runs over midnight. Needs a UTC session.
    """
    if not start or not end:
        return F.lit(True)
    local = F.from_utc_timestamp(instant.cast("timestamp"), zone_or_utc(zone))
    time_of_day = F.pmod(F.unix_micros(local), F.lit(MICROS_PER_DAY))
    first, last = _bound_micros(start), _bound_micros(end)
    if first < last:
        return time_of_day.between(first, last)
    return (time_of_day >= first) | (time_of_day <= last)
