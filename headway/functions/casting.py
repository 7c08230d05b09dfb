"""Typed columns from text, either failing on bad text or turning it into null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.schemas import GTFS_DATE_FORMAT

STRICT = "strict"
LENIENT = "lenient"


def check_mode(mode: str) -> str:
    if mode not in (STRICT, LENIENT):
        raise ValueError(f"mode must be {STRICT!r} or {LENIENT!r}, not {mode!r}")
    return mode


def typed(column: Column, kind: str, mode: str = STRICT) -> Column:
    """Cast text to `kind`; strict relies on ANSI casts, which raise on bad text."""
    check_mode(mode)
    if kind == "string":
        return column
    if kind == "date":
        if mode == STRICT:
            return F.to_date(column, GTFS_DATE_FORMAT)
        return F.try_to_timestamp(column, F.lit(GTFS_DATE_FORMAT)).cast("date")
    return column.cast(kind) if mode == STRICT else column.try_cast(kind)


def unreadable(column: Column, kind: str) -> Column:
    """True where text is present but does not cast to `kind`."""
    if kind == "string":
        return F.lit(False)
    return column.isNotNull() & typed(column, kind, LENIENT).isNull()


def stamp_to_instant(stamp: Column, mode: str = STRICT) -> Column:
    """`YYYYMMDD_HHMMSS` in UTC to an instant, whatever the session's time zone.

    The stamp is cut at fixed places: every row of a file carries it, and a
    pattern-based parser would cost more than the rest of the row.
    """
    check_mode(mode)
    well_formed = (F.length(stamp) == 15) & (F.substring(stamp, 9, 1) == "_")
    places = ((1, 4), (5, 2), (7, 2), (10, 2), (12, 2), (14, 2))
    pieces = [F.substring(stamp, start, size) for start, size in places]
    joints = ["", "-", "-", " ", ":", ":"]
    text = F.concat(*[part for pair in zip(map(F.lit, joints), pieces) for part in pair])
    # without a zone until the end, so that the session's zone has no part in it
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", epoch, text.try_cast("timestamp_ntz"))
    instant = F.when(well_formed, F.timestamp_seconds(seconds))
    if mode == LENIENT:
        return instant
    shown = F.coalesce(stamp, F.lit("nothing"))
    return F.coalesce(instant, F.raise_error(F.concat(F.lit("not an instant: "), shown)))
