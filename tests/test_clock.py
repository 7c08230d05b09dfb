from __future__ import annotations

from datetime import UTC, datetime, time, timedelta
from zoneinfo import ZoneInfo

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.functions.clock import (
    in_local_window,
    seconds_to_interval,
    service_clock,
    service_seconds,
)


def test_service_clock_round_trip(spark):
    texts = ["05:00:00", "25:30:07", "8:05:09", "123:00:01", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    s = service_seconds(F.col("t"))
    rows = df.select(s.alias("s"), service_clock(s).alias("back")).collect()
    assert [r.s for r in rows] == [18000, 91807, 29109, 442801, None]
    assert [r.back for r in rows] == ["05:00:00", "25:30:07", "08:05:09", "123:00:01", None]


def test_bad_clock_fails(spark):
    df = spark.createDataFrame([("soon",)], "t string")
    with pytest.raises(Exception, match="INVALID"):
        df.select(service_seconds(F.col("t"))).collect()


def test_interval(spark):
    row = spark.range(1).select(seconds_to_interval(F.lit(4432)).alias("d")).first()
    assert row.d == timedelta(seconds=4432)


def _inside(spark, instants, *window):
    rows = spark.createDataFrame([(i,) for i in instants], "t timestamp")
    return [r.x for r in rows.select(in_local_window(F.col("t"), *window).alias("x")).collect()]


def _utc(*parts):
    return datetime(*parts, tzinfo=UTC)


def test_window_edges(spark):
    # Tallinn is two hours ahead of UTC in winter and three in summer
    instants = [
        _utc(2024, 1, 5, 5, 0, 0),
        _utc(2024, 1, 5, 8, 0, 0),
        _utc(2024, 1, 5, 8, 0, 0, 500000),
        _utc(2024, 7, 5, 4, 0, 0),
        _utc(2024, 7, 5, 3, 59, 59, 999999),
    ]
    found = _inside(spark, instants, "07:00", "10:00", "Europe/Tallinn")
    assert found == [True, True, False, True, False]


def test_window_over_midnight_and_open_and_unknown_zone(spark):
    instants = [_utc(2024, 1, 5, h) for h in (0, 1, 3, 22, 23)]
    assert _inside(spark, instants, "23:00", "02:00") == [True, True, False, False, True]
    assert _inside(spark, instants, "23:00", "02:00", "Nowhere/None") == [
        True, True, False, False, True,
    ]
    assert _inside(spark, instants, None, "02:00") == [True] * 5
    assert _inside(spark, instants, "05:00", "05:00") == [True] * 5


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.datetimes(datetime(2023, 1, 1), datetime(2025, 1, 1)), min_size=20, max_size=40
    ),
    st.times(),
    st.times(),
)
def test_window_against_python(spark, instants, start, end):
    start, end = time(start.hour, start.minute), time(end.hour, end.minute)
    instants = [i.replace(tzinfo=UTC) for i in instants]
    local = [i.astimezone(ZoneInfo("Europe/Tallinn")).time() for i in instants]
    if start < end:
        expected = [start <= t <= end for t in local]
    else:
        expected = [t >= start or t <= end for t in local]
    window = (f"{start:%H:%M}", f"{end:%H:%M}", "Europe/Tallinn")
    assert _inside(spark, instants, *window) == expected
