from __future__ import annotations

from datetime import timedelta

from headway.plans.schedule import scheduled_trips

DAYS = "monday tuesday wednesday thursday friday saturday sunday".split()


def frames(spark, stop_times, trips=None, calendar=None):
    routes = spark.createDataFrame(
        [("r8", "8", "Long 8"), ("r8", "8", "Long 8"), ("r1", "1", "Long 1")],
        "route_id string, route_short_name string, route_long_name string",
    )
    trips = spark.createDataFrame(
        trips or [("r8", "work", t, "Männiku") for t in ("a", "b", "c")],
        "route_id string, service_id string, trip_id string, trip_headsign string",
    )
    stop_times = spark.createDataFrame(
        stop_times,
        "trip_id string, arrival_time string, departure_time string, stop_id string",
    )
    week = ", ".join(f"{d} int" for d in DAYS)
    calendar = spark.createDataFrame(
        calendar or [("work", 1, 1, 1, 1, 1, 0, 0, "2024-01-01", "2024-12-31")],
        f"service_id string, {week}, start_date string, end_date string",
    )
    return routes, trips, stop_times, calendar


ASKED = dict(line="8", headsign="MÄNNIKU", first_stop="822", second_stop="1769")


def test_times_and_travel(spark):
    rows = scheduled_trips(
        *frames(
            spark,
            [
                ("a", "23:50:00", "23:50:30", "822"),
                ("a", "24:20:00", "24:20:10", "1769"),
                ("a", "23:55:00", "23:55:00", "other"),
                ("b", "8:05:00", "8:05:00", "822"),  # calls at one stop only
                ("b", "10:05:00", "10:05:00", "822"),  # and twice, later in clock order
                ("c", "09:00:00", "09:00:00", "other"),
            ],
        ),
        **ASKED,
    ).collect()
    assert [r.trip_id for r in rows] == ["a", "b"]
    first, second = rows
    assert (first.first_departure_time, first.second_arrival_time) == ("23:50:30", "24:20:00")
    assert first.travel_seconds == 1770
    assert first.travel_duration == timedelta(seconds=1770)
    assert second.first_arrival_time == "10:05:00"
    assert second.second_arrival_time is None and second.travel_seconds is None


def test_filters(spark):
    trips = [
        ("r8", "work", "a", "männiku"),
        ("r8", "work", "b", "Kopli"),
        ("r8", "weekend", "c", "Männiku"),
        ("r8", "tuesday", "d", "Männiku"),
        ("r1", "work", "e", "Männiku"),
        ("r8", None, "f", "Männiku"),
    ]
    calendar = [
        ("work", 1, 1, 1, 1, 1, 0, 0, "x", "y"),
        ("weekend", 0, 0, 0, 0, 0, 1, 1, "x", "y"),
        ("tuesday", 0, 1, 0, 0, 0, 0, 0, "x", "y"),
    ]
    times = [(t, "08:00:00", "08:00:00", "822") for t in "abcdef"]
    rows = scheduled_trips(*frames(spark, times, trips, calendar), **ASKED).collect()
    assert [r.trip_id for r in rows] == ["a"]


def test_repeated_rows_change_nothing_and_periods_multiply(spark):
    """One trip with a third of all calls; routes and trips listed twice."""
    trips = [("r8", "work", "a", "Männiku")] * 2
    calendar = [
        ("work", 1, 1, 1, 1, 1, 0, 0, "2024-01-01", "2024-06-30"),
        ("work", 1, 1, 1, 1, 1, 0, 0, "2024-07-01", "2024-12-31"),
    ]
    times = [("a", f"{5 + i % 20:02d}:00:00", f"{5 + i % 20:02d}:01:00", "822") for i in range(500)]
    rows = scheduled_trips(*frames(spark, times, trips, calendar), **ASKED).collect()
    assert [(r.start_date, r.first_arrival_time) for r in sorted(rows)] == [
        ("2024-01-01", "24:00:00"), ("2024-07-01", "24:00:00"),
    ]
