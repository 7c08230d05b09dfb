"""Scheduled trips of a line between two stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.clock import seconds_to_interval, service_clock, service_seconds
from headway.schemas import WORKDAYS

ROUTE_COLUMNS = ["route_id", "route_short_name", "route_long_name"]
TRIP_COLUMNS = ["route_id", "service_id", "trip_id", "trip_headsign"]
SERVICE_COLUMNS = [
    "service_id",
    *WORKDAYS,
    "saturday",
    "sunday",
    "start_date",
    "end_date",
]


def stop_calls(stop_times: DataFrame, first_stop: str, second_stop: str) -> DataFrame:
    """Per trip the latest arrival and departure, in seconds, at each of two stops.

    Aggregating here, before any join, leaves one row per trip whatever the
    number of calls, and combines on the map side.
    """

    def latest(column: str, stop: str) -> Column:
        at_stop = F.when(F.col("stop_id") == stop, service_seconds(F.col(column)))
        return F.max(at_stop)

    return (
        stop_times.filter(F.col("stop_id").isin(first_stop, second_stop))
        .groupBy("trip_id")
        .agg(
            latest("arrival_time", first_stop).alias("first_arrival_s"),
            latest("departure_time", first_stop).alias("first_departure_s"),
            latest("arrival_time", second_stop).alias("second_arrival_s"),
            latest("departure_time", second_stop).alias("second_departure_s"),
        )
    )


def weekday_lines(
    routes: DataFrame, calendar: DataFrame, line: str
) -> tuple[DataFrame, DataFrame]:
    """The distinct routes of a line, and services that run Monday to Friday."""
    lines = routes.filter(F.col("route_short_name") == line).select(*ROUTE_COLUMNS).distinct()
    weekly = calendar
    for day in WORKDAYS:
        weekly = weekly.filter(F.col(day) == 1)
    return lines, weekly.select(*SERVICE_COLUMNS).distinct()


def bucket_schedule(
    trips: DataFrame, stop_times: DataFrame, names: tuple[str, str], buckets: int
) -> tuple[DataFrame, DataFrame]:
    """Catalog tables of trips and calls that are bucketed by trip.

    Their join, and what is grouped by trip before and after it, needs no exchange. Choose
    `buckets` so that one of calls fits in a task, some 100 MB.
    """
    spark = trips.sparkSession
    for rows, name in zip((trips, stop_times), names):
        # dealt as the buckets are, so each bucket is one file
        (
            rows.repartition(buckets, "trip_id")
            .write.mode("overwrite")
            .format("parquet")
            .bucketBy(buckets, "trip_id")
            .sortBy("trip_id")
            .saveAsTable(name)
        )
    return spark.table(names[0]), spark.table(names[1])


def scheduled_trips(
    routes: DataFrame,
    trips: DataFrame,
    stop_times: DataFrame,
    calendar: DataFrame,
    *,
    line: str,
    headsign: str,
    first_stop: str,
    second_stop: str,
) -> DataFrame:
    """Clock times at two stops and the travel time between them, one row per trip.

    A trip that calls at only one of the stops is kept, with nulls for the other.
    Times stay comparable after midnight, as they are seconds underneath.

    Trips meet their calls first and repeated trips are dropped there, where rows are dealt
    by trip already; with `bucket_schedule` they are from the start. Routes and calendar are
    left to the planner: broadcast below its threshold by measured size, otherwise shuffled
    with skewed keys split. Each side is distinct, so the result is.
    """
    calls = stop_calls(stop_times, first_stop, second_stop)
    lines, weekly = weekday_lines(routes, calendar, line)
    wanted = trips.filter(F.lower("trip_headsign") == headsign.lower()).select(*TRIP_COLUMNS)
    travel = F.col("second_arrival_s") - F.col("first_departure_s")
    return (
        wanted.join(calls, "trip_id")
        .distinct()
        .join(lines, "route_id")
        .join(weekly, "service_id")
        .select(
            *ROUTE_COLUMNS,
            *TRIP_COLUMNS[1:],
            *SERVICE_COLUMNS[1:],
            service_clock(F.col("first_arrival_s")).alias("first_arrival_time"),
            service_clock(F.col("first_departure_s")).alias("first_departure_time"),
            service_clock(F.col("second_arrival_s")).alias("second_arrival_time"),
            service_clock(F.col("second_departure_s")).alias("second_departure_time"),
            travel.alias("travel_seconds"),
            seconds_to_interval(travel).alias("travel_duration"),
        )
        .orderBy(F.asc("trip_id"), F.asc_nulls_last("first_arrival_time"))
    )
