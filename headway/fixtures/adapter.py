"""Transit-shaped views over the benchmark tables.

Each view is a source table and column texts that Spark and DuckDB both
understand, so the checks can build the same input in either engine. Every view
takes all rows of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# stops and positions share this spread, so that positions fall on and around stops
_LAT = "(59350000 + ({key} * 104729) % 150000)"
_LON = "(24500000 + ({key} * 7919) % 400000)"

# half of all calls are at ten busy stops, the rest at any stop
_STOP = "CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey % 10 ELSE l_suppkey END"
_HOUR = "CAST(CAST(5 + l_orderkey % 20 + floor(l_linenumber / 4) AS int) AS string)"
_MINUTE = "CAST((l_linenumber * 7 + l_orderkey) % 60 AS string)"


def _clock(second: str) -> str:
    parts = (_HOUR, _MINUTE, f"CAST({second} AS string)")
    return " || ':' || ".join(f"lpad({part}, 2, '0')" for part in parts)


VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "gps_raw": (
        "events",
        {
            "transport_type": "CAST(event_id % 3 + 1 AS int)",
            "line_number": "CAST(user_id % 10 AS string) "
            "|| CASE WHEN event_id % 17 = 0 THEN 'A' ELSE '' END",
            "longitude_raw": f"CAST({_LON.format(key='event_id')} AS bigint)",
            "latitude_raw": f"CAST({_LAT.format(key='event_id')} AS bigint)",
            "speed_kmh": "CASE WHEN event_id % 11 = 0 THEN NULL "
            "ELSE CAST(event_id % 90 AS int) END",
            "heading_deg": "CASE WHEN event_id % 10 = 0 THEN 999 "
            "ELSE CAST(event_id % 360 AS int) END",
            "vehicle_id": "CAST(user_id AS string)",
            "floor_type": "CASE WHEN event_id % 2 = 0 THEN 'Z' ELSE 'K' END",
            "fleet_number": "lpad(CAST(user_id % 100 AS string), 4, '0')",
            "destination": "CASE event_type WHEN 'click' THEN 'Männiku' "
            "WHEN 'view' THEN 'MÄNNIKU' ELSE event_type END",
            "snapshot_ts": "date_trunc('hour', ts)",
        },
    ),
    "gtfs_stops": (
        "supplier",
        {
            "stop_id": "CAST(s_suppkey AS string)",
            "stop_name": "s_name",
            "stop_lat": f"CAST({_LAT.format(key='s_suppkey')} AS double) / 1e6",
            "stop_lon": f"CAST({_LON.format(key='s_suppkey')} AS double) / 1e6",
        },
    ),
    "gtfs_routes": (
        "nation",
        {
            "route_id": "CAST(n_nationkey AS string)",
            "route_short_name": "CAST(n_nationkey % 10 AS string)",
            "route_long_name": "n_name",
            "route_type": "CASE n_regionkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 800 ELSE 900 END",
        },
    ),
    "gtfs_trips": (
        "orders",
        {
            "trip_id": "CAST(o_orderkey AS string)",
            "route_id": "CAST(o_custkey % 25 AS string)",
            "service_id": "o_orderpriority",
            "trip_headsign": "CASE o_orderstatus WHEN 'O' THEN 'Männiku' "
            "WHEN 'F' THEN 'MÄNNIKU' ELSE 'Toompark' END",
        },
    ),
    "gtfs_stop_times": (
        "lineitem",
        {
            "trip_id": "CAST(l_orderkey AS string)",
            "arrival_time": _clock("l_partkey % 30"),
            "departure_time": _clock("l_partkey % 30 + 20"),
            "stop_id": f"CAST({_STOP} AS string)",
            "stop_sequence": "l_linenumber",
        },
    ),
    "gtfs_calendar": (
        "(SELECT DISTINCT o_orderpriority AS service_id, "
        "CASE WHEN left(o_orderpriority, 1) IN ('1', '2', '3') THEN 1 ELSE 0 END AS weekday "
        "FROM orders) AS services",
        {
            "service_id": "service_id",
            "monday": "weekday",
            "tuesday": "weekday",
            "wednesday": "weekday",
            "thursday": "weekday",
            "friday": "weekday",
            "saturday": "1 - weekday",
            "sunday": "1 - weekday",
            "start_date": "CAST('2024-01-01' AS date)",
            "end_date": "CAST('2024-12-31' AS date)",
        },
    ),
    "gtfs_calendar_dates": (
        "(SELECT DISTINCT o_orderpriority AS service_id, CAST(o_orderdate AS date) AS date, "
        "CAST(1 + o_custkey % 2 AS int) AS exception_type FROM orders) AS exceptions",
        {"service_id": "service_id", "date": "date", "exception_type": "exception_type"},
    ),
}


def view_sql(name: str) -> str:
    """The view as a query over the benchmark tables."""
    table, columns = VIEWS[name]
    texts = ", ".join(f"{text} AS {column}" for column, text in columns.items())
    return f"SELECT {texts} FROM {table}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame."""
    source = VIEWS[name][0]
    base = next(t for t in ("events", "supplier", "nation", "orders", "lineitem") if t in source)
    # the frame is handed to the query by name, not by a lasting view
    text = view_sql(name).replace(f"FROM {base}", "FROM {base}")
    return spark.sql(text, base=table(spark, sf_dir, base))
