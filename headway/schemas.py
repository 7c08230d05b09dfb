"""Table layouts: raw feeds as strings, standardized tables as typed columns."""

from __future__ import annotations

# Column names and order of the headerless vehicle-position feed.
GPS_RAW_COLUMNS = [
    "transport_type",
    "line_number",
    "longitude_raw",
    "latitude_raw",
    "speed_kmh",
    "heading_deg",
    "vehicle_id",
    "floor_type",
    "fleet_number",
    "destination",
]

# Fixed value: the feed's marker for "heading unknown".
HEADING_UNKNOWN = 999

# Fixed value: the feed sends coordinates as degrees times one million.
MICRO_DEGREES = 1e6

# Snapshot files are named gps_YYYYMMDD_HHMMSS.csv.
SNAPSHOT_PREFIX = "gps_"
SNAPSHOT_SUFFIX = ".csv"

# Fixed value: how instants are written in file and directory names.
STAMP_FORMAT = "yyyyMMdd_HHmmss"

# The GTFS members that are standardized and the columns kept of each.
GTFS_TABLES = {
    "gtfs_routes": {
        "route_id": "string",
        "route_short_name": "string",
        "route_long_name": "string",
        "route_desc": "string",
        "route_type": "int",
        "route_url": "string",
        "route_color": "string",
        "route_text_color": "string",
        "route_sort_order": "int",
    },
    "gtfs_trips": {
        "route_id": "string",
        "service_id": "string",
        "trip_id": "string",
        "trip_headsign": "string",
        "direction_id": "int",
        "block_id": "string",
        "shape_id": "string",
        "wheelchair_accessible": "int",
        "block_code": "string",
        "vehicle_type": "string",
        "thoreb_id": "string",
        "trip_short_name": "string",
    },
    "gtfs_stops": {
        "stop_id": "string",
        "stop_code": "string",
        "stop_name": "string",
        "stop_desc": "string",
        "stop_lat": "double",
        "stop_lon": "double",
        "stop_url": "string",
        "location_type": "int",
        "parent_station": "string",
        "thoreb_id": "string",
    },
    "gtfs_stop_times": {
        "trip_id": "string",
        "arrival_time": "string",
        "departure_time": "string",
        "stop_id": "string",
        "stop_sequence": "int",
        "pickup_type": "int",
        "drop_off_type": "int",
    },
    "gtfs_calendar": {
        "service_id": "string",
        "monday": "int",
        "tuesday": "int",
        "wednesday": "int",
        "thursday": "int",
        "friday": "int",
        "saturday": "int",
        "sunday": "int",
        "start_date": "date",
        "end_date": "date",
    },
    "gtfs_calendar_dates": {
        "service_id": "string",
        "date": "date",
        "exception_type": "int",
    },
}

WORKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday"]

# Fixed value: how GTFS writes dates.
GTFS_DATE_FORMAT = "yyyyMMdd"

GPS_POSITIONS = {
    "transport_type": "int",
    "line_number": "string",
    "speed_kmh": "int",
    "vehicle_id": "string",
    "floor_type": "string",
    "fleet_number": "string",
    "destination": "string",
    "lat": "double",
    "lon": "double",
    "heading_deg": "int",
    "extract_ts": "timestamp",
    "updated_ts": "timestamp",
}

def gtfs_member(table: str) -> str:
    """File name of a table inside the schedule archive."""
    return table.removeprefix("gtfs_") + ".txt"


def layout(table: str) -> dict[str, str]:
    """Columns and types of a standardized table."""
    if table == "gps_positions":
        return GPS_POSITIONS
    return {**GTFS_TABLES[table], "extract_ts": "timestamp", "updated_ts": "timestamp"}
