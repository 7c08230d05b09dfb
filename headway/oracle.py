"""SQL for DuckDB that answers each registered query from the benchmark tables."""

from __future__ import annotations

from headway.fixtures.adapter import VIEWS, view_sql
from headway.fixtures.landing import EXTRACT_DATE, STOP_EXTRACTS
from headway.schemas import GPS_RAW_COLUMNS, GTFS_TABLES

_TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"

# instant of the extract folder the schedule tables are written to
_EXTRACT_SHOWN = "2024-01-31 04:00:00"


def _with(views: list[str], body: str, *more: str) -> str:
    parts = [f"{name} AS ({view_sql(name)})" for name in views]
    return f"WITH {', '.join([*parts, *more])} {body}"


# ---- sources ----------------------------------------------------------------

_RAW_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in GPS_RAW_COLUMNS)

# archives hold 50,000 keys each and are an hour apart
_ARCHIVE = "CAST(floor(CAST({} AS BIGINT) / 50000.0) AS BIGINT)"
_STAMP = (
    "strftime(TIMESTAMP '2024-01-31 04:00:00' + "
    f"{_ARCHIVE} * INTERVAL 1 HOUR, '%Y%m%d_%H%M%S')"
)

_PLACES = _with(
    ["gtfs_stops", "gtfs_routes"],
    f"""
    SELECT 'stops' AS member, stop_id AS id, stop_name AS name, stop_lat AS lat,
           {_STAMP.format('stop_id')} AS extract_ts
    FROM gtfs_stops
    UNION ALL
    SELECT 'routes', route_id, route_long_name, CAST(0 AS DOUBLE),
           {_STAMP.format('route_id')}
    FROM gtfs_routes
    """,
)

_ARCHIVES = _with(
    ["gtfs_stops", "gtfs_routes"],
    f"""
    SELECT extract_ts, count(DISTINCT member) AS members, 'ok' AS status
    FROM (SELECT 'stops' AS member, {_STAMP.format('stop_id')} AS extract_ts FROM gtfs_stops
          UNION ALL
          SELECT 'routes', {_STAMP.format('route_id')} FROM gtfs_routes) AS members
    GROUP BY extract_ts
    """,
)


def _stop_extracts(extracts: list[tuple[str, str, str]]) -> str:
    rows = ", ".join(f"('{day}', '{stamp}', '{tag}')" for day, stamp, tag in extracts)
    return _with(
        ["gtfs_stops"],
        f"""
        SELECT stop_id, stop_name, stop_desc, extract_date, extract_ts
        FROM gtfs_stops,
             (VALUES {rows}) AS extracts (extract_date, extract_ts, stop_desc)
        """,
    )


# ---- standardized tables ----------------------------------------------------

_STD = """
    transport_type, line_number, speed_kmh, vehicle_id, floor_type, fleet_number, destination,
    latitude_raw / 1000000.0 AS lat, longitude_raw / 1000000.0 AS lon,
    nullif(heading_deg, 999) AS heading_deg
"""

# snapshots the misnamed landing area files without an instant
_NAMELESS = "(hour(snapshot_ts) = 0 AND day(snapshot_ts) % 2 = 1)"

# positions as the analytical queries take them
_POSITIONS = (
    "positions AS (SELECT snapshot_ts AS extract_ts, vehicle_id, fleet_number, line_number, "
    "destination, transport_type, latitude_raw / 1000000.0 AS lat, "
    "longitude_raw / 1000000.0 AS lon, CAST(snapshot_ts AS DATE) AS day FROM gps_raw)"
)


def _std_gtfs(name: str) -> str:
    given = VIEWS[name][1]
    sql_types = {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "date": "DATE"}
    columns = []
    for column, kind in GTFS_TABLES[name].items():
        text = column if column in given else "NULL"
        typed = f"CAST({text} AS {sql_types[kind]})"
        if kind == "date":
            typed = f"CAST({typed} AS VARCHAR)"
        columns.append(f"{typed} AS {column}")
    columns.append(f"'{_EXTRACT_SHOWN}' AS extract_ts")
    columns.append(f"'{EXTRACT_DATE}' AS extract_date")
    return _with([name], f"SELECT {', '.join(columns)} FROM {name}")


# ---- sinks and jobs ---------------------------------------------------------

_HALF = "DATE '2024-01-16'"

_TWO_WRITES = _with(
    ["gps_raw"],
    f"""
    SELECT vehicle_id, {_TS.format('extract_ts')} AS extract_ts, lat, lon,
           CASE WHEN day < {_HALF} THEN transport_type ELSE transport_type + 10 END
               AS transport_type,
           CAST(day AS VARCHAR) AS date
    FROM positions
    """,
    _POSITIONS,
)

_BACKFILL = """
    WITH counted AS (
        SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1
    ), ends AS (
        SELECT min(day) AS first, max(day) AS last FROM counted
    ), calendar AS (
        SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS day FROM ends
    )
    SELECT CAST(c.day AS VARCHAR) AS date,
           CASE WHEN n IS NULL THEN 'empty'
                WHEN c.day BETWEEN first + 9 AND first + 11 THEN 'skipped'
                ELSE 'written' END AS status,
           coalesce(n, 0) AS stored
    FROM calendar AS c LEFT JOIN counted AS k ON c.day = k.day, ends
"""

_ISOLATION = _with(
    ["gps_raw"],
    f"""
    SELECT CAST(day AS VARCHAR) AS date, n AS rows, bad AS bad_rows,
           CASE WHEN bad > 0 THEN 'failed' ELSE 'written' END AS status
    FROM (SELECT CAST(snapshot_ts AS DATE) AS day, count(*) AS n,
                 count(*) FILTER (WHERE {_NAMELESS}) AS bad
          FROM gps_raw GROUP BY 1) AS profile
    """,
)

_UPSERT = f"""
    SELECT 'vehicle-' || CAST(user_id AS VARCHAR) AS source,
           CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS extract_date,
           CASE WHEN min(CAST(ts AS DATE)) < {_HALF} THEN user_id % 3 <> 0 ELSE true END
               AS active,
           CASE WHEN min(CAST(ts AS DATE)) < {_HALF} THEN 'seed' END AS comment
    FROM events GROUP BY user_id
"""

_RESOLVE = """
    SELECT source, extract_date,
           'extract_source=' || source || '/extract_date=' || extract_date AS folder
    FROM (SELECT 'vehicle-' || CAST(user_id AS VARCHAR) AS source,
                 CASE WHEN user_id % 3 <> 0 THEN CAST(max(CAST(ts AS DATE)) AS VARCHAR)
                      ELSE '2024-02-15' END AS extract_date
          FROM events GROUP BY user_id) AS resolved
"""

_LOCAL = "CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Tallinn' AS TIME)"

_WINDOW = f"""
    SELECT event_id,
           CAST({_LOCAL} >= TIME '06:30:00' AND {_LOCAL} <= TIME '09:15:00' AS INTEGER)
               AS in_morning,
           CAST({_LOCAL} >= TIME '22:15:00' OR {_LOCAL} <= TIME '01:45:00' AS INTEGER)
               AS in_night
    FROM events
"""

_DAY = "strftime({}, '%Y-%m-%d')"
_NAME = "'gps_' || strftime({}, '%Y%m%d_%H%M%S')"

# A snapshot filed under its UTC date and, where that differs, its local date: all
# copies go to one place, the copy with the earlier date first.
_SHIFTED = f"""
    SELECT 'gps' AS source, extract_date, {_NAME.format('snapshot_ts')} || '.csv' AS file_name,
           {_DAY.format('moved')} AS new_date,
           {_NAME.format('moved')}
               || CASE WHEN copy > 1 THEN '-' || CAST(copy - 1 AS VARCHAR) ELSE '' END
               || '.csv' AS new_name,
           'move' AS action
    FROM (SELECT snapshot_ts, snapshot_ts - INTERVAL 3 HOUR AS moved, extract_date,
                 row_number() OVER (PARTITION BY snapshot_ts ORDER BY extract_date) AS copy
          FROM (SELECT snapshot_ts, {_DAY.format('snapshot_ts')} AS extract_date FROM gps_raw
                UNION
                SELECT snapshot_ts, {_DAY.format('snapshot_ts + INTERVAL 3 HOUR')} FROM gps_raw)
               AS filed) AS numbered
"""

_SHIFTED_FILES = f"""
    SELECT n.new_date AS extract_date, n.new_name AS file_name, count(*) AS rows,
           CAST(sum(CAST(vehicle_id AS BIGINT)) AS BIGINT) AS vehicles
    FROM ({_SHIFTED}) AS n JOIN gps_raw
      ON n.file_name = {_NAME.format('snapshot_ts')} || '.csv'
    WHERE NOT {_NAMELESS}
    GROUP BY 1, 2
    UNION ALL
    SELECT {_DAY.format('snapshot_ts')}, 'gps_latest.csv', count(*), CAST(sum(CAST(vehicle_id AS BIGINT)) AS BIGINT)
    FROM gps_raw WHERE {_NAMELESS} GROUP BY 1
"""

_SHIFT_APPLY = _with(
    ["gps_raw"],
    f"""
    SELECT vehicle_id, {_TS.format('extract_ts - INTERVAL 3 HOUR')} AS extract_ts, lat, lon,
           {_DAY.format('extract_ts - INTERVAL 3 HOUR')} AS date
    FROM positions
    """,
    _POSITIONS,
)

_RENAMED = _with(
    ["gps_raw"],
    f"SELECT vehicle_id, {_TS.format('extract_ts')} AS extract_ts, lat, lon, "
    "CAST(day AS VARCHAR) AS extract_date FROM positions",
    _POSITIONS,
)

# keys of the schedule tables without coordinates
_VALIDATED = {
    "gtfs_routes": ["route_id"],
    "gtfs_trips": ["trip_id", "route_id", "service_id"],
    "gtfs_stop_times": ["trip_id", "stop_id"],
    "gtfs_calendar": ["service_id"],
    "gtfs_calendar_dates": ["service_id", '"date"'],
}

_VALIDATE = _with(
    ["gps_raw", "gtfs_stops", *_VALIDATED],
    """
    SELECT 'gps_positions' AS model, kind AS check, amount AS value FROM (
        SELECT 'schema_faults' AS kind, CAST(0 AS BIGINT) AS amount
        UNION ALL SELECT 'rows', count(*) FROM positions
        UNION ALL SELECT 'partitions', count(DISTINCT day) FROM positions
        UNION ALL SELECT 'null_keys', count(*) FROM positions
                  WHERE vehicle_id IS NULL OR extract_ts IS NULL
        UNION ALL SELECT 'out_of_bounds', count(*) FROM positions
                  WHERE lat IS NULL OR lon IS NULL
                     OR lat < 57 OR lat > 60.5 OR lon < 21 OR lon > 29
    ) AS gps
    UNION ALL
    SELECT 'gtfs_stops', kind, amount FROM (
        SELECT 'schema_faults' AS kind, CAST(0 AS BIGINT) AS amount
        UNION ALL SELECT 'rows', count(*) FROM gtfs_stops
        UNION ALL SELECT 'partitions', CAST(1 AS BIGINT)
        UNION ALL SELECT 'null_keys', count(*) FROM gtfs_stops WHERE stop_id IS NULL
        UNION ALL SELECT 'out_of_bounds', count(*) FROM gtfs_stops
                  WHERE stop_lat IS NULL OR stop_lon IS NULL
                     OR stop_lat < 57 OR stop_lat > 60.5 OR stop_lon < 21 OR stop_lon > 29
    ) AS stops
    """
    + "".join(
        f"""
    UNION ALL
    SELECT '{name}', kind, amount FROM (
        SELECT 'schema_faults' AS kind, CAST(0 AS BIGINT) AS amount
        UNION ALL SELECT 'rows', count(*) FROM {name}
        UNION ALL SELECT 'partitions', CAST(1 AS BIGINT)
        UNION ALL SELECT 'null_keys', count(*) FROM {name}
                  WHERE {' OR '.join(f'{key} IS NULL' for key in keys)}
    ) AS {name}_checks"""
        for name, keys in _VALIDATED.items()
    ),
    _POSITIONS,
)

# ---- analytical queries -----------------------------------------------------


def _seconds(clock: str) -> str:
    h, m, s = (f"CAST(split_part({clock}, ':', {i}) AS INTEGER)" for i in (1, 2, 3))
    return f"{h} * 3600 + {m} * 60 + {s}"


def _clock(seconds: str) -> str:
    pieces = (f"{seconds} // 3600", f"{seconds} // 60 % 60", f"{seconds} % 60")
    return " || ':' || ".join(f"lpad(CAST({p} AS VARCHAR), 2, '0')" for p in pieces)


_DAYS = "monday, tuesday, wednesday, thursday, friday, saturday, sunday"
_TRIP_KEYS = (
    "r.route_id, route_short_name, route_long_name, t.service_id, t.trip_id, trip_headsign, "
    f"{_DAYS}, start_date, end_date"
)


def _trips(body: str) -> str:
    timed = ", ".join(
        f"max({_seconds(f'{what}_time')}) FILTER (WHERE stop_id = '{stop}') AS {name}_{what}"
        for name, stop in (("first", "3"), ("second", "7"))
        for what in ("arrival", "departure")
    )
    return _with(
        ["gtfs_routes", "gtfs_trips", "gtfs_stop_times", "gtfs_calendar"],
        body,
        f"""found AS (
            SELECT {_TRIP_KEYS}, {timed}
            FROM gtfs_routes AS r
            JOIN gtfs_trips AS t ON t.route_id = r.route_id
            JOIN gtfs_stop_times AS st ON st.trip_id = t.trip_id
            JOIN gtfs_calendar AS c ON c.service_id = t.service_id
            WHERE route_short_name = '7' AND lower(trip_headsign) = 'männiku'
              AND stop_id IN ('3', '7')
              AND least(monday, tuesday, wednesday, thursday, friday) = 1
              AND greatest(monday, tuesday, wednesday, thursday, friday) = 1
            GROUP BY {_TRIP_KEYS}
        )""",
    )


_SCHEDULED = _trips(
    f"""
    SELECT route_id, route_short_name, route_long_name, service_id, trip_id, trip_headsign,
           {_DAYS}, CAST(start_date AS VARCHAR) AS start_date,
           CAST(end_date AS VARCHAR) AS end_date,
           {_clock('first_arrival')} AS first_arrival_time,
           {_clock('first_departure')} AS first_departure_time,
           {_clock('second_arrival')} AS second_arrival_time,
           {_clock('second_departure')} AS second_departure_time,
           second_arrival - first_departure AS travel_seconds
    FROM found
    """
)

_TRAVEL = _trips(
    """
    SELECT trip_id, second_arrival - first_departure AS travel_seconds,
           CAST(trunc((second_arrival - first_departure) / 60.0) AS INTEGER) AS whole_minutes
    FROM found
    WHERE second_arrival - first_departure IS NOT NULL
    """
)

# L-EST97 by Snyder's two-parallel conic; constants from the published parameters
_CONE = """
    grs AS (SELECT sqrt(2 * f - f * f) AS e, radians(58) AS p1, radians(59 + 20 / 60.0) AS p2,
                   radians(57 + 31 / 60.0 + 3.19415 / 3600.0) AS p0
            FROM (SELECT CAST(1 AS DOUBLE) / 298.257222101 AS f) AS flattening),
    shape AS (SELECT e,
                   cos(p1) / sqrt(1 - e * e * sin(p1) * sin(p1)) AS m1,
                   cos(p2) / sqrt(1 - e * e * sin(p2) * sin(p2)) AS m2,
                   tan(pi() / 4 - p1 / 2) / pow((1 - e * sin(p1)) / (1 + e * sin(p1)), e / 2) AS t1,
                   tan(pi() / 4 - p2 / 2) / pow((1 - e * sin(p2)) / (1 + e * sin(p2)), e / 2) AS t2,
                   tan(pi() / 4 - p0 / 2) / pow((1 - e * sin(p0)) / (1 + e * sin(p0)), e / 2) AS t0
            FROM grs),
    cone AS (SELECT e, n, 6378137 * m1 / (n * pow(t1, n)) AS af,
                    6378137 * m1 / (n * pow(t1, n)) * pow(t0, n) AS r0
             FROM (SELECT *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) AS n FROM shape) AS slope)
"""


def _grid(lat: str, lon: str) -> tuple[str, str]:
    t = (
        f"(tan(pi() / 4 - radians({lat}) / 2) / "
        f"pow((1 - e * sin(radians({lat}))) / (1 + e * sin(radians({lat}))), e / 2))"
    )
    rho, theta = f"af * pow({t}, n)", f"n * radians({lon} - 24)"
    return f"6375000 + r0 - {rho} * cos({theta})", f"500000 + {rho} * sin({theta})"


_GRID = _with(
    ["gps_raw"],
    f"""
    SELECT vehicle_id, lat, lon, round({_grid('lat', 'lon')[0]}, 3) AS northing,
           round({_grid('lat', 'lon')[1]}, 3) AS easting
    FROM positions CROSS JOIN cone
    """,
    _POSITIONS,
    _CONE,
)

# one line's vehicle with one destination against one stop
_PAIRS = """pairs AS (
    SELECT p.*, s.stop_id, s.stop_lat, s.stop_lon
    FROM positions AS p CROSS JOIN gtfs_stops AS s
    WHERE s.stop_id = '3' AND p.line_number = '7' AND p.fleet_number = '0007'
      AND lower(p.destination) = 'männiku'
)"""

# every position against the stop with the number of its line
_LINE_PAIRS = """pairs AS (
    SELECT p.*, s.stop_id, s.stop_lat, s.stop_lon
    FROM positions AS p JOIN gtfs_stops AS s ON s.stop_id = p.line_number
)"""

_MEAN = "radians((lat + stop_lat) / 2)"
_PLANAR = (
    f"sqrt(pow((lat - stop_lat) * (111132.954 - 559.822 * cos(2 * {_MEAN}) "
    f"+ 1.175 * cos(4 * {_MEAN})), 2) "
    f"+ pow((lon - stop_lon) * (111412.84 * cos({_MEAN}) - 93.5 * cos(3 * {_MEAN})), 2))"
)
_SPHERE = (
    "2 * 6370986 * asin(least(1, sqrt(pow(sin(radians(lat - stop_lat) / 2), 2) "
    "+ cos(radians(lat)) * cos(radians(stop_lat)) * pow(sin(radians(lon - stop_lon) / 2), 2))))"
)
_PROJECTED = (
    f"sqrt(pow(({_grid('lat', 'lon')[0]}) - ({_grid('stop_lat', 'stop_lon')[0]}), 2) "
    f"+ pow(({_grid('lat', 'lon')[1]}) - ({_grid('stop_lat', 'stop_lon')[1]}), 2))"
)


def _geodesic(pairs: str, steps: int = 12) -> str:
    """Vincenty's inverse formula over rows of `pairs`, one nested select per step."""
    sql = f"""
        SELECT *, l AS lam, sin(u1) AS su1, cos(u1) AS cu1, sin(u2) AS su2, cos(u2) AS cu2
        FROM (SELECT *, (1 - f) * a AS b, radians(lon - stop_lon) AS l,
                     atan((1 - f) * tan(radians(lat))) AS u1,
                     atan((1 - f) * tan(radians(stop_lat))) AS u2
              FROM (SELECT *, CAST(6378137 AS DOUBLE) AS a,
                           CAST(1 AS DOUBLE) / 298.257223563 AS f FROM {pairs}) AS q) AS q
    """
    step = """
        SELECT * EXCLUDE (lam, ss, cs, sg, sa, c2a, c2m, cc),
               ss AS ss_, cs AS cs_, sg AS sg_, c2a AS c2a_, c2m AS c2m_,
               l + (1 - cc) * f * sa * (sg + cc * ss * (c2m + cc * cs * (2 * c2m * c2m - 1))) AS lam
        FROM (SELECT *, f / 16 * c2a * (4 + f * (4 - 3 * c2a)) AS cc,
                     CASE WHEN c2a = 0 THEN 0 ELSE cs - 2 * su1 * su2 / c2a END AS c2m
        FROM (SELECT *, 1 - sa * sa AS c2a
        FROM (SELECT *, atan2(ss, cs) AS sg,
                     CASE WHEN ss = 0 THEN 0 ELSE cu1 * cu2 * sin(lam) / ss END AS sa
        FROM (SELECT * {dropped},
                     sqrt(pow(cu2 * sin(lam), 2)
                          + pow(cu1 * su2 - su1 * cu2 * cos(lam), 2)) AS ss,
                     su1 * su2 + cu1 * cu2 * cos(lam) AS cs
        FROM ({inner}) AS q) AS q) AS q) AS q) AS q
    """
    for number in range(steps):
        dropped = "EXCLUDE (ss_, cs_, sg_, c2a_, c2m_)" if number else ""
        sql = step.format(inner=sql, dropped=dropped)
    return f"""
        SELECT *, b * ka * (sg_ - kb * ss_ * (c2m_ + kb / 4 * (cs_ * (2 * c2m_ * c2m_ - 1)
                   - kb / 6 * c2m_ * (4 * ss_ * ss_ - 3) * (4 * c2m_ * c2m_ - 3)))) AS metres
        FROM (SELECT *, 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu))) AS ka,
                     uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu))) AS kb
              FROM (SELECT *, c2a_ * (a * a - b * b) / (b * b) AS uu FROM ({sql}) AS q) AS q) AS q
    """


_VISIBLE = f"{_TS.format('extract_ts')} AS extract_ts, vehicle_id, fleet_number, lat, lon"


def _distance(name: str, formula: str, source: str = "pairs", *more: str) -> str:
    return _with(
        ["gps_raw", "gtfs_stops"],
        f"SELECT {_VISIBLE}, round({formula}, 3) AS {name} FROM {source}",
        _POSITIONS,
        _PAIRS,
        *more,
    )


_TARGETS = _with(
    ["gps_raw", "gtfs_stops"],
    f"""
    SELECT {_TS.format('extract_ts')} AS extract_ts, vehicle_id, line_number, stop_id, lat, lon,
           round({_PLANAR}, 3) AS planar_m, round({_SPHERE}, 3) AS sphere_m,
           round(metres, 3) AS spheroid_m
    FROM ({_geodesic('pairs')}) AS measured
    """,
    _POSITIONS,
    _LINE_PAIRS,
)

ORACLES: dict[str, str] = {
    "scan_headerless_csv": _with(["gps_raw"], f"SELECT {_RAW_TEXT} FROM gps_raw"),
    "scan_string_csv_cast": _with(
        ["gtfs_stop_times"],
        "SELECT trip_id, arrival_time, departure_time, stop_id, stop_sequence "
        "FROM gtfs_stop_times",
    ),
    "scan_zip_members": _PLACES,
    "archive_status": _ARCHIVES,
    "unpack_archives": _PLACES,
    "scan_hive_partitions": _stop_extracts(STOP_EXTRACTS),
    "latest_extract": _stop_extracts(STOP_EXTRACTS[1:]),
    "csv_date_format": _with(
        ["gtfs_calendar_dates"],
        "SELECT service_id, strftime(date, '%Y%m%d') AS written, "
        "CAST(date AS VARCHAR) AS date FROM gtfs_calendar_dates",
    ),
    "discover_dates": "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS extract_date "
    "FROM events",
    "std_gps_positions": _with(
        ["gps_raw"],
        f"SELECT {_STD}, {_TS.format('snapshot_ts')} AS extract_ts, "
        "CAST(CAST(snapshot_ts AS DATE) AS VARCHAR) AS extract_date FROM gps_raw",
    ),
    "std_gps_lenient": _with(
        ["gps_raw"],
        f"SELECT {_STD}, CASE WHEN NOT {_NAMELESS} THEN {_TS.format('snapshot_ts')} END "
        "AS extract_ts, CAST(CAST(snapshot_ts AS DATE) AS VARCHAR) AS extract_date FROM gps_raw",
    ),
    **{f"std_{name}": _std_gtfs(name) for name in GTFS_TABLES},
    "union_snapshots": _with(
        ["gps_raw"],
        f"SELECT {', '.join(GPS_RAW_COLUMNS)}, {_TS.format('snapshot_ts')} AS snapshot_ts "
        "FROM gps_raw",
    ),
    "write_skip_existing": _TWO_WRITES,
    "write_overwrite": _TWO_WRITES,
    "replace_table": _with(
        ["gtfs_trips"], "SELECT trip_id, route_id, service_id, trip_headsign FROM gtfs_trips"
    ),
    "backfill_range": _BACKFILL,
    "backfill_isolation": _ISOLATION,
    "rejected_rows": _with(
        ["gps_raw"],
        f"SELECT {_RAW_TEXT}, CAST(CAST(snapshot_ts AS DATE) AS VARCHAR) AS extract_date "
        f"FROM gps_raw WHERE {_NAMELESS}",
    ),
    "upsert_control": _UPSERT,
    "upsert_control_table": _UPSERT,
    "control_defaults": "SELECT 'vehicle-' || CAST(user_id AS VARCHAR) AS source, "
    "CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS extract_date, true AS active, "
    "CAST(NULL AS VARCHAR) AS comment, 1 AS stamped FROM events GROUP BY user_id",
    "resolve_extract_date": _RESOLVE,
    "scan_resolved_date": _with(
        ["gps_raw"],
        f"SELECT {_STD}, {_TS.format('snapshot_ts')} AS extract_ts, "
        "CAST(CAST(snapshot_ts AS DATE) AS VARCHAR) AS extract_date FROM gps_raw "
        "WHERE CAST(snapshot_ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)",
    ),
    "scan_resolved_partition": _with(
        ["gps_raw"],
        f"SELECT CAST(vehicle_id AS VARCHAR) AS vehicle_id, {_TS.format('extract_ts')} AS extract_ts, lat, lon, "
        "transport_type, CAST(day AS VARCHAR) AS extract_date FROM positions "
        "WHERE day = (SELECT max(CAST(ts AS DATE)) FROM events)",
        _POSITIONS,
    ),
    "find_vehicle": _with(
        ["gps_raw"],
        f"SELECT {_STD}, {_TS.format('snapshot_ts')} AS extract_ts, "
        "CAST(CAST(snapshot_ts AS DATE) AS VARCHAR) AS extract_date FROM gps_raw "
        "WHERE fleet_number = '0007'",
    ),
    "local_time_window": _WINDOW,
    "scheduled_trips": _SCHEDULED,
    "scheduled_trips_bucketed": _SCHEDULED,
    "travel_duration": _TRAVEL,
    "stop_distance_planar": _distance("planar_m", _PLANAR),
    "stop_distance_projected": _distance(
        "projected_m", _PROJECTED, "pairs CROSS JOIN cone", _CONE
    ),
    "stop_distance_sphere": _distance("sphere_m", _SPHERE),
    "stop_distance_spheroid": _distance("spheroid_m", "metres", f"({_geodesic('pairs')}) AS m"),
    "stop_distance_numeric_id": _distance("planar_m", _PLANAR)
    .replace("s.stop_id = '3'", "TRY_CAST(s.stop_id AS BIGINT) = 3")
    .replace("p.fleet_number = '0007'", "TRY_CAST(p.fleet_number AS BIGINT) = 7"),
    "stop_distance_far": _distance("spheroid_m", "metres", f"({_geodesic('pairs')}) AS m").replace(
        "s.stop_lat, s.stop_lon", "-s.stop_lat / 2 AS stop_lat, s.stop_lon + 120 AS stop_lon"
    ),
    "stop_distance_targets": _TARGETS,
    "project_lest97": _GRID,
    "shift_partitions": _with(["gps_raw"], _SHIFTED),
    "shift_counts": _with(
        ["gps_raw"],
        f"SELECT count(*) AS total, count(*) FILTER (WHERE action = 'move') AS changed "
        f"FROM ({_SHIFTED}) AS plan",
    ),
    "shift_apply": _SHIFT_APPLY,
    "shift_files": _with(["gps_raw"], _SHIFTED_FILES),
    "rename_partition_key": _RENAMED,
    "rename_folders": _RENAMED,
    "rename_plan": "SELECT DISTINCT 'date=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS old_folder, "
    "'extract_date=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS new_folder FROM events",
    "validate_layer": _VALIDATE,
    "stream_gps_positions": _with(
        ["gps_raw"],
        f"SELECT {_STD}, {_TS.format('snapshot_ts')} AS extract_ts, "
        "CAST(CAST(snapshot_ts AS DATE) AS VARCHAR) AS extract_date FROM gps_raw",
    ),
    "stream_and_backfill": _with(
        ["gps_raw"],
        f"SELECT {_STD}, {_TS.format('snapshot_ts')} AS extract_ts, "
        "CAST(CAST(snapshot_ts AS DATE) AS VARCHAR) AS extract_date FROM gps_raw",
    ),
    "compact_dates": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS stored, "
    "CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events) AS closed, "
    "true AS within_bound FROM events GROUP BY CAST(ts AS DATE)",
}
