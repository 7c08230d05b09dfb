"""Distances of vehicle positions to stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.geo import (
    grid_metres,
    planar_metres,
    project_lest97,
    sphere_metres,
    spheroid_metres,
)

METHODS = ("planar", "projected", "sphere", "spheroid")

POSITION_COLUMNS = ["extract_ts", "vehicle_id", "fleet_number", "line_number", "lat", "lon"]

TARGET_KEYS = ["line_number", "destination_key", "fleet_number"]


def with_grid(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Add L-EST97 `northing` and `easting`."""
    northing, easting = project_lest97(F.col(lat), F.col(lon))
    return df.withColumns({"northing": northing, "easting": easting})


def with_distances(df: DataFrame, methods: tuple[str, ...] = METHODS) -> DataFrame:
    """Add a metres column per method for rows with `lat, lon, stop_lat, stop_lon`.

    planar_m     degree lengths at the mean latitude, Pythagoras
    projected_m  L-EST97 grid, Pythagoras
    sphere_m     haversine
    spheroid_m   WGS84 geodesic
    """
    unknown = set(methods) - set(METHODS)
    if unknown:
        raise ValueError(f"unknown methods {sorted(unknown)}, know {METHODS}")
    ends = (F.col("lat"), F.col("lon"), F.col("stop_lat"), F.col("stop_lon"))
    columns = {}
    if "planar" in methods:
        columns["planar_m"] = planar_metres(*ends)
    if "projected" in methods:
        columns["projected_m"] = grid_metres(
            *project_lest97(*ends[:2]), *project_lest97(*ends[2:])
        )
    if "sphere" in methods:
        columns["sphere_m"] = sphere_metres(*ends)
    if "spheroid" in methods:
        columns["spheroid_m"] = spheroid_metres(*ends)
    return df.withColumns(columns)


def _is_id(column: str, value: str, numeric: bool) -> Column:
    if numeric and value.isascii() and value.isdigit():
        return F.col(column).try_cast("bigint") == int(value)
    return F.col(column) == value


def stop_distances(
    positions: DataFrame,
    stops: DataFrame,
    *,
    line: str,
    destination: str,
    fleet_number: str,
    stop_id: str,
    methods: tuple[str, ...] = METHODS,
    ordered: bool = True,
    numeric_ids: bool = False,
) -> DataFrame:
    """Distance of every position of one vehicle on a line to one stop.

    With `numeric_ids` a fleet number or stop id that is a number meets every way
    of writing that number, such as `89` and `0089`; other ids are compared as text.

    The stop enters as a scalar subquery, so the positions are filtered and
    measured in one pass without a join. A stop id that is not unique fails the
    query; an unknown one gives no rows.
    """
    stop = (
        stops.filter(_is_id("stop_id", stop_id, numeric_ids))
        .select(F.struct("stop_lat", "stop_lon").alias("stop"))
        .scalar()
    )
    measured = (
        positions.filter(F.col("line_number") == line)
        .filter(F.lower("destination") == destination.lower())
        .filter(_is_id("fleet_number", fleet_number, numeric_ids))
        .select(*POSITION_COLUMNS, stop.alias("stop"))
        .filter(F.col("stop").isNotNull())
        .select(
            *POSITION_COLUMNS,
            F.col("stop.stop_lat").alias("stop_lat"),
            F.col("stop.stop_lon").alias("stop_lon"),
        )
    )
    out = with_distances(measured, methods)
    return out.orderBy("extract_ts", "vehicle_id") if ordered else out


def distances_to_targets(
    positions: DataFrame,
    stops: DataFrame,
    targets: DataFrame,
    methods: tuple[str, ...] = METHODS,
) -> DataFrame:
    """Many such questions at once: `targets` holds question rows.

    Its columns are `stop_id` and any of line_number, destination (case does not
    matter) and fleet_number. Positions meet their targets by equality of these
    columns; nothing is crossed. Adaptive execution broadcasts the targets if
    their measured bytes are few, and splits a line that many positions have.
    """
    asked = targets
    if "destination" in targets.columns:
        asked = asked.withColumn("destination_key", F.lower("destination")).drop("destination")
        positions = positions.withColumn("destination_key", F.lower("destination"))
    keys = [k for k in TARGET_KEYS if k in asked.columns]
    if not keys:
        raise ValueError(f"targets need one of {TARGET_KEYS}")
    placed = asked.select(*keys, "stop_id").join(
        stops.select("stop_id", "stop_lat", "stop_lon"), "stop_id"
    )
    columns = dict.fromkeys([*POSITION_COLUMNS, *keys])
    joined = positions.select(*columns).join(placed, keys)
    return with_distances(
        joined.select(*POSITION_COLUMNS, "stop_id", "stop_lat", "stop_lon"), methods
    )
