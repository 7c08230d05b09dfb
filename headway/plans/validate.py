"""Checks over the standardized tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.schemas import layout

# Coordinates outside these bounds are counted; ours to choose: Estonia and its waters.
LAT_BOUNDS = (57.0, 60.5)
LON_BOUNDS = (21.0, 29.0)

KEYS = {
    "gps_positions": ["vehicle_id", "extract_ts"],
    "gtfs_routes": ["route_id"],
    "gtfs_trips": ["trip_id", "route_id", "service_id"],
    "gtfs_stops": ["stop_id"],
    "gtfs_stop_times": ["trip_id", "stop_id"],
    "gtfs_calendar": ["service_id"],
    "gtfs_calendar_dates": ["service_id", "date"],
}

COORDINATES = {"gps_positions": ("lat", "lon"), "gtfs_stops": ("stop_lat", "stop_lon")}


def schema_faults(df: DataFrame, table: str) -> int:
    """Columns of the layout that are missing or of another type."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    return sum(found.get(name) != kind for name, kind in layout(table).items())


def _outside(column: str, bounds: tuple[float, float]) -> Column:
    return F.col(column).isNull() | ~F.col(column).between(*bounds)


def validate_table(df: DataFrame, table: str, partition: str = "date") -> DataFrame:
    """(model, check, value) rows from one aggregate over the table."""
    checks = {
        "schema_faults": F.lit(schema_faults(df, table)).cast("bigint"),
        "rows": F.count("*"),
        "partitions": F.count_distinct(F.col(partition)),
        "null_keys": F.count_if(reduce(Column.__or__, [F.col(k).isNull() for k in KEYS[table]])),
    }
    if table in COORDINATES:
        lat, lon = COORDINATES[table]
        checks["out_of_bounds"] = F.count_if(_outside(lat, LAT_BOUNDS) | _outside(lon, LON_BOUNDS))
    totals = df.agg(*[value.alias(name) for name, value in checks.items()])
    return totals.unpivot([], list(checks), "check", "value").select(
        F.lit(table).alias("model"), "check", "value"
    )


def validate_layer(tables: dict[str, DataFrame], partition: str = "date") -> DataFrame:
    """The checks of all given tables."""
    return reduce(
        DataFrame.unionByName,
        [validate_table(df, name, partition) for name, df in tables.items()],
    )
