"""The standardized tables: text rows in, typed and cleaned rows out."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.casting import LENIENT, STRICT, stamp_to_instant, typed, unreadable
from headway.schemas import (
    GTFS_TABLES,
    HEADING_UNKNOWN,
    MICRO_DEGREES,
    SNAPSHOT_PREFIX,
    SNAPSHOT_SUFFIX,
)
from headway.sources.landing import MALFORMED

GPS_NUMBERS = {
    "transport_type": "int",
    "longitude_raw": "bigint",
    "latitude_raw": "bigint",
    "speed_kmh": "int",
    "heading_deg": "int",
}


def with_stamp(raw: DataFrame) -> DataFrame:
    """Add `_stamp`, the `YYYYMMDD_HHMMSS` of `gps_<stamp>.csv` in the path, else null.

    Columns of their own, as text inside a larger expression is cut anew at every use.
    """
    tail = F.substring_index("snapshot_file", SNAPSHOT_PREFIX, -1)
    # the name ends here, or goes on as a folder of parts
    rest = F.substring("_tail", 16, len(SNAPSHOT_SUFFIX) + 1)
    named = rest.isin(SNAPSHOT_SUFFIX, f"{SNAPSHOT_SUFFIX}/")
    stamp = F.when(named, F.substring("_tail", 1, 15))
    return raw.withColumn("_tail", tail).withColumn("_stamp", stamp).drop("_tail")


def with_malformed(raw: DataFrame) -> DataFrame:
    """Rows that come from elsewhere than a raw file have no malformed lines."""
    if MALFORMED in raw.columns:
        return raw
    return raw.withColumn(MALFORMED, F.lit(None).cast("string"))


def well_formed(column: Column, mode: str) -> Column:
    """`column`; strict fails here on a line with too few or too many fields."""
    if mode == LENIENT:
        return column
    line = F.concat(F.lit("wrong number of fields: "), MALFORMED)
    return F.when(F.col(MALFORMED).isNotNull(), F.raise_error(line)).otherwise(column)


def standardize_gps(raw: DataFrame, mode: str = STRICT, keep: tuple[str, ...] = ()) -> DataFrame:
    """Vehicle positions: degrees, unknown headings as null, the snapshot's instant.

    Strict fails on text that is no number and on a badly named file; lenient
    turns both into nulls. Keeps `extract_date`, the date folder of the row, and the
    columns in `keep`.
    """

    raw = with_malformed(raw)

    def number(name: str) -> Column:
        return typed(F.col(name), GPS_NUMBERS[name], mode)

    return with_stamp(raw).select(
        well_formed(number("transport_type"), mode).alias("transport_type"),
        "line_number",
        number("speed_kmh").alias("speed_kmh"),
        "vehicle_id",
        "floor_type",
        "fleet_number",
        "destination",
        (number("latitude_raw") / F.lit(MICRO_DEGREES)).alias("lat"),
        (number("longitude_raw") / F.lit(MICRO_DEGREES)).alias("lon"),
        F.nullif(number("heading_deg"), F.lit(HEADING_UNKNOWN)).alias("heading_deg"),
        stamp_to_instant(F.col("_stamp"), mode).alias("extract_ts"),
        F.current_timestamp().alias("updated_ts"),
        F.col("extract_date").cast("date").alias("extract_date"),
        *keep,
    )


def bad_gps_rows(raw: DataFrame) -> DataFrame:
    """Raw rows with `bad`: would strict standardization fail on this one?"""
    checks = [unreadable(F.col(name), kind) for name, kind in GPS_NUMBERS.items()]
    checks.append(stamp_to_instant(F.col("_stamp"), LENIENT).isNull())
    checks.append(F.col(MALFORMED).isNotNull())
    return with_stamp(with_malformed(raw)).withColumn("bad", reduce(or_, checks)).drop("_stamp")


def standardize_gtfs(
    raw: DataFrame, table: str, mode: str = STRICT, keep: tuple[str, ...] = ()
) -> DataFrame:
    """A schedule table with its columns cast and the extract's instant."""
    first, *columns = [
        typed(F.col(name), kind, mode) for name, kind in GTFS_TABLES[table].items()
    ]
    columns = [well_formed(first, mode), *columns]
    return with_malformed(raw).select(
        *(column.alias(name) for column, name in zip(columns, GTFS_TABLES[table])),
        # the folder name is optional information in every variant: never fatal
        stamp_to_instant(F.col("extract_ts"), LENIENT).alias("extract_ts"),
        F.current_timestamp().alias("updated_ts"),
        F.col("extract_date").cast("date").alias("extract_date"),
        *keep,
    )


def bad_gtfs_rows(raw: DataFrame, table: str) -> DataFrame:
    """Raw rows with `bad`: would strict standardization fail on this one?"""
    checks = [unreadable(F.col(name), kind) for name, kind in GTFS_TABLES[table].items()]
    checks.append(F.col(MALFORMED).isNotNull())
    return with_malformed(raw).withColumn("bad", reduce(or_, checks))
