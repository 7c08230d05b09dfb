"""Readers of the landing area.

    <root>/extract_source=gps/extract_date=D/gps_YYYYMMDD_HHMMSS.csv
    <root>/extract_source=gtfs/extract_date=D/extract_ts=YYYYMMDD_HHMMSS/<member>.txt

A file may also be a folder of parts that a Spark job wrote; such a folder is
named `<key>=<file name>`.
"""

from __future__ import annotations

import csv
from datetime import date
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.schemas import GPS_RAW_COLUMNS, GTFS_TABLES, gtfs_member
from headway.sources.store import Store

# A line of another number of fields than the layout is kept as it is in MALFORMED. With
# column pruning the parser would count only the fields that a query asks for.
MALFORMED = "malformed"
CSV_OPTIONS = {
    "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED,
    "columnPruning": "false",
}

# Tables with free text, in which a quoted line break is part of a value. Their files are
# small, as one is read by one task.
FREE_TEXT = {"gtfs_routes", "gtfs_trips", "gtfs_stops"}

FOLDER_KEYS = ("extract_source", "extract_date", "extract_ts", "member")


def iso(day: date | str) -> str:
    return day if isinstance(day, str) else day.isoformat()


def date_glob(root: str, source: str, dates: list[date | str] | None = None) -> str:
    """Date folders of a source: all, or those of the given dates that exist.

    Only these folders are listed, so a short backfill of a long history does not
    pay for the history.
    """
    base = f"{root}/extract_source={source}"
    if dates is None:
        return f"{base}/extract_date=*"
    if not dates:
        raise ValueError("no dates to read")
    return f"{base}/extract_date={{{','.join(iso(day) for day in dates)}}}"


def list_files(spark: SparkSession, paths: list[str], like: str = "*") -> DataFrame:
    """One row per file: its path, size and time. No file is opened.

    Folder keys are taken from the path with `folder_value`, so that files at
    different depths, such as archives beside unpacked extracts, can be listed
    together.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", like)
        .load(paths)
        .drop("content")
    )


def folder_value(key: str) -> Column:
    """The value of `key=value` in a listed path, '' if there is none."""
    return F.regexp_extract("path", f"/{key}=([^/]+)/", 1)


def files_or_none(spark: SparkSession, paths: list[str], like: str = "*") -> DataFrame | None:
    """`list_files`, or None where nothing has been written yet."""
    try:
        files = list_files(spark, paths, like)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return files


def discover_dates(
    spark: SparkSession, root: str, source: str, dates: list[date | str] | None = None
) -> DataFrame:
    """Landed dates, all or out of the given ones, oldest first: the names of their folders.

    Only the source's own folder is listed, so what lies in the dates costs nothing.
    """
    base = f"{root}/extract_source={source}"
    found = {date.fromisoformat(day) for day in Store(spark, root).folders(base, "extract_date")}
    if dates is not None:
        found &= {date.fromisoformat(iso(day)) for day in dates}
    return spark.createDataFrame([(day,) for day in sorted(found)], "extract_date date")


# ---- vehicle positions ------------------------------------------------------


def gps_raw_schema() -> str:
    """All text: a typed reader would turn bad numbers into nulls silently."""
    return ", ".join(f"{name} string" for name in [*GPS_RAW_COLUMNS, MALFORMED])


# Snapshots and part folders may lie beside each other, so folder keys are taken from the
# path and not inferred; a file that does not end in .csv is still being written.
GPS_OPTIONS = {**CSV_OPTIONS, "recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}


def read_gps(
    spark: SparkSession, root: str, dates: list[date | str] | None = None
) -> DataFrame:
    """Snapshot rows as text, with `extract_date`, the `snapshot_file` path and `malformed`,
    the line itself where it has too few or too many fields.

    A date without files adds no rows.
    """
    reader = spark.read.schema(gps_raw_schema()).options(**GPS_OPTIONS)
    try:
        rows = reader.csv([date_glob(root, "gps", dates)])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        names = [*GPS_RAW_COLUMNS, MALFORMED, "extract_date", "snapshot_file"]
        return spark.createDataFrame([], ", ".join(f"{name} string" for name in names))
    return with_snapshot_file(rows)


def with_snapshot_file(rows: DataFrame) -> DataFrame:
    return rows.select(
        *GPS_RAW_COLUMNS,
        MALFORMED,
        F.regexp_extract("_metadata.file_path", "/extract_date=([^/]+)/", 1).alias("extract_date"),
        F.col("_metadata.file_path").alias("snapshot_file"),
    )


def check_dates(asked: list[date | str] | None, found: set[str], what: str) -> None:
    """Every asked date must have its schedule; without asked dates there must be one."""
    missing = sorted({iso(day) for day in asked or []} - found)
    if missing or not found:
        raise FileNotFoundError(f"no {what} for {', '.join(missing) or 'any date'}")


# ---- schedule extracts ------------------------------------------------------


def list_extracts(
    spark: SparkSession, root: str, table: str, dates: list[date | str] | None = None
) -> DataFrame:
    """Extracts holding the table: (extract_date, extract_ts, parts), text.

    `parts` tells a folder that Spark wrote from a plain file, which wins if
    there are both. Only `extract_ts=` folders are looked at: an interrupted
    unpack leaves stray ones beside them.
    """
    member = gtfs_member(table)
    folders = f"{date_glob(root, 'gtfs', dates)}/extract_ts=*"
    files = files_or_none(spark, [f"{folders}/{{{member},member={member}}}"])
    if files is None:
        return spark.createDataFrame([], "extract_date string, extract_ts string, parts boolean")
    return (
        files.groupBy(
            folder_value("extract_date").alias("extract_date"),
            folder_value("extract_ts").alias("extract_ts"),
        )
        .agg(F.min(folder_value("member") != "").alias("parts"))
    )


def latest_extracts(extracts: DataFrame) -> DataFrame:
    """Newest extract of each date."""
    return extracts.groupBy("extract_date").agg(
        F.max_by("parts", "extract_ts").alias("parts"), F.max("extract_ts").alias("extract_ts")
    )


class Extract(NamedTuple):
    """One landed schedule table: its folders' values, its path and the header of its file."""

    extract_date: str
    extract_ts: str
    path: str
    columns: tuple[str, ...]

    def lacks(self, table: str) -> list[str]:
        return [c for c in GTFS_TABLES[table] if c not in self.columns]


def header_columns(line: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([line.removeprefix("\ufeff")]), ()))


def schedule_extracts(
    spark: SparkSession,
    root: str,
    table: str,
    dates: list[date | str] | None = None,
    extracts: str = "latest",
) -> list[Extract]:
    """The extracts to read with their headers, of which only the first line is read.

    Folder names, not data: a scan needs them as its paths.
    """
    if table not in GTFS_TABLES:
        raise ValueError(f"unknown table {table!r}")
    if extracts not in ("latest", "all"):
        raise ValueError(f"extracts must be 'latest' or 'all', not {extracts!r}")
    chosen = list_extracts(spark, root, table, dates)
    if extracts == "latest":
        chosen = latest_extracts(chosen)
    names = sorted(chosen.select("extract_date", "extract_ts", "parts").collect())
    store, member = Store(spark, root), gtfs_member(table)
    # the names are the paths of the files of a scan, and no more than those
    paths = [
        f"{root}/extract_source=gtfs/extract_date={day}/extract_ts={stamp}/"
        f"{'member=' if parts else ''}{member}"
        for day, stamp, parts in names
    ]
    heads = store.first_lines([store.first_file(path) for path in paths])
    return [
        Extract(day, stamp, path, header_columns(line))
        for (day, stamp, _), path, line in zip(names, paths, heads)
    ]


def read_gtfs(
    spark: SparkSession,
    root: str,
    table: str,
    dates: list[date | str] | None = None,
    extracts: str = "latest",
    multiline: bool | None = None,
    headers: str = "same",
) -> DataFrame:
    """A schedule table as text columns plus `extract_date`, `extract_ts` and `malformed`,
    the line itself where its number of fields differs from the header's.

    By default only the newest extract of each date is read; "all" reads every
    one. Columns are found by header name: extra ones are dropped, a missing one
    is an error. Files whose headers disagree are refused, not misread, unless `headers` is
    "any": then all files of one header are one scan, however many dates there are. Line
    breaks within quotes are read in the tables with free text, or as `multiline` says.
    """
    if headers not in ("same", "any"):
        raise ValueError(f"headers must be 'same' or 'any', not {headers!r}")
    found = schedule_extracts(spark, root, table, dates, extracts)
    check_dates(dates, {e.extract_date for e in found}, gtfs_member(table))
    return read_extracts(spark, root, table, found, multiline, headers)


def read_extracts(
    spark: SparkSession,
    root: str,
    table: str,
    found: list[Extract],
    multiline: bool | None = None,
    headers: str = "any",
) -> DataFrame:
    """The rows of the given extracts; one scan for each distinct header."""

    def scan(columns: tuple[str, ...], paths: list[str]) -> DataFrame:
        # with the raw line as a column every field is parsed, so none goes uncounted
        schema = ", ".join(f"`{c}` string" for c in [*columns, MALFORMED])
        return (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("multiLine", table in FREE_TEXT if multiline is None else multiline)
            .options(**CSV_OPTIONS)
            .option("basePath", root)
            .csv(paths)
        )

    frames = []
    # plain files and folders of parts have other partition columns
    for folder in (f"/{gtfs_member(table)}", f"/member={gtfs_member(table)}"):
        alike = [e for e in found if e.path.endswith(folder)]
        for head in {e.columns: e for e in reversed(alike)}.values() if headers == "any" else alike[:1]:
            if missing := head.lacks(table):
                raise ValueError(f"{gtfs_member(table)} of {head.extract_date} lacks {', '.join(missing)}")
            # with "same" files of another header are read along, and refused by the reader
            paths = [e.path for e in alike if headers == "same" or e.columns == head.columns]
            frames.append(_schedule_columns(scan(head.columns, paths), table))
    return reduce(DataFrame.unionByName, frames)


def _schedule_columns(rows: DataFrame, table: str) -> DataFrame:
    return rows.select(
        *GTFS_TABLES[table],
        MALFORMED,
        F.col("extract_date").cast("string").alias("extract_date"),
        F.col("extract_ts").cast("string").alias("extract_ts"),
    )
