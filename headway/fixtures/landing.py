"""Raw landing areas written from the adapter views, in the feeds' own layout."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.fixtures.adapter import VIEWS, table, view
from headway.schemas import GPS_RAW_COLUMNS, GTFS_DATE_FORMAT, GTFS_TABLES, gtfs_member
from headway.session import shared_folder
from headway.sources.landing import CSV_OPTIONS

EXTRACT_DATE = "2024-01-31"
EXTRACT_TS = "20240131_040000"

# rows of the keyed tables per archive: an archive is one file and must stay small
ARCHIVE_KEYS = 50_000

# Landing areas are inputs shared by several queries of a session.
_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        root = shared_folder(spark, name)
        write(root)
        _WRITTEN[key] = root
    return _WRITTEN[key]


def _write_snapshots(rows: DataFrame, root: str, file_name: Column, day: Column | None = None) -> None:
    """Headerless snapshot files; rows carry `snapshot_ts` and a `row_id`."""
    day = F.to_date("snapshot_ts") if day is None else day
    spark = rows.sparkSession
    # a fixed count: otherwise small inputs are gathered into one slow writer
    tasks = max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    (
        rows.select(
            F.lit("gps").alias("extract_source"),
            day.alias("extract_date"),
            file_name.alias("file"),
            "row_id",
            *GPS_RAW_COLUMNS,
        )
        # the row id lets a busy hour spread over several tasks and part files
        .repartitionByRange(tasks, "extract_date", "file", "row_id")
        .drop("row_id")
        .write.mode("append")
        .partitionBy("extract_source", "extract_date", "file")
        .options(**CSV_OPTIONS)
        .csv(root)
    )


def _gps_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    texts = [f"{text} AS {name}" for name, text in VIEWS["gps_raw"][1].items()]
    return events.selectExpr(*texts, "event_id AS row_id")


SNAPSHOT_NAME = "'gps_'yyyyMMdd_HHmmss'.csv'"


def gps_landing(spark: SparkSession, sf_dir: str) -> str:
    """Hourly snapshots of all positions."""

    def write(root: str) -> None:
        rows = _gps_rows(spark, sf_dir)
        _write_snapshots(rows, root, F.date_format("snapshot_ts", SNAPSHOT_NAME))

    return _once(spark, sf_dir, "gps-landing", write)


def gps_landing_misnamed(spark: SparkSession, sf_dir: str) -> str:
    """The same, but on odd days the first hour is filed under a name without an instant."""

    def write(root: str) -> None:
        rows = _gps_rows(spark, sf_dir)
        named = F.date_format("snapshot_ts", SNAPSHOT_NAME)
        nameless = (F.hour("snapshot_ts") == 0) & (F.day("snapshot_ts") % 2 == 1)
        name = F.when(nameless, "gps_latest.csv").otherwise(named)
        _write_snapshots(rows, root, name)

    return _once(spark, sf_dir, "gps-landing-misnamed", write)


def refiled_landing(spark: SparkSession, sf_dir: str) -> str:
    """Snapshots under their UTC and again under their local date, some without an instant.

    A new one each time, as what is done with it moves its files.
    """
    named = F.date_format("snapshot_ts", SNAPSHOT_NAME)
    nameless = (F.hour("snapshot_ts") == 0) & (F.day("snapshot_ts") % 2 == 1)
    local = F.expr("snapshot_ts + INTERVAL 3 HOURS")
    days = F.array_distinct(F.array(F.to_date("snapshot_ts"), F.to_date(local)))
    root = shared_folder(spark, "gps-landing-refiled")
    rows = _gps_rows(spark, sf_dir).withColumn("filed", F.explode(days))
    _write_snapshots(rows, root, F.when(nameless, "gps_latest.csv").otherwise(named), F.col("filed"))
    return root


def as_member(df: DataFrame, name: str) -> DataFrame:
    """A view as the text columns of its schedule file; columns it lacks are empty."""
    texts = []
    for column, kind in GTFS_TABLES[name].items():
        if column not in df.columns:
            texts.append(F.lit(None).cast("string").alias(column))
        elif kind == "date":
            texts.append(F.date_format(column, GTFS_DATE_FORMAT).alias(column))
        else:
            texts.append(F.col(column).cast("string").alias(column))
    return df.select(*texts)


def _write_member(
    df: DataFrame, root: str, name: str, day: str = EXTRACT_DATE, stamp: str = EXTRACT_TS
) -> None:
    (
        as_member(df, name)
        .withColumn("feed_version", F.lit("7"))  # a column no table keeps
        .withColumns(
            {
                "extract_source": F.lit("gtfs"),
                "extract_date": F.lit(day),
                "extract_ts": F.lit(stamp),
                "member": F.lit(gtfs_member(name)),
            }
        )
        .write.mode("append")
        .partitionBy("extract_source", "extract_date", "extract_ts", "member")
        .option("header", True)
        .options(**CSV_OPTIONS)
        .csv(root)
    )


def gtfs_landing(spark: SparkSession, sf_dir: str, name: str) -> str:
    """One unpacked extract of one schedule table."""

    def write(root: str) -> None:
        _write_member(view(spark, sf_dir, name), root, name)

    return _once(spark, sf_dir, f"{name}-landing", write)


# three extracts of all stops: two on one day, one on the next
STOP_EXTRACTS = [
    ("2024-01-31", "20240131_040000", "early"),
    ("2024-01-31", "20240131_160000", "late"),
    ("2024-02-01", "20240201_040000", "next"),
]


def stops_landing(spark: SparkSession, sf_dir: str) -> str:
    def write(root: str) -> None:
        stops = view(spark, sf_dir, "gtfs_stops")
        for day, stamp, tag in STOP_EXTRACTS:
            tagged = stops.withColumn("stop_desc", F.lit(tag))
            _write_member(tagged, root, "gtfs_stops", day, stamp)

    return _once(spark, sf_dir, "stops-landing", write)


def _csv_lines(df: DataFrame, name: str, key: Column) -> DataFrame:
    """Text lines of a member, each with the number of the archive it goes to."""
    columns = list(GTFS_TABLES[name])
    text = as_member(df, name)
    line = F.to_csv(F.struct(*[text[c] for c in columns]), CSV_OPTIONS)
    return text.select(
        F.lit(gtfs_member(name)).alias("member"),
        F.lit(",".join(columns)).alias("header"),
        F.floor(key / ARCHIVE_KEYS).cast("int").alias("archive"),
        line.alias("line"),
    )


def archive_landing(spark: SparkSession, sf_dir: str) -> str:
    """Archives with stops.txt and routes.txt, one per range of keys.

    The key range bounds what one archive, and so one task, holds; more rows make
    more archives, an hour apart and running on into further days.
    """

    def write(root: str) -> None:
        lines = _csv_lines(
            view(spark, sf_dir, "gtfs_stops"), "gtfs_stops", F.col("stop_id").cast("bigint")
        ).unionByName(
            _csv_lines(
                view(spark, sf_dir, "gtfs_routes"), "gtfs_routes", F.col("route_id").cast("bigint")
            )
        )
        first = F.lit(f"{EXTRACT_DATE} 04:00:00").cast("timestamp")
        hour = F.timestamp_add("HOUR", F.col("archive"), first)
        placed = lines.select(
            "member",
            "header",
            "line",
            F.date_format(hour, "yyyy-MM-dd").alias("day"),
            F.date_format(hour, "yyyyMMdd_HHmmss").alias("stamp"),
        )

        def pack(group: pa.Table) -> pa.Table:
            day, stamp = group["day"][0].as_py(), group["stamp"][0].as_py()
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                members: dict[str, list[str]] = {}
                for member, header, line in zip(*(group[c] for c in ("member", "header", "line"))):
                    members.setdefault(member.as_py(), [header.as_py()]).append(line.as_py())
                for member, text in sorted(members.items()):
                    archive.writestr(member, "\n".join(text) + "\n")
            # Arrow knows Spark's s3a scheme as s3
            files, base = pafs.FileSystem.from_uri(root.replace("s3a://", "s3://"))
            folder = f"{base}/extract_source=gtfs/extract_date={day}"
            files.create_dir(folder, recursive=True)
            with files.open_output_stream(f"{folder}/gtfs_{stamp}.zip") as out:
                out.write(buffer.getvalue())
            return pa.table({"stamp": [stamp]})

        placed.groupBy("stamp").applyInArrow(pack, "stamp string").count()

    return _once(spark, sf_dir, "archive-landing", write)
