"""Schedule archives: members read or unpacked by the tasks, by random access to the archive."""

from __future__ import annotations

import io
import itertools
import posixpath
import re
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.csv as pacsv
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.schemas import GTFS_TABLES, gtfs_member
from headway.sources.landing import (
    check_dates,
    date_glob,
    files_or_none,
    folder_value,
    list_files,
)

LINES_PER_BATCH = 20_000
BLOCK_BYTES = 4 << 20
PIECE_BYTES = 1 << 20
ARCHIVES_AT_ONCE = 16  # tasks for each core, if there are that many archives

# Fixed value: archive file names.
ARCHIVE_PATTERN = r"gtfs_(\d{8}_\d{6})\.zip$"


def list_archives(
    spark: SparkSession, root: str, dates: list | None = None
) -> DataFrame:
    """One row per archive: path, extract_date, extract_ts."""
    return list_files(spark, [date_glob(root, "gtfs", dates)], "*.zip").select(
        "path",
        folder_value("extract_date").alias("extract_date"),
        F.regexp_extract("path", ARCHIVE_PATTERN, 1).alias("extract_ts"),
    )


def open_archive(path: str) -> pa.NativeFile:
    """An archive for reading at any place; nothing is fetched before it is asked for."""
    # Arrow knows Spark's s3a scheme as s3, and wants all slashes of a local one
    uri = quote(re.sub("^file:/+", "file:///", path.replace("s3a://", "s3://")), safe="/:@")
    store, place = pafs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")
    return store.open_input_file(place)


def _spread(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The paths, an archive to a task as far as that pays."""
    tasks = min(len(paths), ARCHIVES_AT_ONCE * spark.sparkContext.defaultParallelism)
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, tasks))


def _directory(path: str) -> list[zipfile.ZipInfo]:
    """The members that an archive lists at its end; of its other bytes none is read."""
    with open_archive(path) as file, zipfile.ZipFile(file) as archive:
        return [info for info in archive.infolist() if not info.is_dir()]


MEMBERS = "path string, number int, name string, packed_bytes long, unpacked_bytes long, readable boolean"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[str]:
    for batch in batches:
        yield from batch["path"].to_pylist()


def _pieces(path: str, number: int) -> Iterator[bytes]:
    """The unpacked bytes of a member, checked against its checksum at the end."""
    with open_archive(path) as file, zipfile.ZipFile(file) as archive:
        info = [i for i in archive.infolist() if not i.is_dir()][number]
        with archive.open(info) as stream:
            while piece := stream.read(PIECE_BYTES):
                yield piece


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch["path"].to_pylist():
            try:
                infos, readable = _directory(path), True
            except zipfile.BadZipFile:
                infos, readable = [], False
            rows = [(path, i, x.filename, x.compress_size, x.file_size, True) for i, x in enumerate(infos)]
            # an archive without members has a row, too
            columns = zip(*(rows or [(path, None, None, None, None, readable)]))
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
            names = ["path", "number", "name", "packed_bytes", "unpacked_bytes", "readable"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def list_members(spark: SparkSession, root: str, dates: list | None = None) -> DataFrame:
    """One row per member of each archive, from the archives' directories alone.

    An archive without members has one row of nulls; its `readable` tells whether it opens.
    """
    return _spread(spark, list(_paths(list_archives(spark, root, dates)))).mapInArrow(_members, MEMBERS)


def _dealt(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Members as rows of their own, dealt over tasks: those of one archive to several."""
    members = _spread(spark, paths).mapInArrow(_members, MEMBERS)
    tasks = max(len(paths), spark.sparkContext.defaultParallelism)
    return members.repartition(tasks, "path", "number")


def newest_archives(archives: DataFrame) -> DataFrame:
    """The archive with the highest name of each date."""
    return archives.groupBy("extract_date").agg(
        F.max_by("path", "extract_ts").alias("path"), F.max("extract_ts").alias("extract_ts")
    )


def _paths(archives: DataFrame) -> dict[str, str]:
    """Archive paths for a scan, with their dates. The scan's file index holds them anyway."""
    rows = archives.select("path", "extract_date").collect()
    return dict(sorted((row.path, row.extract_date) for row in rows))


def read_archive_table(
    spark: SparkSession,
    root: str,
    table: str,
    dates: list | None = None,
    extracts: str = "latest",
    absent: str = "error",
) -> DataFrame:
    """A schedule table straight from its archives, all columns text.

    Tasks share out the archives. Of each its directory and the member's own bytes are
    fetched, and decompression and parsing stream through Arrow batches, so neither has to
    fit in memory. A compressed member cannot be entered in the middle. `absent` says what
    to do about an archive without the member: "error" or "skip".
    """
    if extracts not in ("latest", "all"):
        raise ValueError(f"extracts must be 'latest' or 'all', not {extracts!r}")
    if absent not in ("error", "skip"):
        raise ValueError(f"absent must be 'error' or 'skip', not {absent!r}")
    archives = list_archives(spark, root, dates)
    if extracts == "latest":
        archives = newest_archives(archives)
    paths = _paths(archives)
    check_dates(dates, set(paths.values()), "archive")
    columns = list(GTFS_TABLES[table])
    member = gtfs_member(table)
    schema = ", ".join(["path string", *(f"`{c}` string" for c in columns)])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in _listed(batches):
            with open_archive(path) as file, zipfile.ZipFile(file) as archive:
                if member not in archive.namelist():
                    if absent == "skip":
                        continue
                    raise FileNotFoundError(f"{path} has no {member}")
                with archive.open(member) as stream:
                    reader = pacsv.open_csv(
                        stream,
                        read_options=pacsv.ReadOptions(block_size=BLOCK_BYTES),
                        parse_options=pacsv.ParseOptions(newlines_in_values=True),
                        convert_options=pacsv.ConvertOptions(
                            include_columns=columns,
                            column_types={c: pa.string() for c in columns},
                            null_values=[""],
                            strings_can_be_null=True,
                            quoted_strings_can_be_null=False,
                        ),
                    )
                    for part in reader:
                        where = pa.array([path] * part.num_rows, pa.string())
                        yield pa.RecordBatch.from_arrays(
                            [where, *part.columns], ["path", *columns]
                        )

    rows = _spread(spark, list(paths)).mapInArrow(members, schema)
    return rows.select(
        *columns,
        F.regexp_extract("path", r"extract_date=([^/]+)", 1).alias("extract_date"),
        F.regexp_extract("path", ARCHIVE_PATTERN, 1).alias("extract_ts"),
    )


def archive_status(spark: SparkSession, root: str, dates: list | None = None) -> DataFrame:
    """One row per archive: member count, unpacked bytes and whether it opens.

    Every member is read and checked against its stored checksum, each by itself, so the
    members of one archive are checked by several tasks.
    """
    paths = _paths(list_archives(spark, root, dates))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sound = []
            for path, number, readable in zip(*(batch[c].to_pylist() for c in ("path", "number", "readable"))):
                try:
                    if number is not None:
                        for _ in _pieces(path, number):
                            pass
                    sound.append(readable)
                # a damaged deflate stream raises zlib.error, a cut one EOFError
                except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError):
                    sound.append(False)
            yield pa.record_batch(
                [batch["path"], batch["number"], batch["unpacked_bytes"], pa.array(sound)],
                names=["path", "number", "unpacked_bytes", "sound"],
            )

    checked = _dealt(spark, list(paths)).mapInArrow(
        check, "path string, number int, unpacked_bytes long, sound boolean"
    )
    return checked.groupBy("path").agg(
        F.count("number").alias("members"),
        F.coalesce(F.sum("unpacked_bytes"), F.lit(0)).alias("unpacked_bytes"),
        F.when(F.min("sound"), "ok").otherwise("corrupt").alias("status"),
    )


def unpack_archives(
    spark: SparkSession, root: str, out: str, dates: list | None = None
) -> int:
    """Unpack all text members to `extract_ts=.../member=<name>`; return archives unpacked.

    Extracts already below `out` are left alone. Files appear when the job
    commits, so an interrupted run leaves nothing half unpacked. A damaged
    archive stops the run; `archive_status` names it.
    """
    archives = list_archives(spark, root, dates)
    done = files_or_none(spark, [f"{out}/extract_source=gtfs/extract_date=*/extract_ts=*"])
    if done is not None:
        done = done.select(
            folder_value("extract_date").alias("extract_date"),
            folder_value("extract_ts").alias("extract_ts"),
        ).distinct()
        archives = archives.join(done, ["extract_date", "extract_ts"], "left_anti")
    paths = _paths(archives)
    if not paths:
        return 0

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, number, name in zip(*(batch[c].to_pylist() for c in ("path", "number", "name"))):
                day = re.search(r"extract_date=([^/]+)", path)
                stamp = re.search(ARCHIVE_PATTERN, path)
                if day is None or stamp is None:
                    raise ValueError(f"{path} is not named gtfs_YYYYMMDD_HHMMSS.zip in a date folder")
                with open_archive(path) as file, zipfile.ZipFile(file) as archive:
                    # the task of any member sees to the names of all
                    infos = [i for i in archive.infolist() if not i.is_dir()]
                    names = {posixpath.basename(i.filename) for i in infos}
                    if len(names) < len(infos):
                        raise ValueError(f"{path} has several members of one name")
                    if number is None:
                        continue
                    with archive.open(infos[number]) as stream:
                        text = io.TextIOWrapper(stream, encoding="utf-8", newline=None)
                        for start in itertools.count(0, LINES_PER_BATCH):
                            chunk = list(itertools.islice(text, LINES_PER_BATCH))
                            if not chunk:
                                break
                            size = len(chunk)
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array([day[1]] * size),
                                    pa.array([stamp[1]] * size),
                                    pa.array([posixpath.basename(name)] * size),
                                    pa.array(range(start, start + size), pa.int64()),
                                    pa.array([line.rstrip("\n") for line in chunk]),
                                ],
                                ["extract_date", "extract_ts", "member", "line_number", "value"],
                            )

    keys = ["extract_source", "extract_date", "extract_ts", "member"]
    (
        _dealt(spark, list(paths))
        .mapInArrow(
            lines,
            "extract_date string, extract_ts string, member string, "
            "line_number long, value string",
        )
        .withColumn("extract_source", F.lit("gtfs"))
        # a member lies within one task; this keeps its header first
        .sortWithinPartitions(*keys, "line_number")
        .select("value", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .text(out)
    )
    return len(paths)
