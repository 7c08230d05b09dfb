"""Moving landed files and standardized rows to other instants or partition keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.functions.clock import zone_or_utc
from headway.operators.layer import create_layer, place_folders, read_layer
from headway.operators.sinks import write_dates
from headway.schemas import STAMP_FORMAT
from headway.session import shared_folder
from headway.sources.landing import folder_value, list_files
from headway.sources.store import Store

RECORD = ["source", "extract_date", "file_name"]

# Fixed value: the first stamp in a file name, and what stands before it.
STAMPED = r"^(.*?)_(\d{8}_\d{6})"


def file_records(spark: SparkSession, root: str, source: str = "*") -> DataFrame:
    """One (source, extract_date, file_name) row per landed file."""
    paths = [f"{root}/extract_source={source}/extract_date=*"]
    return list_files(spark, paths).select(
        folder_value("extract_source").alias("source"),
        folder_value("extract_date").alias("extract_date"),
        F.regexp_extract("path", r"extract_date=[^/]+/(?:[^/=]+=)?([^/]+)", 1).alias("file_name"),
    ).distinct()


def _shifted(stamp: Column, hours: int, zone: str | None) -> Column:
    instant = F.try_to_timestamp(stamp, F.lit(STAMP_FORMAT))
    if zone:
        return F.to_utc_timestamp(instant, zone_or_utc(zone))
    return instant - F.make_dt_interval(hours=F.lit(hours))


def plan_shift(records: DataFrame, hours: int = 3, zone: str | None = None) -> DataFrame:
    """Where each file would go if its name's instant were `hours` earlier.

    Gives `action` move, keep or skip (no instant in the name), `new_date` and
    `new_name`. Nothing is written. With `zone` the instants are local times of
    that zone instead, which a fixed offset gets wrong across clock changes.

    Files that would share a name get `-1`, `-2`, ... in order of their old date,
    passing over suffixed names that other files take. A group of such files
    holds at most one file per date folder, as its members had one and the same
    name.
    """
    stamp = F.regexp_extract("file_name", STAMPED, 2)
    moved = records.dropDuplicates(RECORD).withColumn("_to", _shifted(stamp, hours, zone))
    moved = moved.withColumns(
        {
            "new_date": F.date_format("_to", "yyyy-MM-dd"),
            "_name": F.concat(
                F.regexp_extract("file_name", STAMPED, 1),
                F.lit("_"),
                F.date_format("_to", STAMP_FORMAT),
                # what follows the first stamp
                F.regexp_replace("file_name", STAMPED, ""),
            ),
        }
    )
    named = moved.filter(F.col("_to").isNotNull())
    stays = (F.col("new_date") == F.col("extract_date")) & (F.col("_name") == F.col("file_name"))
    place = ["source", "new_date", "_name"]
    # a kept file owns its name, else the oldest claim does
    claims = Window.partitionBy(*place).orderBy(
        F.when(F.col("action") == "keep", 0).otherwise(1), "extract_date", "file_name"
    )
    ranked = named.select(
        *RECORD,
        "new_date",
        "_name",
        F.when(stays, "keep").otherwise("move").alias("action"),
    ).withColumn("_claim", F.row_number().over(claims) - 1)
    settled = ranked.filter(F.col("_claim") == 0).select(
        *RECORD, "action", "new_date", F.col("_name").alias("new_name")
    )
    nothing = F.lit(None).cast("string")
    skipped = moved.filter(F.col("_to").isNull()).select(
        *RECORD,
        F.lit("skip").alias("action"),
        nothing.alias("new_date"),
        nothing.alias("new_name"),
    )
    return settled.unionByName(_suffixed(ranked, place)).unionByName(skipped)


def _suffixed(ranked: DataFrame, place: list[str]) -> DataFrame:
    """Names for the files whose own new name is taken.

    The n-th of them gets the n-th free number. With the taken numbers k in
    order, the i-th (from 1) has k - i free ones before it, so the n-th free
    number is n plus the count of taken ones with k - i < n. Both kinds of rows
    run through one ordered window, so no list of numbers is gathered.
    """
    stem, tail = r"^(.*?)(\.[^.]*)?$", 2
    waiting = ranked.filter(F.col("_claim") > 0).select(
        *RECORD, *place[1:], "action", F.col("_claim").alias("_at"), F.lit(0).alias("_taken")
    )
    numbered = r"^(.*)-([1-9]\d{0,8})(\.[^.]*)?$"
    order = Window.partitionBy(*place).orderBy("_k")
    taken = (
        ranked.filter((F.col("_claim") == 0) & F.col("_name").rlike(numbered))
        .select(
            "source",
            "new_date",
            F.regexp_extract("_name", numbered, 2).cast("int").alias("_k"),
            F.concat(
                F.regexp_extract("_name", numbered, 1), F.regexp_extract("_name", numbered, 3)
            ).alias("_name"),
        )
        # only the names somebody waits for
        .join(waiting.select(*place).distinct(), place, "left_semi")
        .distinct()
        .withColumn("_at", F.col("_k") - F.row_number().over(order))
        .select(*place, "_at", F.lit(1).alias("_taken"))
    )
    # a taken number with k - i < n counts, so it must come before n in the order
    run = (
        Window.partitionBy(*place)
        .orderBy("_at", "_taken")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    both = waiting.unionByName(taken, allowMissingColumns=True)
    number = F.col("_at") + F.sum("_taken").over(run)
    return (
        both.withColumn("_number", number)
        .filter(F.col("_taken") == 0)
        .select(
            *RECORD,
            "action",
            "new_date",
            F.concat(
                F.regexp_extract("_name", stem, 1),
                F.lit("-"),
                F.col("_number").cast("string"),
                F.regexp_extract("_name", stem, tail),
            ).alias("new_name"),
        )
    )


def shift_counts(plan: DataFrame) -> DataFrame:
    """How many files there are and how many would move."""
    return plan.agg(
        F.count("*").alias("total"), F.count_if(F.col("action") == "move").alias("changed")
    )


# ---- carrying out a shift ----------------------------------------------------


MOVES_PER_TASK = 2_000
MOVING, AWAY = "_moving", "_away"


def plan_moves(spark: SparkSession, root: str, plan: DataFrame, manifest: str | None = None) -> str:
    """Write the manifest of a plan's moves, and nothing else; return its folder.

    One row per entry of a date folder, a file or a folder of parts, with its place, its new
    place and one between, all below `root`. Kept and skipped files are not in it.
    """
    base = r"extract_date=[^/]+/([^/=]+=)?([^/]+)"
    entries = list_files(spark, [f"{root}/extract_source=*/extract_date=*"]).select(
        folder_value("extract_source").alias("source"),
        folder_value("extract_date").alias("extract_date"),
        F.regexp_extract("path", base, 2).alias("file_name"),
        F.regexp_extract("path", base, 1).alias("prefix"),
    ).distinct()
    run = uuid.uuid4().hex

    def place(day: str, name: str) -> Column:
        return F.concat(
            F.lit("extract_source="), "source", F.lit("/extract_date="), day, F.lit("/"), "prefix", name
        )

    moves = plan.filter(F.col("action") == "move").join(entries, RECORD).select(
        *RECORD, "new_date", "new_name",
        place("extract_date", "file_name").alias("old_place"),
        F.concat(F.lit(f"{MOVING}/{run}/"), place("new_date", "new_name")).alias("between"),
        place("new_date", "new_name").alias("new_place"),
    )
    manifest = manifest or shared_folder(spark, "moves")
    moves.write.parquet(manifest)
    return manifest


def carry_out(spark: SparkSession, root: str, manifest: str) -> DataFrame:
    """Move the files of a manifest and return it. A run that died is ended by another call.

    Executors move in two passes, all files out of the way first, as one may go where another
    still is. A file is renamed in its store, never written over another, and a move that is
    done is left alone, so tasks may be run again. A mark beside the manifest says that the
    first pass is over: from then on an old place may hold a file that has arrived there.
    """
    store = Store(spark, root)
    moves = spark.read.parquet(manifest)
    if not store.exists(f"{manifest}/{AWAY}"):
        _moved(spark, store.full(root), moves.select("old_place", "between"))
        store.create_once(f"{manifest}/{AWAY}", "")
    _moved(spark, store.full(root), moves.select("between", "new_place"))
    store.remove(f"{root}/{MOVING}")
    return moves.select(*RECORD, "new_date", "new_name")


def _moved(spark: SparkSession, root: str, places: DataFrame) -> int:
    """Move each file from its first place to its second, both below `root`; returns how many."""
    uri = root.replace("s3a://", "s3://")  # Arrow knows Spark's s3a scheme as s3
    tasks = max(spark.sparkContext.defaultParallelism, places.count() // MOVES_PER_TASK)

    def move(files: pafs.FileSystem, source: str, target: str) -> int:
        here, there = (i.type != pafs.FileType.NotFound for i in files.get_file_info([source, target]))
        if here and there:
            raise FileExistsError(f"{target} is taken, {source} stays")
        if not here and not there:
            raise FileNotFoundError(f"{source} is gone")
        if here:
            files.create_dir(target.rsplit("/", 1)[0], recursive=True)
            files.move(source, target)
        return int(here)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch.columns))
            done = [move(files, *(f"{base}/{place}" for place in row)) for row in rows]
            yield pa.record_batch([pa.array(done, pa.int64())], names=["moved"])

    dealt = places.repartition(tasks, places.columns[0]).mapInArrow(run, "moved long")
    return dealt.agg(F.sum("moved")).first()[0] or 0


def shift_files(
    spark: SparkSession, root: str, hours: int = 3, zone: str | None = None, source: str = "*", dry_run: bool = False
) -> DataFrame:
    """Plan a shift of the landed files and carry it out; returns the plan.

    With `dry_run` nothing is moved.
    """
    plan = plan_shift(file_records(spark, root, source), hours, zone)
    if dry_run:
        return plan
    # the plan is of the files as they are now, so it is written before they move
    kept = shared_folder(spark, "shift-plan")
    plan.write.parquet(kept)
    plan = spark.read.parquet(kept)
    carry_out(spark, root, plan_moves(spark, root, plan))
    return plan


def shift_positions(
    positions: DataFrame, hours: int = 3, zone: str | None = None, key: str = "date"
) -> DataFrame:
    """Rows with their instants moved, and the partition date that follows from it.

    A row without an instant stays where it is.
    """
    if zone:
        instant = F.to_utc_timestamp("extract_ts", zone_or_utc(zone))
    else:
        instant = F.col("extract_ts") - F.make_dt_interval(hours=F.lit(hours))
    moved = positions.withColumn("extract_ts", instant)
    return moved.withColumn(key, F.coalesce(F.to_date("extract_ts"), F.col(key)))


def apply_shift(
    positions: DataFrame, path: str, hours: int = 3, zone: str | None = None, key: str = "date"
) -> None:
    """Write the moved rows to a new table, partitioned by their new dates."""
    write_dates(shift_positions(positions, hours, zone, key), path, key, overwrite=True)


def renamed_partitions(spark: SparkSession, path: str, old: str, new: str) -> DataFrame:
    """Read a table under another partition key. Costs nothing: only a name changes."""
    table = spark.read.parquet(path)
    if old not in table.columns:
        raise ValueError(f"{path} has no partition key {old!r}")
    return table.withColumnRenamed(old, new)


def rename_partition_key(
    spark: SparkSession, path: str, out: str, old: str = "date", new: str = "extract_date"
) -> None:
    """Copy a table to `out` under another partition key.

    Rows stay in the order and the grouping of their files, so nothing is shuffled.
    """
    rows = renamed_partitions(spark, path, old, new)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(new).parquet(out)


def relabel_partitions(
    spark: SparkSession, path: str, name: str, old: str = "date", new: str = "extract_date"
) -> DataFrame:
    """A catalog table over the same files under another partition key.

    Each partition of the table is an existing folder, so no file is read, moved or written.
    """
    schema = renamed_partitions(spark, path, old, new).schema
    create_layer(spark, name, path, schema, new, recover=False)
    place_folders(spark, name, Store(spark, path).folders(path, old))
    return read_layer(spark, name)


def rename_folders(spark: SparkSession, path: str, old: str = "date", new: str = "extract_date") -> int:
    """Rename the partition folders in place, one by one; returns how many.

    For stores that rename folders at once. A run that died half way is ended by another.
    """
    store = Store(spark, path)
    folders = store.folders(path, old)
    if not folders and not store.folders(path, new):
        raise ValueError(f"{path} has no partition key {old!r}")
    for value, folder in folders.items():
        store.move(folder, f"{path}/{new}={value}")
    return len(folders)


def plan_rename(
    spark: SparkSession, path: str, old: str = "date", new: str = "extract_date"
) -> DataFrame:
    """Old and new folder names with file counts, from a listing alone."""
    folder = F.regexp_extract("path", f"/({old}=[^/]+)/", 1)
    return (
        list_files(spark, [path], "*.parquet")
        .groupBy(folder.alias("old_folder"))
        .agg(F.count("*").alias("files"))
        .withColumn("new_folder", F.regexp_replace("old_folder", f"^{old}=", f"{new}="))
        .select("old_folder", "new_folder", "files")
    )
