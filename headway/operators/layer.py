"""A date-partitioned catalog table that streams, backfills and compaction write together.

The table is external and has one partition per date. Where a partition lies is up to the
catalog, so a date is replaced by writing its new files to a folder of their own and then
naming that folder in the catalog: readers see the old rows or the new ones as a whole, and
those that are under way go on with the old files, which stay until they are removed.
Batches of a stream are added to wherever a date lies when they come.

Writers of one table take turns: one stream, and backfills and compaction of other dates or
in between. In Spark's own session catalog the table lasts as long as the session; across
sessions it needs a shared catalog.
"""

from __future__ import annotations

import time
import uuid
from collections import Counter
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.operators.sinks import dates_of
from headway.sources.store import Store

STAGING, LOADS = "_staging", "_loads"
UNDATED = "__HIVE_DEFAULT_PARTITION__"  # Fixed value: Spark's name for a null partition value
PARTITIONS_AT_ONCE = 500  # partitions named in one statement


class Layer(NamedTuple):
    """What the catalog says of a table."""

    name: str
    location: str
    key: str
    columns: list[str]


def create_layer(
    spark: SparkSession, name: str, location: str, schema: StructType, key: str = "date", recover: bool = True
) -> None:
    """The table over `location`, where absent.

    With `recover` the date folders that are there are its partitions.
    """
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != key]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}, `{key}` DATE) "
        f"USING parquet PARTITIONED BY (`{key}`) LOCATION '{location}'"
    )
    Store(spark, location).make_folder(location)
    if recover:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _described(spark: SparkSession, name: str, partition: str = "") -> list[tuple[str, str]]:
    """What the catalog has of a table, or of one of its partitions: columns, then details."""
    return [(r.col_name, r.data_type) for r in spark.sql(f"DESCRIBE EXTENDED {name} {partition}").collect()]


def _detail(rows: list[tuple[str, str]], heading: str, name: str) -> str:
    """The first detail of that name below a heading."""
    begin = next(i for i, (label, _) in enumerate(rows) if label == f"# {heading}")
    return next(value for label, value in rows[begin:] if label == name)


def layer(spark: SparkSession, name: str) -> Layer:
    """Fails if the table is not partitioned by one column."""
    rows = _described(spark, name)
    names = [label for label, _ in rows]
    columns = names[: next(i for i, label in enumerate(names) if not label or label[0] == "#")]
    keys = names[names.index("# col_name") + 1 : names.index("")] if "# col_name" in names else []
    if len(keys) != 1:
        raise ValueError(f"{name} is partitioned by {keys}, not by a date")
    return Layer(name, _detail(rows, "Detailed Table Information", "Location").rstrip("/"), keys[0], columns)


def _values(spark: SparkSession, name: str) -> list[str]:
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return [row.partition.partition("=")[2] for row in rows]


def layer_dates(spark: SparkSession, name: str) -> list[date]:
    """The dates of the table, oldest first, from the catalog alone."""
    return dates_of(_values(spark, name))


def read_layer(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is now; sessions keep file listings that others' writes outdate."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _partition(key: str, value: str) -> str:
    literal = "NULL" if value == UNDATED else f"DATE '{date.fromisoformat(value)}'"
    return f"PARTITION (`{key}` = {literal})"


def _folder(spark: SparkSession, table: Layer, value: str) -> str:
    """Where a date lies."""
    rows = _described(spark, table.name, _partition(table.key, value))
    return _detail(rows, "Detailed Partition Information", "Location").rstrip("/")


def _placed(spark: SparkSession, table: Layer, folders: dict[str, str]) -> None:
    """Make each folder the place of its date: known dates change over, others are added."""
    known = set(_values(spark, table.name))
    new = [v for v in folders if v not in known]
    for at in range(0, len(new), PARTITIONS_AT_ONCE):
        places = (f"{_partition(table.key, v)} LOCATION '{folders[v]}'" for v in new[at : at + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {table.name} ADD IF NOT EXISTS {' '.join(places)}")
    for value in known & set(folders):
        spark.sql(f"ALTER TABLE {table.name} {_partition(table.key, value)} SET LOCATION '{folders[value]}'")
    spark.catalog.refreshTable(table.name)


def _written(df: DataFrame, table: Layer, folder: str, sort_by: str | None) -> None:
    """The rows as date folders below `folder`: many small files gathered, a hot date split."""
    out = df.select(*table.columns).hint("rebalance", table.key)
    if sort_by:
        out = out.sortWithinPartitions(table.key, sort_by)
    out.write.mode("overwrite").partitionBy(table.key).parquet(folder)


def append_batch(df: DataFrame, name: str, batch: str, sort_by: str | None = "extract_ts") -> None:
    """Add the rows of a batch once, however often the batch is run again.

    They are staged below the batch's name and moved in file by file. A run that finds the
    staged rows complete moves those that are left, so one that died half way is resumed and
    one that was done changes nothing. The staging folder stays as the record of that.
    """
    spark = df.sparkSession
    table = layer(spark, name)
    store = Store(spark, table.location)
    staged = f"{table.location}/{STAGING}/{batch}"
    if not store.exists(f"{staged}/_SUCCESS"):
        _written(df, table, staged, sort_by)
    folders = store.folders(staged, table.key)
    files = {v: [e.name for e in store.entries(f) if e.name.endswith(".parquet")] for v, f in folders.items()}
    known = set(_values(spark, name))
    new = {v: f"{table.location}/{table.key}={v}" for v in files if v not in known}
    for folder in new.values():
        store.make_folder(folder)
    if new:
        _placed(spark, table, new)
    for value, names in files.items():
        # those of a batch that was done before are gone
        target = new.get(value) or (_folder(spark, table, value) if names else "")
        for file in names:
            store.move(f"{folders[value]}/{file}", f"{target}/{batch}-{file}")
    spark.catalog.refreshTable(name)


def forget_batches(spark: SparkSession, name: str, stream: str, before: int) -> None:
    """Remove the records of a stream's batches that it will not run again."""
    table = layer(spark, name)
    store = Store(spark, table.location)
    for entry in store.entries(f"{table.location}/{STAGING}"):
        owner, _, number = entry.name.rpartition("-")
        if owner == stream and int(number) < before:
            store.remove(f"{table.location}/{STAGING}/{entry.name}")


def place_folders(spark: SparkSession, name: str, folders: dict[str, str], overwrite: bool = False) -> list[date]:
    """Take over date folders that hold files already; return the dates left alone."""
    table = layer(spark, name)
    skipped = [] if overwrite else dates_of(set(folders) & set(_values(spark, name)))
    left = {day.isoformat() for day in skipped}
    _placed(spark, table, {v: f for v, f in folders.items() if v not in left})
    return skipped


def write_layer(
    df: DataFrame, name: str, overwrite: bool = False, sort_by: str | None = "extract_ts"
) -> list[date]:
    """Write whole dates; return those left alone because they exist.

    With `overwrite` the dates in `df` change over to the new rows together with the catalog,
    whatever streams and backfills had put there before. Other dates stay as they are.
    """
    spark = df.sparkSession
    table = layer(spark, name)
    skipped: list[date] = []
    if not overwrite:
        skipped = layer_dates(spark, name)
        df = df.filter(F.col(table.key).isNull() | ~F.col(table.key).isin(skipped)) if skipped else df
    folder = f"{table.location}/{LOADS}/{uuid.uuid4().hex}"
    _written(df, table, folder, sort_by)
    _placed(spark, table, Store(spark, table.location).folders(folder, table.key))
    return skipped


def files_per_date(spark: SparkSession, name: str, days: list[date] | None = None) -> dict[date, int]:
    """Number of files of each date, of all or of the given ones, from the listing of a scan."""
    table, rows = layer(spark, name), read_layer(spark, name)
    if days is not None:
        rows = rows.filter(F.col(table.key).isin(days))
    # wherever a date lies, its folder is named after it
    folders = Counter(path.rsplit("/", 2)[1].partition("=")[2] for path in rows.inputFiles())
    return {day: folders[day.isoformat()] for day in dates_of(folders)}


def compact(
    spark: SparkSession, name: str, before: date, max_files: int = 1, sort_by: str | None = "extract_ts"
) -> list[date]:
    """Rewrite dates earlier than `before` that have more than `max_files` files; return them.

    All are rewritten by one job into files of the size that adaptive execution advises, and
    change over date by date. Files that a late batch added meanwhile are moved to the new
    folder, so none is lost.
    """
    table = layer(spark, name)
    store = Store(spark, table.location)
    closed = [day for day in layer_dates(spark, name) if day < before]
    many = [day for day, files in files_per_date(spark, name, closed).items() if files > max_files]
    if not many:
        return []
    rows = read_layer(spark, name).filter(F.col(table.key).isin(many))
    # the files that the plan reads, as a set of (folder, name)
    read = {tuple(path.rsplit("/", 2)[1:]) for path in rows.inputFiles()}
    folder = f"{table.location}/{LOADS}/{uuid.uuid4().hex}"
    _written(rows, table, folder, sort_by)
    new = store.folders(folder, table.key)
    old = {value: _folder(spark, table, value) for value in new}
    _placed(spark, table, new)
    for value, place in old.items():
        for entry in store.entries(place):
            late = (place.rsplit("/", 1)[1], entry.name) not in read
            if late and entry.name.endswith(".parquet"):
                store.move(f"{place}/{entry.name}", f"{new[value]}/{entry.name}")
    spark.catalog.refreshTable(name)
    return many


def remove_superseded(spark: SparkSession, name: str, older_than: float) -> int:
    """Delete date folders that no partition lies in, last changed more than `older_than` s ago.

    The time is that of the longest query that may still read them.
    """
    table = layer(spark, name)
    store = Store(spark, table.location)
    live = {store.full(_folder(spark, table, v)) for v in _values(spark, name)}
    until = (time.time() - older_than) * 1000
    loads = f"{table.location}/{LOADS}"
    roots = [table.location, *(f"{loads}/{e.name}" for e in store.entries(loads))]
    removed = 0
    for root in roots:
        for entry in store.entries(root):
            place = f"{root}/{entry.name}"
            if not entry.name.startswith(f"{table.key}=") or store.full(place) in live:
                continue
            if entry.modified <= until:
                store.remove(place)
                removed += 1
    return removed
