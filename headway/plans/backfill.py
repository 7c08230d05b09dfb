"""Raw landing area to date-partitioned standardized tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from datetime import date, timedelta
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.casting import LENIENT
from headway.operators.layer import layer as layer_of
from headway.operators.layer import layer_dates, place_folders
from headway.operators.sinks import check_not_streamed, written_dates
from headway.operators.standardize import (
    bad_gps_rows,
    bad_gtfs_rows,
    standardize_gps,
    standardize_gtfs,
)
from headway.schemas import GTFS_TABLES
from headway.sources.landing import (
    discover_dates,
    list_extracts,
    read_extracts,
    read_gps,
    schedule_extracts,
)
from headway.sources.store import Store


class Model(NamedTuple):
    """How one standardized table is made; the functions take and give DataFrames."""

    landed: Callable[..., DataFrame]  # those of the asked dates with input, as extract_date
    # rows of the given dates, and those of the dates whose files lack a column
    read: Callable[..., tuple[DataFrame | None, set[date]]]
    flag: Callable[[DataFrame], DataFrame]
    standardize: Callable[..., DataFrame]
    no_input: str  # status of a date without raw files
    key: str = "date"  # partition key of the output


def _read_schedules(
    spark: SparkSession, root: str, table: str, dates: list[date] | None
) -> tuple[DataFrame | None, set[date]]:
    found = schedule_extracts(spark, root, table, dates)
    good = [e for e in found if not e.lacks(table)]
    lacking = {date.fromisoformat(e.extract_date) for e in found if e.lacks(table)}
    return (read_extracts(spark, root, table, good) if good else None), lacking


def _gtfs_model(table: str) -> Model:
    return Model(
        # a date whose archive was not unpacked, or lacks the table, has no input
        lambda spark, root, dates: list_extracts(spark, root, table, dates).select(
            F.col("extract_date").cast("date").alias("extract_date")
        ),
        lambda spark, root, dates: _read_schedules(spark, root, table, dates),
        lambda raw: bad_gtfs_rows(raw, table),
        lambda raw, *how: standardize_gtfs(raw, table, *how),
        "failed",
        # calendar_dates has a column "date" of its own
        "extract_date" if "date" in GTFS_TABLES[table] else "date",
    )


MODELS = {
    "gps_positions": Model(
        lambda spark, root, dates: discover_dates(spark, root, "gps", dates),
        lambda spark, root, dates: (read_gps(spark, root, dates), set()),
        bad_gps_rows,
        standardize_gps,
        "empty",
    ),
    **{table: _gtfs_model(table) for table in GTFS_TABLES},
}

# what a model that cannot be read or written may raise
RAISED = (PySparkException, Py4JJavaError, ValueError)


def dates_between(first: date, last: date) -> list[date]:
    """Every date from first to last; a reversed range is an error."""
    days = (last - first).days
    if days < 0:
        raise ValueError(f"{last} is before {first}")
    return [first + timedelta(days=d) for d in range(days + 1)]


def asked_dates(
    day: date | None = None,
    date_from: date | None = None,
    date_to: date | None = None,
    all_dates: bool = False,
) -> list[date] | None:
    """One date, a range, or None for all available; today if nothing is asked."""
    if sum((day is not None, date_from is not None or date_to is not None, all_dates)) > 1:
        raise ValueError("ask for one of: a date, a range, all dates")
    if (date_from is None) != (date_to is None):
        raise ValueError("a range needs both of its ends")
    if all_dates:
        return None
    if date_from is not None:
        return dates_between(date_from, date_to)
    return [day or date.today()]


def _spec(model: str) -> Model:
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}, know {sorted(MODELS)}")
    return MODELS[model]


def _status_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(
        rows, "model string, date date, rows bigint, bad_rows bigint, status string"
    ).orderBy("model", "date")


def rejected_rows(
    spark: SparkSession, model: str, root: str, dates: list[date] | None = None
) -> DataFrame:
    """The raw rows that keep their dates from being standardized."""
    spec = _spec(model)
    rows, lacking = spec.read(spark, root, dates)
    if rows is None:
        raise ValueError(f"{model}: the files of {sorted(map(str, lacking))} lack columns")
    return spec.flag(rows).filter("bad").drop("bad")


Counts = dict[date, tuple[int | None, int | None]]


def _stage(spark: SparkSession, spec: Model, root: str, staged: str, dates: list[date]) -> Counts:
    """Standardize the dates below `staged`, apart by `bad`; (rows, unreadable rows) of each.

    One job reads the raw files once and never fails on a row: it is lenient, and flags what
    strict casts would refuse. None for a date whose files lack a column.
    """
    rows, lacking = spec.read(spark, root, dates)
    counts: Counts = {day: (None, None) for day in lacking}
    if rows is None:
        return counts
    made = spec.standardize(spec.flag(rows), LENIENT, ("bad",))
    (
        made.withColumnRenamed("extract_date", spec.key)
        .hint("rebalance", spec.key)
        .sortWithinPartitions(spec.key, "bad", "extract_ts")
        .write.partitionBy(spec.key, "bad")
        .parquet(staged)
    )
    if not Store(spark, staged).folders(staged, spec.key):
        return counts  # no date has a row
    # from the footers of what was written
    per_date = (
        spark.read.parquet(staged)
        .groupBy(F.col(spec.key).cast("date").alias("day"))
        .agg(F.count("*").alias("rows"), F.count_if(F.col("bad")).alias("bad_rows"))
    )
    return counts | {r.day: (r.rows, r.bad_rows) for r in per_date.collect()}


def _promote(store: Store, spec: Model, staged: str, path: str, dates: list[date]) -> dict[str, str]:
    """Move the staged folders of the dates to `path`; replaces what is there."""
    store.make_folder(path)
    placed = {}
    for day in dates:
        folder = f"{path}/{spec.key}={day}"
        store.remove(folder)
        store.move(f"{staged}/{spec.key}={day}/bad=false", folder)
        placed[day.isoformat()] = folder
    return placed


def backfill(
    spark: SparkSession,
    model: str,
    root: str,
    target: str,
    dates: list[date] | None = None,
    overwrite: bool = False,
    layer: str | None = None,
) -> DataFrame:
    """Standardize dates of one model and report on each of them.

    All dates go through one job that reads the raw files once and stages them by date, good
    rows apart from bad ones. The dates without bad rows are then moved into the table folder
    by folder: a bad date fails alone, at no further reading. With `layer` they go to that
    catalog table instead of `<target>/<model>`, and are staged below it.

    Statuses: written; skipped, as it exists already; empty; failed.
    """
    spec = _spec(model)
    path = layer_of(spark, layer).location if layer else f"{target}/{model}"
    store = Store(spark, path)
    landed = {row.extract_date for row in spec.landed(spark, root, dates).distinct().collect()}
    asked = sorted(landed) if dates is None else dates
    existing = set()
    if not overwrite:
        existing = set(layer_dates(spark, layer) if layer else written_dates(spark, path, spec.key))
    todo = [d for d in asked if d in landed and d not in existing]
    counts: Counts = {}
    if todo:
        check_not_streamed(spark, path)
        staged = f"{path}/_staging/{uuid.uuid4().hex}"
        try:
            counts = _stage(spark, spec, root, staged, todo)
            clean = sorted(d for d, (_, bad) in counts.items() if bad == 0)
            if layer:
                kept = f"{path}/_loads/{uuid.uuid4().hex}"
                place_folders(spark, layer, _promote(store, spec, staged, kept, clean), overwrite)
            else:
                _promote(store, spec, staged, path, clean)
        finally:
            store.remove(staged)
    report = []
    for d in asked:
        if d in existing:
            report.append((model, d, None, None, "skipped"))
        elif d not in counts:
            report.append((model, d, 0, 0, "empty" if d in landed else spec.no_input))
        else:
            rows, bad = counts[d]
            report.append((model, d, rows, bad, "written" if bad == 0 else "failed"))
    return _status_frame(spark, report)


def backfill_all(
    spark: SparkSession,
    root: str,
    target: str,
    models: list[str] | None = None,
    dates: list[date] | None = None,
    overwrite: bool = False,
) -> tuple[DataFrame, bool]:
    """Backfill several models; the flag is False if any date of any model failed.

    A model that cannot be read or written at all is `failed` as a whole, without a
    date, and the others go on.
    """
    reports = []
    for model in models or list(MODELS):
        try:
            reports.append(backfill(spark, model, root, target, dates, overwrite))
        except (*RAISED, OSError) as error:
            logging.getLogger(__name__).error("%s: %s", model, error)
            reports.append(_status_frame(spark, [(model, None, None, None, "failed")]))
    status = reports[0]
    for report in reports[1:]:
        status = status.unionByName(report)
    failed = status.filter(F.col("status") == "failed").limit(1).count()
    return status, failed == 0
