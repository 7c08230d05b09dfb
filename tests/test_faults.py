"""Faults that must not pass for data, and data that must not be lost."""

from __future__ import annotations

import io
import os
import time
import zipfile
from datetime import date

import pytest

from conftest import put
from headway.operators.control import resolve_dates
from headway.operators.sinks import write_dates
from headway.plans import backfill as jobs
from headway.plans.migrate import shift_positions
from headway.sources.archives import read_archive_table, unpack_archives
from headway.streaming.gps import start_gps_stream

GOOD = "1,8,24700000,59400000,10,90,v1,Z,0089,Kopli\n"


def landed(tmp_path, day="2026-08-17"):
    name = f"gps_{day.replace('-', '')}_070000.csv"
    put(tmp_path / "extract_source=gps" / f"extract_date={day}" / name, GOOD)
    return tmp_path / "extract_source=gps" / f"extract_date={day}" / name


def test_outage_is_raised_and_other_models_go_on(spark, tmp_path, monkeypatch):
    landed(tmp_path / "raw")
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")

    def lost(*_):
        raise jobs.PySparkException("Job aborted: executor lost")

    broken = jobs.MODELS["gtfs_stops"]._replace(landed=lost)
    monkeypatch.setitem(jobs.MODELS, "gtfs_stops", broken)
    with pytest.raises(jobs.PySparkException, match="executor lost"):
        jobs.backfill(spark, "gtfs_stops", raw, out)
    report, ok = jobs.backfill_all(spark, raw, out, ["gtfs_stops", "gps_positions"])
    assert not ok
    assert {(r.model, r.status) for r in report.collect()} == {("gtfs_stops", "failed"), ("gps_positions", "written")}


def test_source_active_twice(spark):
    params = spark.createDataFrame(
        [("gps", date(2026, 1, 1), True), ("gps", date(2026, 1, 2), True)],
        "source string, extract_date date, active boolean",
    )
    with pytest.raises(Exception, match="active twice"):
        resolve_dates(params, spark.createDataFrame([("gps",)], "source string")).collect()


def test_stream_takes_late_files_and_keeps_its_table(spark, tmp_path):
    first = landed(tmp_path / "raw")
    os.utime(first, (time.time(), time.time()))
    root, target, state = (str(tmp_path / x) for x in ("raw", "table", "state"))
    start_gps_stream(spark, root, target, state).awaitTermination()
    late = landed(tmp_path / "raw", "2026-08-01")
    os.utime(late, (time.time() - 20 * 86_400,) * 2)
    start_gps_stream(spark, root, target, state).awaitTermination()
    table = spark.read.parquet(target)
    assert sorted(str(r.date) for r in table.collect()) == ["2026-08-01", "2026-08-17"]
    with pytest.raises(ValueError, match="written by a stream"):
        write_dates(table, target)


def test_rows_without_instant_stay(spark):
    rows = spark.sql("SELECT DATE '2026-01-05' AS date, CAST(NULL AS TIMESTAMP) AS extract_ts")
    assert [str(r.date) for r in shift_positions(rows).collect()] == ["2026-01-05"]


def test_archives_with_members_of_one_name(spark, tmp_path):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        archive.writestr("a/stops.txt", "stop_id\n1\n")
        archive.writestr("b/stops.txt", "stop_id\n2\n")
    put(tmp_path / "extract_source=gtfs" / "extract_date=2026-08-17" / "gtfs_20260817_041500.zip", packed.getvalue())
    with pytest.raises(Exception, match="several members of one name"):
        unpack_archives(spark, str(tmp_path), str(tmp_path / "out"))
    with pytest.raises(ValueError, match="latest"):
        read_archive_table(spark, str(tmp_path), "gtfs_stops", extracts="newest")
