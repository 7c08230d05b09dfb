from __future__ import annotations

import contextlib
import io
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import put
from headway.operators.control import (
    LostUpdate,
    control_table,
    control_version,
    create_control_table,
    read_control,
    resolve_date,
    upsert_control,
    upsert_control_table,
    write_control,
)
from headway.operators.layer import create_layer, read_layer
from headway.operators.sinks import create_schemas, replace_table, write_dates, written_dates
from headway.plans.backfill import asked_dates, backfill, backfill_all, dates_between, rejected_rows
from headway.plans.validate import schema_faults, validate_layer
from headway.session import shared_folder
from headway.sources.landing import discover_dates, read_extracts, read_gtfs, schedule_extracts
from headway.sources.store import Store
from headway.streaming.gps import start_gps_stream, stream_gps

LINE = "2,8,24658890,59426210,5,90,v1,Z,0089,Kopli\n"


def land_gps(root, day, stamp, text=LINE):
    put(root / f"extract_source=gps/extract_date={day}/gps_{stamp}.csv", text)


# ---- dates ------------------------------------------------------------------


def test_dates():
    assert dates_between(date(2024, 2, 28), date(2024, 3, 1)) == [
        date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1),
    ]
    with pytest.raises(ValueError, match="before"):
        dates_between(date(2024, 3, 1), date(2024, 2, 28))
    with pytest.raises(ValueError, match="both"):
        asked_dates(date_to=date(2024, 3, 1))
    with pytest.raises(ValueError, match="one of"):
        asked_dates(day=date(2024, 3, 1), all_dates=True)
    assert asked_dates(all_dates=True) is None
    assert asked_dates() == [date.today()]


# ---- backfill ---------------------------------------------------------------


def statuses(report):
    return {str(r.date): (r.status, r.rows, r.bad_rows) for r in report.collect()}


def test_backfill_isolates_failures(spark, tmp_path):
    root, out = tmp_path / "raw", str(tmp_path / "std")
    land_gps(root, "2026-08-17", "20260817_070000", LINE * 3)
    land_gps(root, "2026-08-18", "20260818_070000", LINE + LINE.replace("59426210", "north"))
    land_gps(root, "2026-08-19", "20260819_070000")
    asked = dates_between(date(2026, 8, 17), date(2026, 8, 20))
    report = statuses(backfill(spark, "gps_positions", str(root), out, asked))
    assert report == {
        "2026-08-17": ("written", 3, 0),
        "2026-08-18": ("failed", 2, 1),
        "2026-08-19": ("written", 1, 0),
        "2026-08-20": ("empty", 0, 0),
    }
    assert rejected_rows(spark, "gps_positions", str(root)).count() == 1
    assert sorted(map(str, written_dates(spark, f"{out}/gps_positions"))) == [
        "2026-08-17", "2026-08-19",
    ]
    # mended and run again: only the missing date is written
    land_gps(root, "2026-08-18", "20260818_070000")
    report = statuses(backfill(spark, "gps_positions", str(root), out))
    assert {d: s for d, (s, _, _) in report.items()} == {
        "2026-08-17": "skipped", "2026-08-18": "written", "2026-08-19": "skipped",
    }
    report = statuses(backfill(spark, "gps_positions", str(root), out, overwrite=True))
    assert all(s == "written" for s, _, _ in report.values())
    assert spark.read.parquet(f"{out}/gps_positions").count() == 5


def test_backfill_keeps_other_failures(spark, tmp_path):
    land_gps(tmp_path / "raw", "2026-08-17", "20260817_070000")
    put(tmp_path / "blocked", "a file where a folder should be")
    with pytest.raises(Exception):
        backfill(spark, "gps_positions", str(tmp_path / "raw"), str(tmp_path / "blocked"))


def test_schedule_date_without_extract_fails(spark, tmp_path):
    root = tmp_path / "raw"
    put(
        root / "extract_source=gtfs/extract_date=2026-08-17/extract_ts=20260817_041500"
        "/calendar_dates.txt",
        "service_id,date,exception_type\ns,20260224,2\n",
    )
    land_gps(root, "2026-08-17", "20260817_070000")
    asked = dates_between(date(2026, 8, 17), date(2026, 8, 18))
    report, ok = backfill_all(
        spark, str(root), str(tmp_path / "std"), ["gtfs_calendar_dates", "gps_positions"], asked
    )
    found = {(r.model, str(r.date)): r.status for r in report.collect()}
    assert found == {
        ("gtfs_calendar_dates", "2026-08-17"): "written",
        ("gtfs_calendar_dates", "2026-08-18"): "failed",
        ("gps_positions", "2026-08-17"): "written",
        ("gps_positions", "2026-08-18"): "empty",
    }
    assert not ok
    stored = spark.read.parquet(str(tmp_path / "std/gtfs_calendar_dates")).first()
    assert (str(stored.date), str(stored.extract_date)) == ("2026-02-24", "2026-08-17")


def test_dates_with_other_columns_are_read_apart(spark, tmp_path):
    root = tmp_path / "raw"
    texts = {
        "17": "service_id,date,exception_type\ns,20260224,2\n",
        "18": "date,service_id,exception_type\n20260225,s,1\n",
        "19": "date,service_id\n20260226,s\n",
    }
    for day, text in texts.items():
        put(
            root / f"extract_source=gtfs/extract_date=2026-08-{day}"
            f"/extract_ts=202608{day}_041500/calendar_dates.txt",
            text,
        )
    put(root / "extract_source=gtfs/extract_date=2026-08-20/gtfs_20260820_041500.zip", b"packed")
    asked = dates_between(date(2026, 8, 17), date(2026, 8, 20))
    out = str(tmp_path / "std")
    report = backfill(spark, "gtfs_calendar_dates", str(root), out, asked)
    assert [r.status for r in report.collect()] == ["written", "written", "failed", "failed"]
    rows = spark.read.parquet(f"{out}/gtfs_calendar_dates").collect()
    assert sorted((r.service_id, str(r.date)) for r in rows) == [
        ("s", "2026-02-24"), ("s", "2026-02-25"),
    ]


def stages_since(spark, first):
    """The stages run from number `first` on."""
    store = spark.sparkContext._jsc.sc().statusStore()
    every = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    found = []
    it = every.iterator()
    while it.hasNext():
        stage = it.next()
        if stage.stageId() >= first:
            found.append((stage.stageId(), stage.status().toString(), stage.inputRecords(), stage.numFailedTasks()))
    return sorted(found)


def test_backfill_reads_raw_files_once_and_fails_no_task(spark, tmp_path):
    root, out = tmp_path / "raw", str(tmp_path / "std")
    for day in range(10, 20):
        bad = LINE.replace("59426210", "north") if day % 3 == 0 else LINE
        land_gps(root, f"2026-08-{day}", f"202608{day}_070000", LINE * 99 + bad)
    marker = spark.range(1).count() and max(s[0] for s in stages_since(spark, 0))
    report = statuses(backfill(spark, "gps_positions", str(root), out))
    run = stages_since(spark, marker + 1)
    assert sum(s == "failed" for s, _, _ in report.values()) == 3
    assert all(status in ("COMPLETE", "SKIPPED") and not failed for _, status, _, failed in run)
    # the raw rows once, the footers of what was staged once
    assert sum(records for _, _, records, _ in run) == 2 * 10 * 100
    assert spark.read.parquet(f"{out}/gps_positions").count() == 700


def test_files_of_one_header_are_one_scan(spark, tmp_path):
    root = tmp_path / "raw"
    heads = ["service_id,date,exception_type\ns,{},1\n", "exception_type,extra,date,service_id\n2,x,{},t\n", "date\n{}\n"]
    days = dates_between(date(2026, 1, 1), date(2026, 4, 10))
    for i, day in enumerate(days):
        put(root / f"extract_source=gtfs/extract_date={day}/extract_ts={day:%Y%m%d}_041500/calendar_dates.txt",
            "\ufeff" * (i % 2) + heads[2 if i == 50 else i % 2].format(f"{day:%Y%m%d}"))
    found = schedule_extracts(spark, str(root), "gtfs_calendar_dates")
    assert sum(bool(e.lacks("gtfs_calendar_dates")) for e in found) == 1
    rows = read_extracts(spark, str(root), "gtfs_calendar_dates", [e for e in found if not e.lacks("gtfs_calendar_dates")])
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        rows.explain()
    assert out.getvalue().count("FileScan csv") == 2
    report = statuses(backfill(spark, "gtfs_calendar_dates", str(root), str(tmp_path / "std")))
    assert [d for d, (s, _, _) in report.items() if s == "failed"] == [str(days[50])]
    stored = spark.read.parquet(str(tmp_path / "std/gtfs_calendar_dates"))
    assert stored.filter("date = extract_date").count() == len(days) - 1
    assert {r.service_id: r.n for r in stored.groupBy("service_id").agg(F.count("*").alias("n")).collect()} == {"s": 49, "t": 50}
    with pytest.raises(ValueError, match="lacks service_id"):
        read_gtfs(spark, str(root), "gtfs_calendar_dates", headers="any")


def test_dates_are_found_by_listing_one_folder(spark, tmp_path, monkeypatch):
    for day in range(10, 20):
        for hour in range(3):
            land_gps(tmp_path, f"2026-08-{day}", f"202608{day}_{hour:02d}0000")
    listed, entries = [], Store.entries
    monkeypatch.setattr(Store, "entries", lambda self, folder: listed.append(folder) or entries(self, folder))
    assert discover_dates(spark, str(tmp_path), "gps").count() == 10
    assert listed == [f"{tmp_path}/extract_source=gps"]
    rows = spark.createDataFrame([(1, date(2026, 8, 17))], "n int, date date")
    write_dates(rows, str(tmp_path / "t"), sort_by=None)
    listed.clear()
    assert write_dates(rows, str(tmp_path / "t"), sort_by=None) == [date(2026, 8, 17)]
    assert listed == [str(tmp_path / "t")]


def test_backfill_into_a_catalog_table(spark, tmp_path):
    root = tmp_path / "raw"
    for day in (17, 18, 19):
        land_gps(root, f"2026-08-{day}", f"202608{day}_070000", LINE * day)
    land_gps(root, "2026-08-18", "latest")
    create_schemas(spark, ["headway_fill"], str(tmp_path / "db"))
    name = "headway_fill.gps"
    create_layer(spark, name, str(tmp_path / "t"), stream_gps(spark, str(root)).schema)
    report = statuses(backfill(spark, "gps_positions", str(root), "", layer=name))
    assert [s for s, _, _ in report.values()] == ["written", "failed", "written"]
    report = statuses(backfill(spark, "gps_positions", str(root), "", layer=name))
    assert [s for s, _, _ in report.values()] == ["skipped", "failed", "skipped"]
    land_gps(root, "2026-08-17", "20260817_080000")
    backfill(spark, "gps_positions", str(root), "", [date(2026, 8, 17)], overwrite=True, layer=name)
    assert sorted(r["count"] for r in read_layer(spark, name).groupBy("date").count().collect()) == [18, 19]


# ---- sinks ------------------------------------------------------------------


def test_write_dates(spark, tmp_path):
    out = str(tmp_path / "t")
    rows = spark.createDataFrame(
        [(1, "2024-01-01"), (2, "2024-01-02")], "n int, date string"
    ).withColumn("extract_ts", F.current_timestamp())
    assert written_dates(spark, out) == []
    assert write_dates(rows.filter("n = 1"), out) == []
    changed = rows.withColumn("n", F.col("n") + 10)
    assert write_dates(changed, out) == [date(2024, 1, 1)]
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [1, 12]
    write_dates(rows.filter("n = 2"), out, overwrite=True)
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [1, 2]
    write_dates(rows.filter("n = 99"), out, overwrite=True)
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [1, 2]


def test_a_hot_date_is_split_over_files(spark, tmp_path):
    """A third of all rows on one date: several tasks write it, one writes each other date."""
    out = str(tmp_path / "t")
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40)
    rows = spark.range(0, 300_000, 1, 8).select(
        "id", F.date_add(F.lit("2024-01-01").cast("date"), hot.cast("int")).alias("date"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        write_dates(rows, out, sort_by=None)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    files = {p.name[5:]: len(list(p.glob("*.parquet"))) for p in tmp_path.glob("t/date=*")}
    assert files.pop("2024-01-01") > 3
    assert max(files.values()) <= 3
    assert spark.read.parquet(out).count() == 300_000


def test_replace_table(spark):
    create_schemas(spark, ["headway_test"], shared_folder(spark, "db"))
    create_schemas(spark, ["headway_test"])
    replace_table(spark.range(5), "headway_test.t")
    assert replace_table(spark.range(2), "headway_test.t").count() == 2


# ---- control table ----------------------------------------------------------


def test_control_table_defaults(spark):
    create_schemas(spark, ["headway_control"], shared_folder(spark, "db"))
    create_control_table(spark, "headway_control.source_params")
    spark.sql(
        "INSERT INTO headway_control.source_params (source, extract_date) "
        "VALUES ('gps', DATE '2026-08-17'), ('gtfs', DATE '2026-08-17')"
    )
    rows = spark.table("headway_control.source_params").collect()
    assert all(r.active and r.comment is None and r.updated_ts for r in rows)


OLD = datetime(2024, 1, 1)


def control(spark, *rows):
    return spark.createDataFrame(
        rows, "source string, extract_date date, active boolean, comment string, "
        "updated_ts timestamp",
    )


def incoming(spark, *rows):
    return spark.createDataFrame(rows, "source string, extract_date date")


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "control")
    current = control(
        spark,
        ("gps", date(2024, 1, 1), False, "why", OLD),
        ("gtfs", date(2024, 1, 1), True, None, OLD),
    )
    assert write_control(current, path) == 1
    new = incoming(spark, ("gps", date(2024, 5, 5)), ("tram", date(2024, 6, 6)))
    assert write_control(upsert_control(read_control(spark, path), new), path) == 2
    rows = {r.source: r for r in read_control(spark, path).collect()}
    assert (rows["gps"].extract_date, rows["gps"].active, rows["gps"].comment) == (
        date(2024, 5, 5), False, "why",
    )
    assert rows["gps"].updated_ts == OLD
    assert rows["gtfs"].extract_date == date(2024, 1, 1)
    assert (rows["tram"].active, rows["tram"].comment) == (True, None)
    assert rows["tram"].updated_ts > OLD
    fallback = date(2020, 2, 2)
    asked = read_control(spark, path)
    assert resolve_date(asked, "tram", fallback) == "2024-06-06"
    assert resolve_date(asked, "gps", fallback) == "2020-02-02"
    assert resolve_date(asked, "ferry", fallback) == "2020-02-02"


@pytest.mark.parametrize(
    "rows, reason",
    [
        ([("gps", date(2024, 1, 1)), ("gps", date(2024, 1, 2))], "twice"),
        ([("gps", None)], "extract_date is null"),
        ([(None, date(2024, 1, 1))], "source is null"),
    ],
)
def test_upsert_refuses(spark, rows, reason):
    current = control(spark, ("gps", date(2024, 1, 1), True, None, OLD))
    with pytest.raises(Exception, match=reason):
        upsert_control(current, incoming(spark, *rows)).collect()


# ---- validation and streaming -----------------------------------------------


def test_validate(spark):
    stops = spark.createDataFrame(
        [("a", 59.4, 24.7, "2024-01-01"), (None, 59.4, 24.7, "2024-01-01"),
         ("c", 10.0, 24.7, "2024-01-02"), ("d", None, 24.7, "2024-01-02")],
        "stop_id string, stop_lat double, stop_lon double, date string",
    )
    found = {r.check: r.value for r in validate_layer({"gtfs_stops": stops}).collect()}
    assert found == {
        "schema_faults": schema_faults(stops, "gtfs_stops"),
        "rows": 4, "partitions": 2, "null_keys": 1, "out_of_bounds": 2,
    }
    assert found["schema_faults"] == 9


def test_stream_takes_each_file_once(spark, tmp_path):
    root, target, state = (str(tmp_path / n) for n in ("raw", "std", "state"))
    land_gps(tmp_path / "raw", "2026-08-17", "20260817_070000", LINE * 2)
    start_gps_stream(spark, root, target, state).awaitTermination()
    # a late file of the same day, a new day, and a misnamed file
    land_gps(tmp_path / "raw", "2026-08-17", "20260817_065945")
    land_gps(tmp_path / "raw", "2026-08-18", "20260818_070000")
    land_gps(tmp_path / "raw", "2026-08-18", "latest")
    for _ in range(2):
        start_gps_stream(spark, root, target, state).awaitTermination()
    rows = spark.read.parquet(target).groupBy("date", "extract_ts").count().collect()
    assert sorted((str(r.date), str(r.extract_ts), r["count"]) for r in rows) == [
        ("2026-08-17", "2026-08-17 06:59:45", 1),
        ("2026-08-17", "2026-08-17 07:00:00", 2),
        ("2026-08-18", "2026-08-18 07:00:00", 1),
        ("2026-08-18", "None", 1),
    ]


# ---- control table: versions and the catalog ---------------------------------


def test_of_two_writers_one_fails(spark, tmp_path):
    path = str(tmp_path / "control")
    seed = control(spark, ("gps", date(2024, 1, 1), True, None, OLD))
    write_control(seed, path)
    version = control_version(spark, path)
    first = upsert_control(read_control(spark, path, version), incoming(spark, ("gps", date(2024, 2, 2))))
    second = upsert_control(read_control(spark, path, version), incoming(spark, ("tram", date(2024, 3, 3))))
    assert write_control(first, path, version) == 2
    with pytest.raises(LostUpdate):
        write_control(second, path, version)
    assert {r.source: str(r.extract_date) for r in read_control(spark, path).collect()} == {"gps": "2024-02-02"}
    assert len(list((tmp_path / "control/version=2").iterdir())) == 1


def test_a_version_half_written_is_none(spark, tmp_path):
    path = str(tmp_path / "control")
    seed = control(spark, ("gps", date(2024, 1, 1), True, None, OLD))
    write_control(seed, path)
    seed.write.parquet(f"{path}/version=2/attempt=died")
    assert control_version(spark, path) == 1
    assert write_control(seed, path) == 2
    assert read_control(spark, path).count() == 1


def test_upsert_into_the_catalog_table(spark, tmp_path):
    create_schemas(spark, ["headway_upsert"], str(tmp_path / "db"))
    name = "headway_upsert.source_params"
    create_control_table(spark, name)
    assert control_table(spark, name).count() == 0
    spark.sql(f"INSERT INTO {name} (source, extract_date) VALUES ('gps', DATE '2026-08-17')")
    new = incoming(spark, ("gps", date(2026, 9, 1)), ("gtfs", date(2026, 9, 2)))
    assert upsert_control_table(spark, name, new) == 1
    rows = {r.source: r for r in spark.table(name).collect()}
    assert {s: str(r.extract_date) for s, r in rows.items()} == {"gps": "2026-09-01", "gtfs": "2026-09-02"}
    assert all(r.active and r.updated_ts for r in rows.values())
    # defaults still hold, and what was inserted meanwhile is part of the next version
    spark.sql(f"INSERT INTO {name} (source, extract_date) VALUES ('tram', DATE '2026-09-03')")
    assert upsert_control_table(spark, name, incoming(spark, ("ferry", date(2026, 9, 4)))) == 2
    assert {r.source: r.active for r in spark.table(name).collect()} == dict.fromkeys(("gps", "gtfs", "tram", "ferry"), True)
    # a writer died after its commit: the next reader moves the catalog on
    root = str(tmp_path / "db/headway_upsert/source_params")
    write_control(control(spark, ("bus", date(2026, 9, 5), True, None, OLD)), root, 2)
    assert [r.source for r in control_table(spark, name).collect()] == ["bus"]


@pytest.mark.parametrize("row", ["('gps', DATE '2024-01-01')", "(NULL, DATE '2024-01-01')", "('tram', NULL)"])
def test_faults_in_the_catalog_table_are_found(spark, tmp_path, row):
    database = f"headway_faults_{abs(hash(row))}"
    create_schemas(spark, [database], str(tmp_path / "db"))
    name = f"{database}.source_params"
    create_control_table(spark, name)
    spark.sql(f"INSERT INTO {name} (source, extract_date) VALUES ('gps', DATE '2024-01-01')")
    spark.conf.set("spark.sql.storeAssignmentPolicy", "ANSI")
    try:
        spark.sql(f"INSERT INTO {name} (source, extract_date) VALUES {row}")
    except Exception as error:  # Spark itself may refuse a null
        assert "NULL" in str(error).upper()
        return
    with pytest.raises(Exception, match="twice|is null"):
        control_table(spark, name).collect()
    with pytest.raises(Exception, match="twice|is null"):
        upsert_control_table(spark, name, incoming(spark, ("bus", date(2024, 1, 1))))
