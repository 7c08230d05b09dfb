from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import put
from headway.functions.casting import LENIENT
from headway.operators.standardize import bad_gps_rows, standardize_gps, standardize_gtfs
from headway.operators.union import union_snapshots
from headway.schemas import GTFS_TABLES
from headway.sources.landing import discover_dates, read_gps, read_gtfs

DAY = "extract_source=gps/extract_date=2026-08-17"

SNAPSHOT = (
    "2,8A,24658890,59426210,,999,v1,Z,0089,MÄNNIKU\n"
    '3,8,24650000,59420000,17,45,v2,K,89,"Balti jaam, peatus"\n'
)


def gps_root(tmp_path, **files):
    for name, text in files.items():
        put(tmp_path / DAY / f"{name}.csv", text)
    return str(tmp_path)


def test_snapshot_is_standardized(spark, tmp_path):
    root = gps_root(tmp_path, gps_20260817_070015=SNAPSHOT)
    first, second = standardize_gps(read_gps(spark, root)).orderBy("vehicle_id").collect()
    assert (first.line_number, first.fleet_number) == ("8A", "0089")
    assert (first.speed_kmh, first.heading_deg) == (None, None)
    assert (first.lat, first.lon) == (59.42621, 24.65889)
    assert first.extract_ts == datetime(2026, 8, 17, 7, 0, 15)
    assert str(first.extract_date) == "2026-08-17"
    assert first.destination == "MÄNNIKU"
    assert (second.heading_deg, second.speed_kmh) == (45, 17)
    assert second.destination == "Balti jaam, peatus"


def test_instant_ignores_session_zone(spark, tmp_path):
    root = gps_root(tmp_path, gps_20260817_070015=SNAPSHOT)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = standardize_gps(read_gps(spark, root)).select(F.unix_seconds("extract_ts").alias("s"))
        assert df.first().s == 1786950015
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_misnamed_file_fails_strict_and_is_null_lenient(spark, tmp_path):
    root = gps_root(tmp_path, gps_latest=SNAPSHOT)
    raw = read_gps(spark, root)
    with pytest.raises(Exception, match="not an instant"):
        standardize_gps(raw).collect()
    rows = standardize_gps(raw, LENIENT).collect()
    assert len(rows) == 2 and all(r.extract_ts is None for r in rows)
    assert bad_gps_rows(raw).filter("bad").count() == 2


def test_bad_number_fails_strict_and_is_null_lenient(spark, tmp_path):
    bad = SNAPSHOT.replace("59426210", "north")
    root = gps_root(tmp_path, gps_20260817_070015=bad)
    raw = read_gps(spark, root)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        standardize_gps(raw).collect()
    lats = [r.lat for r in standardize_gps(raw, LENIENT).orderBy("vehicle_id").collect()]
    assert lats == [None, 59.42]
    assert bad_gps_rows(raw).filter("bad").count() == 1


def test_only_asked_dates_are_read(spark, tmp_path):
    put(tmp_path / DAY / "gps_20260817_070015.csv", SNAPSHOT)
    other = tmp_path / "extract_source=gps/extract_date=2026-08-18/gps_20260818_070015.csv"
    put(other, SNAPSHOT * 2)
    root = str(tmp_path)
    assert [str(r[0]) for r in discover_dates(spark, root, "gps").collect()] == [
        "2026-08-17", "2026-08-18",
    ]
    assert read_gps(spark, root, ["2026-08-18"]).count() == 4
    assert read_gps(spark, root, ["2026-08-18", "2026-08-20"]).count() == 4
    assert read_gps(spark, root).count() == 6
    assert discover_dates(spark, root, "gps", ["2026-08-18", "2026-08-20"]).count() == 1
    assert discover_dates(spark, root, "gtfs").count() == 0


def member(root, name, text, day="2026-08-17", stamp="20260817_041500"):
    put(root / f"extract_source=gtfs/extract_date={day}/extract_ts={stamp}/{name}", text)


ROUTES = (
    "﻿route_id,agency,route_short_name,route_long_name,route_desc,route_type,route_url,"
    "route_color,route_text_color,route_sort_order\n"
    'r1,a,8,"Kaarli, Kopli",,3,,,,12\n'
    'r2,a,1,"Say ""hi""",,900,,,,\n'
)


def test_header_file_with_bom_quotes_and_extra_column(spark, tmp_path):
    member(tmp_path, "routes.txt", ROUTES)
    rows = standardize_gtfs(read_gtfs(spark, str(tmp_path), "gtfs_routes"), "gtfs_routes")
    first, second = rows.orderBy("route_id").collect()
    assert (first.route_id, first.route_type, first.route_sort_order) == ("r1", 3, 12)
    assert first.route_long_name == "Kaarli, Kopli"
    assert (second.route_long_name, second.route_sort_order) == ('Say "hi"', None)
    assert first.extract_ts == datetime(2026, 8, 17, 4, 15)
    assert "agency" not in rows.columns


def test_columns_are_found_by_name(spark, tmp_path):
    columns = list(reversed(GTFS_TABLES["gtfs_calendar_dates"]))
    member(tmp_path, "calendar_dates.txt", ",".join(columns) + "\n2,20260224,s1\n")
    raw = read_gtfs(spark, str(tmp_path), "gtfs_calendar_dates")
    row = standardize_gtfs(raw, "gtfs_calendar_dates").first()
    assert (row.service_id, str(row.date), row.exception_type) == ("s1", "2026-02-24", 2)


def test_missing_column_is_an_error(spark, tmp_path):
    member(tmp_path, "routes.txt", "route_id\nr1\n")
    with pytest.raises(ValueError, match="route_short_name"):
        read_gtfs(spark, str(tmp_path), "gtfs_routes")


def test_disagreeing_headers_are_refused(spark, tmp_path):
    member(tmp_path, "calendar_dates.txt", "service_id,date,exception_type\ns,20260101,1\n")
    member(
        tmp_path, "calendar_dates.txt", "date,service_id,exception_type\n20260102,s,1\n",
        day="2026-08-18", stamp="20260818_041500",
    )
    with pytest.raises(Exception, match="CSV header"):
        read_gtfs(spark, str(tmp_path), "gtfs_calendar_dates").collect()


def test_bad_route_type(spark, tmp_path):
    member(tmp_path, "routes.txt", ROUTES.replace(",900,", ",tram,"))
    raw = read_gtfs(spark, str(tmp_path), "gtfs_routes")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        standardize_gtfs(raw, "gtfs_routes").collect()
    kinds = standardize_gtfs(raw, "gtfs_routes", LENIENT).orderBy("route_id").collect()
    assert [r.route_type for r in kinds] == [3, None]


def test_newest_extract_and_stray_folder(spark, tmp_path):
    head = "service_id,date,exception_type\n"
    member(tmp_path, "calendar_dates.txt", head + "old,20260101,1\n")
    member(tmp_path, "calendar_dates.txt", head + "new,20260101,1\n", stamp="20260817_161500")
    stray = tmp_path / "extract_source=gtfs/extract_date=2026-08-17/tmpab12"
    put(stray / "calendar_dates.txt", head + "stray,20260101,1\n")
    root = str(tmp_path)
    latest = read_gtfs(spark, root, "gtfs_calendar_dates").collect()
    assert [r.service_id for r in latest] == ["new"]
    with pytest.raises(FileNotFoundError, match="2026-08-19"):
        read_gtfs(spark, root, "gtfs_calendar_dates", ["2026-08-17", "2026-08-19"])
    every = read_gtfs(spark, root, "gtfs_calendar_dates", extracts="all").collect()
    assert sorted(r.service_id for r in every) == ["new", "old"]


def test_union_refuses_other_types(spark):
    one = spark.createDataFrame([(1, "a")], "n int, s string")
    two = spark.createDataFrame([("b", 2)], "s string, n int")
    assert union_snapshots([one, two]).count() == 2
    with pytest.raises(ValueError, match="differs"):
        union_snapshots([one, spark.createDataFrame([("x", "b")], "n string, s string")])
    with pytest.raises(ValueError, match="differs"):
        union_snapshots([one, one.select("n")])


GOOD = "1,8,24700000,59400000,10,90,v1,Z,0089,Kopli\n"


def test_ragged_lines_fail_strict_and_are_reported(spark, tmp_path):
    folder = tmp_path / "extract_source=gps" / "extract_date=2026-08-17"
    put(folder / "gps_20260817_070000.csv", GOOD + GOOD.strip() + ",extra\n" + "1,8,24700000\n")
    raw = read_gps(spark, str(tmp_path))
    assert sorted(len(r.malformed or "") for r in raw.collect()) == [0, 12, len(GOOD) + 5]
    assert bad_gps_rows(raw).filter("bad").count() == 2
    with pytest.raises(Exception, match="wrong number of fields"):
        standardize_gps(raw).collect()
    assert standardize_gps(raw, "lenient").count() == 3


def test_mixed_layouts_and_stray_files(spark, tmp_path):
    base = tmp_path / "extract_source=gps"
    put(base / "extract_date=2026-08-17" / "gps_20260817_070000.csv", GOOD)
    put(base / "extract_date=2026-08-17" / "gps_20260817_070500.csv.part", GOOD)
    put(base / "extract_date=2026-08-17" / "notes.json", "{}")
    put(base / "extract_date=2026-08-17" / "gps_file=gps_20260817_071000.csv" / "part-0.csv", GOOD)
    put(base / "extract_date=2026-08-18" / "gps_file=gps_20260818_070000.csv" / "part-0.csv", GOOD)
    rows = standardize_gps(read_gps(spark, str(tmp_path))).collect()
    assert sorted((str(r.extract_date), str(r.extract_ts)) for r in rows) == [
        ("2026-08-17", "2026-08-17 07:00:00"), ("2026-08-17", "2026-08-17 07:10:00"),
        ("2026-08-18", "2026-08-18 07:00:00"),
    ]


def test_absent_date_is_an_empty_table(spark, tmp_path):
    rows = standardize_gps(read_gps(spark, str(tmp_path), ["2026-08-17"]))
    assert rows.count() == 0 and "lat" in rows.columns


def test_quoted_line_breaks_and_ragged_schedule_lines(spark, tmp_path):
    header = "stop_id,stop_code,stop_name,stop_desc,stop_lat,stop_lon,stop_url,location_type,parent_station,thoreb_id"
    folder = tmp_path / "extract_source=gtfs" / "extract_date=2026-08-17" / "extract_ts=20260817_041500"
    put(folder / "stops.txt", header + '\ns1,,A,"two\nlines ""x""",59.1,24.1,,,,\ns2,,B,,59.2,24.2,,,,\ns3,,C\n')
    rows = {r.stop_id: r for r in read_gtfs(spark, str(tmp_path), "gtfs_stops").collect()}
    assert set(rows) == {"s1", "s2", "s3"} and rows["s1"].stop_desc == 'two\nlines "x"'
    assert rows["s1"].malformed is None and rows["s3"].malformed is not None
    with pytest.raises(Exception, match="wrong number of fields"):
        standardize_gtfs(read_gtfs(spark, str(tmp_path), "gtfs_stops"), "gtfs_stops").collect()
