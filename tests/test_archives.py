from __future__ import annotations

import io
import os
import random
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import put
from headway.plans.backfill import backfill
from headway.session import shared_folder
from headway.sources import archives
from headway.sources.archives import archive_status, read_archive_table, unpack_archives
from headway.sources.landing import discover_dates, read_gtfs

HEAD = "exception_type,service_id,date,note\n"


def archive(**members: str) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
        for name, text in members.items():
            out.writestr(f"{name}.txt", text)
    return buffer.getvalue()


def land(root, day, stamp, content):
    put(root / f"extract_source=gtfs/extract_date={day}/gtfs_{stamp}.zip", content)


@pytest.fixture
def root(tmp_path):
    land(tmp_path, "2026-08-17", "20260817_041500", archive(calendar_dates=HEAD + "1,old,20260101,\n"))
    land(
        tmp_path, "2026-08-17", "20260817_161500",
        archive(calendar_dates=HEAD + '1,"a, b",20260101,x\n2,"two\nlines",20260102,\n,,,\n'),
    )
    land(
        tmp_path, "2026-08-18", "20260818_041500",
        archive(calendar_dates=HEAD + "1,next,20260103,\n", agency="agency_id\r\n7\r\n"),
    )
    return tmp_path


def test_member_of_newest_archive(spark, root):
    rows = read_archive_table(spark, str(root), "gtfs_calendar_dates").collect()
    assert sorted((r.service_id or "", r.extract_ts) for r in rows) == [
        ("", "20260817_161500"),
        ("a, b", "20260817_161500"),
        ("next", "20260818_041500"),
        ("two\nlines", "20260817_161500"),
    ]


def test_all_archives_and_one_date(spark, root):
    every = read_archive_table(spark, str(root), "gtfs_calendar_dates", extracts="all")
    assert every.filter("service_id = 'old'").count() == 1
    one = read_archive_table(spark, str(root), "gtfs_calendar_dates", ["2026-08-18"])
    assert [r.service_id for r in one.collect()] == ["next"]


def test_absent_member_and_date(spark, root):
    with pytest.raises(Exception, match="has no routes.txt"):
        read_archive_table(spark, str(root), "gtfs_routes").collect()
    assert read_archive_table(spark, str(root), "gtfs_routes", absent="skip").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND|no archive"):
        read_archive_table(spark, str(root), "gtfs_routes", ["2020-01-01"]).collect()


def test_damaged_archive_has_a_status(spark, root):
    whole = archive(calendar_dates=HEAD + "".join(f"1,s{i},20260101,\n" for i in range(500)))
    land(root, "2026-08-19", "20260819_041500", whole[: len(whole) // 2])
    flipped = bytearray(whole)
    flipped[120] ^= 0xFF
    land(root, "2026-08-20", "20260820_041500", bytes(flipped))
    rows = archive_status(spark, str(root)).collect()
    found = {r.path[-19:-4]: (r.members, r.status) for r in rows}
    assert found["20260818_041500"] == (2, "ok")
    assert found["20260819_041500"][1] == "corrupt"
    assert found["20260820_041500"][1] == "corrupt"
    assert len(found) == 5


def test_unpack_then_read(spark, root):
    out = shared_folder(spark, "unpack-test")
    assert unpack_archives(spark, str(root), out, ["2026-08-17"]) == 2
    assert unpack_archives(spark, str(root), out) == 1
    assert unpack_archives(spark, str(root), out) == 0
    rows = read_gtfs(spark, out, "gtfs_calendar_dates", extracts="all", multiline=True).collect()
    assert sorted(r.service_id for r in rows if r.service_id) == [
        "a, b", "next", "old", "two\nlines",
    ]
    agency = spark.read.text(f"{out}/extract_source=gtfs/*/*/member=agency.txt")
    assert [r.value for r in agency.collect()] == ["agency_id", "7"]


def test_unpack_beside_the_archives(spark, root):
    """Archives, unpacked extracts and a plain extract folder share the landing area."""
    put(
        root / "extract_source=gtfs/extract_date=2026-08-21/extract_ts=20260821_041500"
        "/calendar_dates.txt",
        "service_id,date,exception_type\nplain,20260104,1\n",
    )
    where = str(root)
    assert unpack_archives(spark, where, where) == 3
    assert unpack_archives(spark, where, where) == 0
    dates = [str(r[0]) for r in discover_dates(spark, where, "gtfs").collect()]
    assert dates == ["2026-08-17", "2026-08-18", "2026-08-21"]
    rows = read_gtfs(spark, where, "gtfs_calendar_dates", multiline=True).collect()
    assert sorted(r.service_id for r in rows if r.service_id) == [
        "a, b", "next", "plain", "two\nlines",
    ]
    report = backfill(spark, "gtfs_calendar_dates", where, shared_folder(spark, "beside"),
                      [date(2026, 8, 18), date(2026, 8, 21), date(2026, 8, 22)])
    assert [r.status for r in report.collect()] == ["written", "written", "failed"]


class Counting:
    """A file that counts the bytes read from it."""

    def __init__(self, file):
        self.file, self.count = file, 0

    def read(self, *size):
        data = self.file.read(*size)
        self.count += len(data)
        return data

    def __getattr__(self, name):
        return getattr(self.file, name)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def test_only_the_directory_and_the_member_are_read(root, monkeypatch):
    noise = {f"big{i}": random.Random(i).randbytes(200_000).hex() for i in range(4)}
    land(root, "2026-08-25", "20260825_041500", archive(calendar_dates=HEAD + "1,s,20260101,\n", **noise))
    path = str(root / "extract_source=gtfs/extract_date=2026-08-25/gtfs_20260825_041500.zip")
    opened, plain = [], archives.open_archive
    monkeypatch.setattr(archives, "open_archive", lambda p: opened.append(Counting(plain(p))) or opened[-1])
    infos = archives._directory(path)
    number = [i.filename for i in infos].index("calendar_dates.txt")
    assert b"".join(archives._pieces(path, number)).decode() == HEAD + "1,s,20260101,\n"
    assert sum(f.count for f in opened) < 10_000 < os.path.getsize(path) / 50
    whole = b"".join(archives._pieces(path, 1 - bool(number == 1)))
    assert len(whole) > 300_000


def test_members_of_one_archive_go_to_several_tasks(spark, root):
    land(root, "2026-08-25", "20260825_041500", archive(**{f"m{i}": f"text {i}\n" * 50 for i in range(40)}))
    listed = archives.list_members(spark, str(root), ["2026-08-25"])
    assert sorted(r.name for r in listed.collect()) == sorted(f"m{i}.txt" for i in range(40))
    paths = [r.path for r in listed.limit(1).collect()]
    dealt = archives._dealt(spark, paths).select(F.spark_partition_id().alias("task")).distinct()
    assert dealt.count() == spark.sparkContext.defaultParallelism
    out = shared_folder(spark, "unpack-many")
    assert unpack_archives(spark, str(root), out, ["2026-08-25"]) == 1
    lines = spark.read.text(f"{out}/extract_source=gtfs/extract_date=2026-08-25")
    assert lines.count() == 40 * 50


def test_names_with_special_characters(tmp_path):
    place = tmp_path / "a b%20c#d"
    put(place / "x.zip", archive(stops="stop_id\n1\n"))
    for path in (f"file:{place}/x.zip", f"file://{place}/x.zip", f"{place}/x.zip"):
        assert [i.filename for i in archives._directory(path)] == ["stops.txt"]
