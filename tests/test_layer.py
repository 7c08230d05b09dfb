"""One catalog table written by streams, backfills and compaction."""

from __future__ import annotations

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import put
from headway.operators import layer as layers
from headway.operators.layer import (
    append_batch,
    compact,
    create_layer,
    files_per_date,
    layer_dates,
    read_layer,
    remove_superseded,
    write_layer,
)
from headway.operators.sinks import create_schemas
from headway.operators.standardize import standardize_gps
from headway.sources.landing import read_gps
from headway.sources.store import Store
from headway.streaming.gps import start_layer_stream, stream_gps

LINE = "2,8,24658890,59426210,5,90,v1,Z,0089,Kopli\n"
ONE, TWO, THREE = (date(2026, 8, d) for d in (17, 18, 19))


def land(root, day, hour, text=LINE):
    put(root / f"extract_source=gps/extract_date={day}/gps_{day:%Y%m%d}_{hour:02d}0000.csv", text)


@pytest.fixture
def table(spark, tmp_path):
    database = f"layer_{uuid.uuid4().hex}"
    create_schemas(spark, [database], str(tmp_path / "db"))
    rows = spark.createDataFrame([], "n int, extract_ts timestamp, date date")
    create_layer(spark, f"{database}.t", str(tmp_path / "t"), rows.schema)
    return f"{database}.t"


def rows_of(spark, days, n):
    days = spark.createDataFrame([(d,) for d in days], "date date")
    return days.select(F.lit(n).alias("n"), F.current_timestamp().alias("extract_ts"), "date")


def found(spark, name):
    return sorted((str(r.date), r.n) for r in read_layer(spark, name).collect())


def test_batches_are_added_once(spark, table):
    append_batch(rows_of(spark, [ONE, TWO], 1), table, "s-000")
    append_batch(rows_of(spark, [ONE, TWO], 1), table, "s-000")
    append_batch(rows_of(spark, [TWO, None], 2), table, "s-001")
    expected = [("2026-08-17", 1), ("2026-08-18", 1), ("2026-08-18", 2), ("None", 2)]
    assert found(spark, table) == expected
    assert layer_dates(spark, table) == [ONE, TWO]


def test_a_batch_that_died_half_way_is_resumed(spark, table, monkeypatch):
    batch = rows_of(spark, [ONE, TWO, THREE], 1)
    move, moves = Store.move, []

    def dies(self, source, target):
        if len(moves) == 1:
            raise OSError("gone")
        moves.append(source)
        move(self, source, target)

    monkeypatch.setattr(Store, "move", dies)
    with pytest.raises(OSError):
        append_batch(batch, table, "s-000")
    monkeypatch.setattr(Store, "move", move)
    assert len(found(spark, table)) == 1
    # what is staged counts, not what the batch would give now
    append_batch(rows_of(spark, [ONE], 9), table, "s-000")
    assert found(spark, table) == [(str(d), 1) for d in (ONE, TWO, THREE)]


def test_dates_are_skipped_or_change_over(spark, table):
    append_batch(rows_of(spark, [ONE], 1), table, "s-000")
    assert write_layer(rows_of(spark, [ONE, TWO], 2), table) == [ONE]
    assert found(spark, table) == [("2026-08-17", 1), ("2026-08-18", 2)]
    under_way = read_layer(spark, table).select("n").toLocalIterator()
    first = next(under_way).n
    assert write_layer(rows_of(spark, [ONE], 3), table, overwrite=True) == []
    append_batch(rows_of(spark, [ONE], 4), table, "s-001")
    assert found(spark, table) == [("2026-08-17", 3), ("2026-08-17", 4), ("2026-08-18", 2)]
    # whoever reads the old files is not disturbed until they are removed
    assert sorted([first, *(r.n for r in under_way)]) == [1, 2]
    assert remove_superseded(spark, table, 3600) == 0
    assert remove_superseded(spark, table, 0) == 1
    assert found(spark, table) == [("2026-08-17", 3), ("2026-08-17", 4), ("2026-08-18", 2)]


def test_compaction_changes_over_as_a_whole(spark, table, monkeypatch):
    for i in range(6):
        append_batch(rows_of(spark, [ONE, TWO], i), table, f"s-{i:03d}")
    before = found(spark, table)
    assert files_per_date(spark, table) == {ONE: 6, TWO: 6}
    written = layers._written

    def with_late_batch(*args):
        written(*args)
        append_late()

    def append_late():
        monkeypatch.setattr(layers, "_written", written)
        append_batch(rows_of(spark, [ONE], 77), table, "s-900")

    monkeypatch.setattr(layers, "_written", with_late_batch)
    assert compact(spark, table, TWO) == [ONE]
    assert files_per_date(spark, table) == {ONE: 2, TWO: 6}
    assert found(spark, table) == sorted([*before, ("2026-08-17", 77)])
    assert compact(spark, table, THREE) == [ONE, TWO]
    assert files_per_date(spark, table) == {ONE: 1, TWO: 1}
    assert compact(spark, table, THREE) == []
    remove_superseded(spark, table, 0)
    assert found(spark, table) == sorted([*before, ("2026-08-17", 77)])


def test_existing_folders_become_partitions(spark, tmp_path):
    rows = rows_of(spark, [ONE, TWO], 1)
    rows.write.partitionBy("date").parquet(str(tmp_path / "old"))
    create_schemas(spark, ["layer_recovered"], str(tmp_path / "db"))
    create_layer(spark, "layer_recovered.t", str(tmp_path / "old"), rows.schema)
    assert layer_dates(spark, "layer_recovered.t") == [ONE, TWO]
    assert len(found(spark, "layer_recovered.t")) == 2


def test_stream_and_backfill_share_a_table(spark, tmp_path):
    raw, state = tmp_path / "raw", str(tmp_path / "state")
    for hour in range(4):
        land(raw, ONE, hour)
        land(raw, TWO, hour)
    create_schemas(spark, ["layer_shared"], str(tmp_path / "db"))
    name, schema = "layer_shared.gps", stream_gps(spark, str(raw)).schema
    create_layer(spark, name, str(tmp_path / "t"), schema)

    def run():
        start_layer_stream(spark, str(raw), name, state, max_files=1, dates=[TWO, THREE]).awaitTermination()

    run()
    assert files_per_date(spark, name) == {TWO: 4}
    # the last batch was added but not recorded by the stream, so it is run again
    last = max(e.name for e in Store(spark, state).entries(f"{state}/commits") if e.name.isdigit())
    Store(spark, state).remove(f"{state}/commits/{last}")
    land(raw, THREE, 5)
    run()
    rows = standardize_gps(read_gps(spark, str(raw))).withColumnRenamed("extract_date", "date")
    assert write_layer(rows, name) == [TWO, THREE]
    counts = {r.date: r["count"] for r in read_layer(spark, name).groupBy("date").count().collect()}
    assert counts == {ONE: 4, TWO: 4, THREE: 1}
    stamps = read_layer(spark, name).select("date", "extract_ts").distinct().count()
    assert stamps == 9
    # only the record of the last batch is kept
    assert len(Store(spark, str(tmp_path)).entries(str(tmp_path / "t/_staging"))) == 1
