from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from headway.functions.casting import LENIENT, stamp_to_instant, typed, unreadable

STAMPS = {
    "20240229_235959": 1709251199,
    "19691231_235959": -1,
    "20230229_000000": None,
    "20241301_000000": None,
    "20240101_240000": None,
    "20240101_006000": None,
    "20240101_00000": None,
    "20240101-000000": None,
    "2024010a_000000": None,
    "2024 1 1_000000": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stamps(spark, zone):
    df = spark.createDataFrame([(s,) for s in STAMPS], "s string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seconds = F.unix_seconds(stamp_to_instant(F.col("s"), LENIENT)).alias("t")
        assert {r.s: r.t for r in df.select("s", seconds).collect()} == STAMPS
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_strict_stamp_names_the_text(spark):
    df = spark.createDataFrame([("20241301_000000",)], "s string")
    with pytest.raises(Exception, match="not an instant: 20241301_000000"):
        df.select(stamp_to_instant(F.col("s"))).collect()


def test_typed_dates_and_numbers(spark):
    df = spark.createDataFrame([("20240229", "7"), ("2024", "x"), (None, None)], "d string, n string")
    rows = df.select(
        typed(F.col("d"), "date", LENIENT).cast("string").alias("d"),
        typed(F.col("n"), "int", LENIENT).alias("n"),
        unreadable(F.col("d"), "date").alias("bad_d"),
        unreadable(F.col("n"), "int").alias("bad_n"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("2024-02-29", 7, False, False), (None, None, True, True), (None, None, False, False),
    ]
    with pytest.raises(ValueError, match="mode"):
        typed(F.col("d"), "date", "loose")
