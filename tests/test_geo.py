from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from headway.functions.geo import project_lest97
from headway.plans.distances import distances_to_targets, stop_distances, with_distances

STOP = (59.42621, 24.65889)

# lat, lon, planar, projected, sphere, spheroid in metres from STOP
GOLDEN = [
    (59.42621, 24.66889, 567.6333, 567.6456, 565.5891, 567.6341),
    (59.43621, 24.65889, 1114.0256, 1114.0496, 1111.9468, 1114.0257),
    (59.4372, 24.7332, 4391.5152, 4391.6152, 4376.2913, 4391.5204),
    (59.35, 24.95, 18594.2952, 18594.5112, 18534.0950, 18594.2931),
    (59.42621, 24.65889, 0.0, 0.0, 0.0, 0.0),
]


def test_golden_distances(spark):
    rows = [(lat, lon, *STOP) for lat, lon, *_ in GOLDEN]
    df = spark.createDataFrame(rows, "lat double, lon double, stop_lat double, stop_lon double")
    for row, (_, _, *expected) in zip(with_distances(df).collect(), GOLDEN):
        found = [row.planar_m, row.projected_m, row.sphere_m, row.spheroid_m]
        assert found == pytest.approx(expected, abs=1e-4)


def test_projection(spark):
    origin = (57 + 31 / 60 + 3.19415 / 3600, 24.0)
    df = spark.createDataFrame([STOP, origin], "lat double, lon double")
    north, east = project_lest97(F.col("lat"), F.col("lon"))
    first, second = df.select(north.alias("n"), east.alias("e")).collect()
    assert (first.n, first.e) == pytest.approx((6587777.6878, 537401.0005), abs=1e-4)
    assert (second.n, second.e) == pytest.approx((6375000, 500000), abs=1e-6)


def test_missing_coordinates_give_nulls(spark):
    df = spark.createDataFrame(
        [(None, 24.0, *STOP), (59.0, 24.0, None, 24.0)],
        "lat double, lon double, stop_lat double, stop_lon double",
    )
    for row in with_distances(df).collect():
        assert row.planar_m is row.projected_m is row.sphere_m is row.spheroid_m is None


def test_equator_and_far_points(spark):
    degree = math.radians(1) * 6378137
    df = spark.createDataFrame(
        [(0.0, 10.0, 0.0, 11.0), (0.0, 0.0, 0.0, 180.0)],
        "lat double, lon double, stop_lat double, stop_lon double",
    )
    near, opposite = with_distances(df, ("sphere", "spheroid")).collect()
    assert near.spheroid_m == pytest.approx(degree, abs=1e-6)
    assert opposite.sphere_m == pytest.approx(math.pi * 6370986, rel=1e-12)


def _positions(spark, rows):
    return spark.createDataFrame(
        rows,
        "extract_ts string, vehicle_id string, fleet_number string, line_number string, "
        "destination string, lat double, lon double",
    )


def _stops(spark, rows):
    return spark.createDataFrame(rows, "stop_id string, stop_lat double, stop_lon double")


ASKED = dict(line="8", destination="Männiku", fleet_number="0089", stop_id="s")


def test_filters_and_order(spark):
    positions = _positions(
        spark,
        [
            ("2", "b", "0089", "8", "männiku", 59.35, 24.95),
            ("1", "a", "0089", "8", "MÄNNIKU", 59.42621, 24.65889),
            ("1", "c", "89", "8", "Männiku", 59.0, 24.0),
            ("1", "d", "0089", "8A", "Männiku", 59.0, 24.0),
            ("1", "e", "0089", "8", "Kopli", 59.0, 24.0),
        ],
    )
    found = stop_distances(positions, _stops(spark, [("s", *STOP), ("t", 1.0, 1.0)]), **ASKED)
    rows = found.collect()
    assert [r.vehicle_id for r in rows] == ["a", "b"]
    assert rows[0].spheroid_m == 0
    assert rows[1].spheroid_m == pytest.approx(18594.2931, abs=1e-4)


def test_unknown_stop_gives_no_rows_and_repeated_stop_fails(spark):
    positions = _positions(spark, [("1", "a", "0089", "8", "Männiku", 59.0, 24.0)])
    assert stop_distances(positions, _stops(spark, [("t", *STOP)]), **ASKED).count() == 0
    twice = _stops(spark, [("s", *STOP), ("s", *STOP)])
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        stop_distances(positions, twice, **ASKED).collect()


@pytest.mark.parametrize("bound", ["10m", "-1"])
def test_targets_by_broadcast_and_by_shuffle(spark, bound):
    """A line holding a third of all positions, against a plain nested loop."""
    rng = random.Random(3)
    lines = ["8"] * 200 + [str(n) for n in range(20) for _ in range(20)]
    positions = [
        (str(i), f"v{i}", f"{i % 7}", line, "Männiku" if i % 2 else "x",
         59.3 + rng.random() / 5, 24.5 + rng.random() / 5)
        for i, line in enumerate(lines)
    ]
    stops = [(str(n), 59.4 + n / 1000, 24.6) for n in range(20)]
    targets = [(str(n), "MÄNNIKU", str(n)) for n in range(20)] + [("8", "männiku", "3")]
    expected = sorted(
        (p[1], s[0])
        for p in positions
        for line, destination, stop in targets
        for s in stops
        if p[3] == line and p[4].lower() == destination.lower() and s[0] == stop
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    found = distances_to_targets(
        _positions(spark, positions),
        _stops(spark, stops),
        spark.createDataFrame(targets, "line_number string, destination string, stop_id string"),
        ("planar",),
    )
    try:
        assert sorted((r.vehicle_id, r.stop_id) for r in found.collect()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# End points and lengths of WGS84 geodesics.
FAR = [
    (0.0, 0.0, 0.5, 179.5, 19936288.579),
    (0.0, 0.0, 0.5, 179.7, 19944127.421),
    (0.0, 0.0, 0.0, 180.0, 20003931.4586),
    (90.0, 0.0, -90.0, 0.0, 20003931.4586),
    (0.0, 0.0, 0.0, 1.0, 111319.4908),
    (0.0, 179.5, 0.0, -179.5, 111319.4908),
    (59.4, 24.7, 59.4, 24.7, 0.0),
]


def test_geodesic_settles_everywhere():
    import numpy as np

    from headway.functions.geo import _geodesic

    for a, b, c, d, metres in FAR:
        ends = [np.array([x]) for x in (a, b, c, d)]
        assert abs(_geodesic(*ends)[0] - metres) < 0.001
        assert abs(_geodesic(*ends[2:], *ends[:2])[0] - metres) < 0.001
    rng = np.random.default_rng(1)
    lat, lon = rng.uniform(-3, 3, 500), rng.uniform(-180, 180, 500)
    other = -lat + rng.uniform(-1, 1, 500), lon + 180 + rng.uniform(-1, 1, 500)
    found = _geodesic(lat, lon, *other)
    assert np.isfinite(found).all() and (found > 19.8e6).all() and (found < 20003931.459).all()
