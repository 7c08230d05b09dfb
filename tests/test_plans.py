"""The plans that matter at scale: what is pushed down, shuffled, broadcast."""

from __future__ import annotations

import contextlib
import io
import re
from datetime import date

import pytest

import __spark_entry__ as entry
from headway.fixtures.adapter import view
from headway.operators.control import at_resolved_date
from headway.operators.sinks import write_dates
from headway.plans.schedule import scheduled_trips

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize(
    "name",
    [
        "scheduled_trips", "travel_duration", "stop_distance_planar", "stop_distance_spheroid",
        "stop_distance_targets", "project_lest97", "local_time_window", "shift_partitions",
        "resolve_extract_date", "std_gps_positions", "std_gtfs_stop_times", "latest_extract",
    ],
)
def test_nothing_is_crossed_or_run_row_by_row(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan


@pytest.mark.parametrize(
    "name", ["std_gps_positions", "std_gtfs_stops", "project_lest97", "local_time_window"]
)
def test_row_wise_work_does_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(entry.queries()[name](spark, SF_DIR))


def test_stop_distances_join_nothing(spark):
    plan = plan_of(entry.queries()["stop_distance_planar"](spark, SF_DIR))
    assert "Join" not in plan
    assert "Subquery" in plan


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    names = ("gtfs_routes", "gtfs_trips", "gtfs_stop_times", "gtfs_calendar")
    tables = []
    for name in names:
        view(spark, SF_DIR, name).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    plan = plan_of(
        scheduled_trips(
            *tables, line="8", headsign="männiku", first_stop="3", second_stop="7"
        )
    )
    assert "In(stop_id, [3,7])" in plan
    assert "EqualTo(route_short_name,8)" in plan
    assert "EqualTo(monday,1)" in plan
    assert "stop_sequence" not in plan


def test_calls_are_combined_before_their_shuffle(spark):
    assert "partial_max" in plan_of(entry.queries()["scheduled_trips"](spark, SF_DIR))


@pytest.mark.parametrize(
    "name",
    ["std_gps_positions", "std_gps_lenient", "stop_distance_planar", "stop_distance_projected",
     "stop_distance_sphere", "project_lest97", "local_time_window", "validate_layer",
     "std_gtfs_trips"],
)
def test_generated_methods_are_small_enough_to_compile(spark, name):
    """The JVM leaves methods above 8000 bytes interpreted."""
    df = entry.queries()[name](spark, SF_DIR)
    out = io.StringIO()
    # an adaptive plan has no code before it has run
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(out):
            df.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000


def test_bucketed_schedule_is_joined_without_an_exchange(spark):
    df = entry.queries()["scheduled_trips_bucketed"](spark, SF_DIR)
    plan = plan_of(df)
    dealt = re.findall(r"Arguments: (\w+partitioning)\((\w+)#", plan)
    # the sort of the result; the distinct routes and services, which are sent to all by size
    assert sorted(dealt) == [
        ("hashpartitioning", "route_id"), ("hashpartitioning", "service_id"), ("rangepartitioning", "trip_id"),
    ]
    assert plan.count("Bucketed: true") == 2 and "Window" not in plan


def test_resolved_date_prunes_partitions_as_it_runs(spark, tmp_path):
    days = [f"2024-01-{d:02d}" for d in range(1, 21)]
    rows = spark.createDataFrame([(d, i) for d in days for i in range(5)], "date string, n int")
    path = str(tmp_path / "t")
    write_dates(rows.withColumn("date", rows.date.cast("date")), path, sort_by=None)
    params = spark.createDataFrame(
        [("gps", date(2024, 1, 7), True), ("gtfs", date(2024, 1, 9), True)],
        "source string, extract_date date, active boolean",
    )
    df = at_resolved_date(spark.read.parquet(path), params, "gps")
    assert [str(r.date) for r in df.collect()] == ["2024-01-07"] * 5
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"FileScan parquet .*PartitionFilters: \[[^]]*subquery", plan.replace("\n", " "))
    assert scanned(df, "numPartitions") == 1
    # a source the table does not name is read at the fallback
    df = at_resolved_date(spark.read.parquet(path), params, "ferry", date(2024, 1, 3))
    assert [str(r.date) for r in df.collect()] == ["2024-01-03"] * 5


def scanned(df, metric):
    """A metric of the only file scan of a query that has run."""
    found, waiting = [], [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        if "Scan parquet" in node.nodeName():
            found.append(node.metrics().apply(metric).value())
        if node.nodeName() == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            waiting.append(node.plan())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    assert len(found) == 1
    return found[0]


def test_one_vehicle_is_found_by_few_row_groups(spark, tmp_path):
    """Sorting by line bounds it, and a vehicle that no other line has passes over the rest."""
    rows = spark.range(200_000).selectExpr(
        "id", "DATE '2024-01-01' AS date", "CAST(id % 50 AS string) AS line_number",
        "lpad(CAST(id % 5000 AS string), 4, '0') AS fleet_number", "timestamp_seconds(id) AS extract_ts",
        "sha2(CAST(id AS string), 256) AS payload",
    )
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.setInt("parquet.block.size", 1 << 20)
    conf.setInt("parquet.page.size.row.check.min", 100)
    try:
        write_dates(rows, plain)
        write_dates(rows, clustered, sort_by=["line_number", "extract_ts"], find_by=("fleet_number",))
    finally:
        conf.unset("parquet.block.size")
        conf.unset("parquet.page.size.row.check.min")
    read = {}
    for name, path in (("plain", plain), ("clustered", clustered)):
        df = spark.read.parquet(path).filter("fleet_number = '0123'")
        assert df.select("id").distinct().count() == 40
        df = df.select("id", "payload")
        assert len(df.collect()) == 40
        read[name] = scanned(df, "numOutputRows")
    assert read["plain"] > 190_000
    assert 0 < read["clustered"] < read["plain"] / 4
