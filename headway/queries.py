"""One callable per operator: (spark, table folder) to a DataFrame that can be checked.

Each reads whole benchmark tables, through the adapter views or through landing
areas that Spark writes from them. Instants and dates are shown as text, so that
every engine prints them alike; load times are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.fixtures import landing
from headway.fixtures.adapter import table, view
from headway.functions.casting import LENIENT, typed
from headway.functions.clock import in_local_window
from headway.operators.control import (
    at_resolved_date,
    control_table,
    create_control_table,
    read_control,
    resolve_date,
    resolve_dates,
    upsert_control,
    upsert_control_table,
    write_control,
)
from headway.operators.layer import compact, create_layer, files_per_date, read_layer
from headway.operators.sinks import create_schemas, replace_table, write_dates
from headway.operators.standardize import standardize_gps, standardize_gtfs
from headway.operators.union import union_snapshots
from headway.plans.backfill import backfill, dates_between, rejected_rows
from headway.plans.distances import distances_to_targets, stop_distances, with_grid
from headway.plans.migrate import (
    apply_shift,
    plan_rename,
    plan_shift,
    relabel_partitions,
    rename_folders,
    shift_counts,
    shift_files,
)
from headway.plans.schedule import bucket_schedule, scheduled_trips
from headway.plans.validate import validate_layer
from headway.schemas import GPS_RAW_COLUMNS, GTFS_TABLES
from headway.session import shared_folder, use_utc
from headway.sources.archives import archive_status, read_archive_table, unpack_archives
from headway.sources.landing import discover_dates, read_gps, read_gtfs
from headway.sources.store import Store
from headway.streaming.gps import start_gps_stream, start_layer_stream, stream_gps

Query = Callable[[SparkSession, str], DataFrame]

LINE, HEADSIGN, FLEET = "7", "männiku", "0007"
FIRST_STOP, SECOND_STOP = "3", "7"

# the middle of the days the events cover
HALFTIME = "2024-01-16"

MORNING = ("06:30", "09:15", "Europe/Tallinn")
NIGHT = ("22:15", "01:45", "Europe/Tallinn")


def shown(df: DataFrame) -> DataFrame:
    """Instants and dates as text, without the load time."""
    columns = []
    for field in df.schema:
        kind = field.dataType.simpleString()
        if field.name == "updated_ts":
            continue
        if kind.startswith("timestamp"):
            columns.append(F.date_format(field.name, "yyyy-MM-dd HH:mm:ss").alias(field.name))
        elif kind == "date":
            columns.append(F.col(field.name).cast("string").alias(field.name))
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 3) for c in columns})


# ---- sources ----------------------------------------------------------------


def scan_headerless_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_gps(spark, landing.gps_landing(spark, sf_dir)).select(*GPS_RAW_COLUMNS)


def scan_string_csv_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing.gtfs_landing(spark, sf_dir, "gtfs_stop_times")
    return read_gtfs(spark, root, "gtfs_stop_times").select(
        "trip_id",
        "arrival_time",
        "departure_time",
        "stop_id",
        typed(F.col("stop_sequence"), "int").alias("stop_sequence"),
    )


def _places(stops: DataFrame, routes: DataFrame) -> DataFrame:
    return stops.select(
        F.lit("stops").alias("member"),
        F.col("stop_id").alias("id"),
        F.col("stop_name").alias("name"),
        typed(F.col("stop_lat"), "double").alias("lat"),
        "extract_ts",
    ).unionByName(
        routes.select(
            F.lit("routes").alias("member"),
            F.col("route_id").alias("id"),
            F.col("route_long_name").alias("name"),
            F.lit(0.0).alias("lat"),
            "extract_ts",
        )
    )


def scan_zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing.archive_landing(spark, sf_dir)
    stops, routes = (
        read_archive_table(spark, root, name, extracts="all", absent="skip")
        for name in ("gtfs_stops", "gtfs_routes")
    )
    return _places(stops, routes)


def archives_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing.archive_landing(spark, sf_dir)
    return archive_status(spark, root).select(
        F.regexp_extract("path", r"gtfs_(\d{8}_\d{6})\.zip$", 1).alias("extract_ts"),
        "members",
        "status",
    )


def archives_unpacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing.archive_landing(spark, sf_dir)
    out = shared_folder(spark, "unpacked")
    unpack_archives(spark, root, out)
    unpack_archives(spark, root, out)  # finds nothing left to do
    stops, routes = (
        read_gtfs(spark, out, name, extracts="all") for name in ("gtfs_stops", "gtfs_routes")
    )
    return _places(stops, routes)


def _stop_extracts(spark: SparkSession, sf_dir: str, extracts: str) -> DataFrame:
    root = landing.stops_landing(spark, sf_dir)
    return read_gtfs(spark, root, "gtfs_stops", extracts=extracts).select(
        "stop_id", "stop_name", "stop_desc", "extract_date", "extract_ts"
    )


def scan_hive_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stop_extracts(spark, sf_dir, "all")


def latest_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stop_extracts(spark, sf_dir, "latest")


def csv_date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing.gtfs_landing(spark, sf_dir, "gtfs_calendar_dates")
    raw = read_gtfs(spark, root, "gtfs_calendar_dates")
    return shown(
        raw.select(
            "service_id",
            F.col("date").alias("written"),
            typed(F.col("date"), "date").alias("date"),
        )
    )


def discovered_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(discover_dates(spark, landing.gps_landing(spark, sf_dir), "gps"))


# ---- standardized tables ----------------------------------------------------


def std_gps_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_gps(spark, landing.gps_landing(spark, sf_dir))
    return shown(standardize_gps(raw))


def std_gps_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_gps(spark, landing.gps_landing_misnamed(spark, sf_dir))
    return shown(standardize_gps(raw, LENIENT))


def _std_gtfs(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = landing.gtfs_landing(spark, sf_dir, name)
        return shown(standardize_gtfs(read_gtfs(spark, root, name), name))

    return query


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardized positions straight from the adapter view, without a landing area."""
    raw = view(spark, sf_dir, "gps_raw")
    named = F.concat(F.lit("/"), F.date_format("snapshot_ts", landing.SNAPSHOT_NAME))
    texts = [F.col(c).cast("string").alias(c) for c in GPS_RAW_COLUMNS]
    return standardize_gps(
        raw.select(
            *texts, named.alias("snapshot_file"), F.to_date("snapshot_ts").alias("extract_date")
        )
    ).withColumnRenamed("extract_date", "date")


def snapshots_united(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "gps_raw")
    halves = [
        rows.filter(F.col("snapshot_ts") < HALFTIME),
        rows.filter(F.col("snapshot_ts") >= HALFTIME),
    ]
    return shown(union_snapshots(halves))


# ---- sinks and jobs ---------------------------------------------------------

_VERSIONED = ["vehicle_id", "extract_ts", "lat", "lon", "transport_type", "date"]


def _two_writes(spark: SparkSession, sf_dir: str, name: str, overwrite: bool) -> DataFrame:
    """Write some dates, then write again with another transport type; read back."""
    out = shared_folder(spark, name)
    rows = _positions(spark, sf_dir).select(*_VERSIONED)
    early, late = (rows.filter(F.col("date") < HALFTIME), rows.filter(F.col("date") >= HALFTIME))
    changed = F.col("transport_type") + 10
    if overwrite:
        write_dates(rows, out)
        write_dates(late.withColumn("transport_type", changed), out, overwrite=True)
    else:
        write_dates(early, out)
        write_dates(rows.withColumn("transport_type", changed), out)
    return shown(spark.read.parquet(out).select(*_VERSIONED))


def write_skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_writes(spark, sf_dir, "skip-existing", overwrite=False)


def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_writes(spark, sf_dir, "overwrite", overwrite=True)


def table_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    # names of their own: the session's catalog may hold real tables
    run = uuid.uuid4().hex
    names = [f"headway_check_{name}_{run}" for name in ("standardized", "intermediate", "config")]
    create_schemas(spark, names, shared_folder(spark, "databases"))
    target = f"{names[0]}.gtfs_trips"
    rows = standardize_gtfs(
        read_gtfs(spark, landing.gtfs_landing(spark, sf_dir, "gtfs_trips"), "gtfs_trips"),
        "gtfs_trips",
    )
    replace_table(rows.withColumn("trip_headsign", F.lit("old")), target)
    return shown(replace_table(rows, target)).select(
        "trip_id", "route_id", "service_id", "trip_headsign"
    )


def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tenth to the twelfth day first, then the whole range that has landed."""
    root, out = landing.gps_landing(spark, sf_dir), shared_folder(spark, "backfill")
    landed = [row.extract_date for row in discover_dates(spark, root, "gps").collect()]
    first, last = landed[0], landed[-1]
    early = dates_between(first + timedelta(days=9), first + timedelta(days=11))
    backfill(spark, "gps_positions", root, out, early)
    report = backfill(spark, "gps_positions", root, out, dates_between(first, last))
    stored = (
        spark.read.parquet(f"{out}/gps_positions")
        .groupBy(F.col("date").cast("date").alias("date"))
        .agg(F.count("*").alias("stored"))
    )
    return shown(
        report.join(stored, "date", "left").select(
            "date", "status", F.coalesce("stored", F.lit(0)).alias("stored")
        )
    )


def backfill_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates with a misnamed snapshot fail, the others are written."""
    root, out = landing.gps_landing_misnamed(spark, sf_dir), shared_folder(spark, "isolation")
    return shown(backfill(spark, "gps_positions", root, out).drop("model"))


def rejected_snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing.gps_landing_misnamed(spark, sf_dir)
    return rejected_rows(spark, "gps_positions", root).select(*GPS_RAW_COLUMNS, "extract_date")


def scan_resolved_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of the date the control table names: here the last one landed."""
    params = (
        table(spark, sf_dir, "events")
        .agg(F.max(F.to_date("ts")).alias("extract_date"))
        .select(F.lit("gps").alias("source"), "extract_date", F.lit(True).alias("active"))
    )
    root = landing.gps_landing(spark, sf_dir)
    return shown(standardize_gps(read_gps(spark, root, [resolve_date(params, "gps")])))


def scan_resolved_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from the standardized table: the date prunes its partitions at run time."""
    params = (
        table(spark, sf_dir, "events")
        .agg(F.max(F.to_date("ts")).alias("extract_date"))
        .select(F.lit("gps").alias("source"), "extract_date", F.lit(True).alias("active"))
    )
    rows = spark.read.parquet(_by_date(spark, sf_dir))
    return shown(at_resolved_date(rows, params, "gps").withColumnRenamed("date", "extract_date"))


def find_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All positions of one vehicle from a table clustered by line, with bloom filters."""
    out = shared_folder(spark, "clustered")
    write_dates(
        _positions(spark, sf_dir), out, sort_by=["line_number", "extract_ts"], find_by=("fleet_number", "vehicle_id")
    )
    found = spark.read.parquet(out).filter(F.col("fleet_number") == FLEET)
    return shown(found.withColumnRenamed("date", "extract_date"))


def _vehicle_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.concat(F.lit("vehicle-"), F.col("user_id").cast("string")).alias("source"),
        F.to_date("ts").alias("day"),
    )


def _params(rows: DataFrame) -> DataFrame:
    """A control row per vehicle: its last day, every third one inactive."""
    return rows.groupBy("source", "user_id").agg(F.max("day").alias("extract_date")).select(
        "source",
        "extract_date",
        (F.col("user_id") % 3 != 0).alias("active"),
        F.lit("seed").alias("comment"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("updated_ts"),
    )


def upsert_control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = _vehicle_dates(spark, sf_dir), shared_folder(spark, "control")
    write_control(_params(rows.filter(F.col("day") < HALFTIME)), path)
    incoming = (
        rows.filter(F.col("day") >= HALFTIME)
        .groupBy("source")
        .agg(F.max("day").alias("extract_date"))
    )
    write_control(upsert_control(read_control(spark, path), incoming), path)
    return shown(read_control(spark, path))


def upsert_control_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert into the catalog table, whose first rows come from an INSERT.

    A version that was never committed lies beside it.
    """
    rows, path = _vehicle_dates(spark, sf_dir), shared_folder(spark, "control-catalog")
    database = f"headway_check_{uuid.uuid4().hex}"
    create_schemas(spark, [database], path)
    name = f"{database}.source_params"
    create_control_table(spark, name)
    seed = _params(rows.filter(F.col("day") < HALFTIME)).select(*spark.table(name).columns)
    spark.sql(f"INSERT INTO {name} SELECT * FROM {{seed}}", seed=seed)
    incoming = (
        rows.filter(F.col("day") >= HALFTIME)
        .groupBy("source")
        .agg(F.max("day").alias("extract_date"))
    )
    upsert_control_table(spark, name, incoming)
    seed.limit(1).write.parquet(f"{path}/{database}/source_params/version=2/attempt=died")
    return shown(control_table(spark, name))


def control_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inserted with key and date only take the table's defaults."""
    database = f"headway_check_{uuid.uuid4().hex}"
    create_schemas(spark, [database], shared_folder(spark, "control-database"))
    name = f"{database}.source_params"
    create_control_table(spark, name)
    rows = _vehicle_dates(spark, sf_dir).groupBy("source").agg(F.max("day").alias("day"))
    spark.sql(f"INSERT INTO {name} (source, extract_date) SELECT * FROM {{rows}}", rows=rows)
    stored = spark.table(name)
    stamped = F.col("updated_ts").isNotNull().cast("int").alias("stamped")
    return shown(stored.select("source", "extract_date", "active", "comment", stamped))


def resolve_extract_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vehicle_dates(spark, sf_dir)
    asked = rows.select("source").distinct()
    return resolve_dates(_params(rows), asked, date(2024, 2, 15))


def local_time_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        in_local_window(F.col("ts"), *MORNING).cast("int").alias("in_morning"),
        in_local_window(F.col("ts"), *NIGHT).cast("int").alias("in_night"),
    )


def _filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File records of snapshots filed under their UTC and again under their local date."""
    snapshots = view(spark, sf_dir, "gps_raw").select("snapshot_ts").distinct()
    dates = [
        F.date_format("snapshot_ts", "yyyy-MM-dd"),
        F.date_format(F.expr("snapshot_ts + INTERVAL 3 HOURS"), "yyyy-MM-dd"),
    ]
    return snapshots.select(
        F.lit("gps").alias("source"),
        F.explode(F.array_distinct(F.array(*dates))).alias("extract_date"),
        F.date_format("snapshot_ts", landing.SNAPSHOT_NAME).alias("file_name"),
    )


def shift_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_shift(_filings(spark, sf_dir))


def shift_partitions_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shift_counts(plan_shift(_filings(spark, sf_dir)))


def shift_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_folder(spark, "shifted")
    apply_shift(_positions(spark, sf_dir), out)
    return shown(spark.read.parquet(out).select("vehicle_id", "extract_ts", "lat", "lon", "date"))


def shifted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every landed file after snapshots filed twice were moved three hours back."""
    root = landing.refiled_landing(spark, sf_dir)
    shift_files(spark, root)
    name = F.regexp_extract("snapshot_file", r"extract_date=[^/]+/(?:[^/=]+=)?([^/]+)", 1)
    return (
        read_gps(spark, root)
        .groupBy("extract_date", name.alias("file_name"))
        .agg(F.count("*").alias("rows"), F.sum(F.col("vehicle_id").cast("bigint")).alias("vehicles"))
    )


def _by_date(spark: SparkSession, sf_dir: str) -> str:
    out = shared_folder(spark, "by-date")
    write_dates(_positions(spark, sf_dir).select(*_VERSIONED), out)
    return out


_RENAMED = ["vehicle_id", "extract_ts", "lat", "lon", "extract_date"]


def rename_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table over the folders of the old key."""
    database = f"headway_check_{uuid.uuid4().hex}"
    create_schemas(spark, [database], shared_folder(spark, "renamed-database"))
    table = relabel_partitions(spark, _by_date(spark, sf_dir), f"{database}.gps_positions")
    return shown(table.select(*_RENAMED))


def rename_key_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folders themselves renamed."""
    path = _by_date(spark, sf_dir)
    rename_folders(spark, path)
    return shown(spark.read.parquet(path).select(*_RENAMED))


def rename_key_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_rename(spark, _by_date(spark, sf_dir))
    return plan.select("old_folder", "new_folder")


def validate_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    gps = standardize_gps(read_gps(spark, landing.gps_landing(spark, sf_dir)))
    tables = {
        name: standardize_gtfs(read_gtfs(spark, landing.gtfs_landing(spark, sf_dir, name), name), name)
        for name in GTFS_TABLES
    }
    return validate_layer({"gps_positions": gps, **tables}, "extract_date")


def stream_gps_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing.gps_landing(spark, sf_dir)
    target, checkpoint = shared_folder(spark, "stream"), shared_folder(spark, "stream-state")
    for _ in range(2):  # the second run finds every file taken
        start_gps_stream(spark, root, target, checkpoint).awaitTermination()
    return shown(spark.read.parquet(target)).withColumnRenamed("date", "extract_date")


def _layered(spark: SparkSession, sf_dir: str) -> tuple[str, list[date]]:
    """A catalog table whose later half of days was streamed and whose earlier half backfilled.

    The stream takes some files at a time, and its last batch runs twice, as after a crash
    between the write and the stream's own record of it.
    """
    root = landing.gps_landing(spark, sf_dir)
    days = [row.extract_date for row in discover_dates(spark, root, "gps").collect()]
    database, path = f"headway_check_{uuid.uuid4().hex}", shared_folder(spark, "layer")
    create_schemas(spark, [database], f"{path}/database")
    name, state = f"{database}.gps_positions", f"{path}/state"
    create_layer(spark, name, f"{path}/table", stream_gps(spark, root).schema)
    streamed = days[len(days) // 2 :]
    files = len(Store(spark, root).entries(f"{root}/extract_source=gps/extract_date={streamed[0]}"))
    for _ in range(2):
        query = start_layer_stream(
            spark, root, name, state, max_files=files * len(streamed), dates=streamed
        )
        query.awaitTermination()
        commits = Store(spark, state)
        last = max((e.name for e in commits.entries(f"{state}/commits") if e.name.isdigit()), key=int)
        commits.remove(f"{state}/commits/{last}")
    backfill(spark, "gps_positions", root, "", layer=name)
    return name, days


def stream_and_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a table that a stream and a backfill share, once."""
    name, _ = _layered(spark, sf_dir)
    return shown(read_layer(spark, name)).withColumnRenamed("date", "extract_date")


def compact_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and files of each date after all but the last were compacted."""
    name, days = _layered(spark, sf_dir)
    compact(spark, name, days[-1])
    files = files_per_date(spark, name)
    counted = read_layer(spark, name).groupBy("date").agg(F.count("*").alias("stored"))
    one = [day for day, n in files.items() if n == 1]
    closed = (F.col("date") < F.lit(days[-1])).alias("closed")
    return shown(
        counted.select("date", "stored", closed, (F.col("date").isin(one) | ~closed).alias("within_bound"))
    )


# ---- analytical queries -----------------------------------------------------


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [
        view(spark, sf_dir, name)
        for name in ("gtfs_routes", "gtfs_trips", "gtfs_stop_times", "gtfs_calendar")
    ]
    return scheduled_trips(
        *frames, line=LINE, headsign=HEADSIGN, first_stop=FIRST_STOP, second_stop=SECOND_STOP
    )


def trips_scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_trips(spark, sf_dir).drop("travel_duration"))


def trips_scheduled_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from tables that are bucketed by trip."""
    database = f"headway_check_{uuid.uuid4().hex}"
    create_schemas(spark, [database], shared_folder(spark, "bucketed"))
    routes, trips, stop_times, calendar = (
        view(spark, sf_dir, name)
        for name in ("gtfs_routes", "gtfs_trips", "gtfs_stop_times", "gtfs_calendar")
    )
    names = (f"{database}.gtfs_trips", f"{database}.gtfs_stop_times")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trips, stop_times = bucket_schedule(trips, stop_times, names, buckets)
    found = scheduled_trips(
        routes, trips, stop_times, calendar,
        line=LINE, headsign=HEADSIGN, first_stop=FIRST_STOP, second_stop=SECOND_STOP,
    )
    return shown(found.drop("travel_duration"))


def travel_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    took = F.col("travel_duration")
    minutes = (F.extract(F.lit("DAY"), took) * 24 + F.extract(F.lit("HOUR"), took)) * 60
    return (
        _trips(spark, sf_dir)
        .filter(took.isNotNull())
        .select(
            "trip_id",
            "travel_seconds",
            (minutes + F.extract(F.lit("MINUTE"), took)).cast("int").alias("whole_minutes"),
        )
    )


def _stop_distance(
    *methods: str, fleet: str = FLEET, stop: str = FIRST_STOP, numeric: bool = False, far: bool = False
) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stops = view(spark, sf_dir, "gtfs_stops")
        if far:  # to the other side of the globe
            stops = stops.withColumns({"stop_lat": -F.col("stop_lat") / 2, "stop_lon": F.col("stop_lon") + 120})
        found = stop_distances(
            _positions(spark, sf_dir),
            stops,
            line=LINE,
            destination=HEADSIGN,
            fleet_number=fleet,
            stop_id=stop,
            methods=methods,
            numeric_ids=numeric,
        )
        names = [f"{method}_m" for method in methods]
        return rounded(
            shown(found.select("extract_ts", "vehicle_id", "fleet_number", "lat", "lon", *names)),
            *names,
        )

    return query


def project_lest97_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = with_grid(_positions(spark, sf_dir).select("vehicle_id", "lat", "lon"))
    return rounded(grid, "northing", "easting")


def stop_distance_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position of every line to the stop that carries the line's number."""
    stops = view(spark, sf_dir, "gtfs_stops")
    targets = stops.select(F.col("stop_id").alias("line_number"), "stop_id")
    found = distances_to_targets(
        _positions(spark, sf_dir), stops, targets, ("planar", "sphere", "spheroid")
    )
    names = ["planar_m", "sphere_m", "spheroid_m"]
    kept = ["extract_ts", "vehicle_id", "line_number", "stop_id", "lat", "lon"]
    return rounded(shown(found.select(*kept, *names)), *names)


QUERIES: dict[str, Query] = {
    "scan_headerless_csv": scan_headerless_csv,
    "scan_string_csv_cast": scan_string_csv_cast,
    "scan_zip_members": scan_zip_members,
    "archive_status": archives_checked,
    "unpack_archives": archives_unpacked,
    "scan_hive_partitions": scan_hive_partitions,
    "latest_extract": latest_extract,
    "csv_date_format": csv_date_format,
    "discover_dates": discovered_dates,
    "std_gps_positions": std_gps_positions,
    "std_gps_lenient": std_gps_lenient,
    "std_gtfs_routes": _std_gtfs("gtfs_routes"),
    "std_gtfs_stops": _std_gtfs("gtfs_stops"),
    "std_gtfs_trips": _std_gtfs("gtfs_trips"),
    "std_gtfs_stop_times": _std_gtfs("gtfs_stop_times"),
    "std_gtfs_calendar": _std_gtfs("gtfs_calendar"),
    "std_gtfs_calendar_dates": _std_gtfs("gtfs_calendar_dates"),
    "union_snapshots": snapshots_united,
    "write_skip_existing": write_skip_existing,
    "write_overwrite": write_overwrite,
    "replace_table": table_replaced,
    "backfill_range": backfill_range,
    "backfill_isolation": backfill_isolation,
    "rejected_rows": rejected_snapshot_rows,
    "upsert_control": upsert_control_rows,
    "upsert_control_table": upsert_control_catalog,
    "control_defaults": control_defaults,
    "resolve_extract_date": resolve_extract_date,
    "scan_resolved_date": scan_resolved_date,
    "scan_resolved_partition": scan_resolved_partition,
    "find_vehicle": find_vehicle,
    "local_time_window": local_time_window,
    "scheduled_trips": trips_scheduled,
    "scheduled_trips_bucketed": trips_scheduled_bucketed,
    "travel_duration": travel_duration,
    "stop_distance_planar": _stop_distance("planar"),
    "stop_distance_projected": _stop_distance("projected"),
    "stop_distance_sphere": _stop_distance("sphere"),
    "stop_distance_spheroid": _stop_distance("spheroid"),
    "stop_distance_numeric_id": _stop_distance("planar", fleet="7", stop="003", numeric=True),
    "stop_distance_far": _stop_distance("spheroid", far=True),
    "stop_distance_targets": stop_distance_targets,
    "project_lest97": project_lest97_grid,
    "shift_partitions": shift_partitions,
    "shift_counts": shift_partitions_counts,
    "shift_apply": shift_apply,
    "shift_files": shifted_files,
    "rename_partition_key": rename_key,
    "rename_folders": rename_key_folders,
    "rename_plan": rename_key_plan,
    "validate_layer": validate_tables,
    "stream_gps_positions": stream_gps_positions,
    "stream_and_backfill": stream_and_backfill,
    "compact_dates": compact_dates,
}


def _in_utc(query: Query) -> Query:
    return lambda spark, sf_dir: query(use_utc(spark), sf_dir)


def all_queries() -> dict[str, Query]:
    return {name: _in_utc(query) for name, query in QUERIES.items()}
