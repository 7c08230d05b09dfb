"""The control table: which extract date each source is read at."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources.store import Store

COMMITS = "_commits"


def create_control_table(spark: SparkSession, name: str) -> None:
    """An empty catalog table with the column defaults.

    Parquet tables take defaults but enforce neither keys nor NOT NULL; `control_table` and
    `upsert_control_table` check both.
    """
    spark.sql(
        f"""
        CREATE TABLE IF NOT EXISTS {name} (
            source STRING NOT NULL,
            extract_date DATE NOT NULL,
            active BOOLEAN DEFAULT true,
            comment STRING,
            updated_ts TIMESTAMP DEFAULT current_timestamp()
        ) USING parquet
        """
    )


def _checked(rows: DataFrame, what: str) -> DataFrame:
    """One row per source; repeated sources and missing values fail the query."""
    payload = [c for c in rows.columns if c != "source"]
    grouped = rows.groupBy("source").agg(
        F.count("*").alias("_n"), *[F.first(c).alias(c) for c in payload]
    )

    def guard(broken: Column, reason: str) -> Column:
        return F.when(broken, F.raise_error(F.lit(f"{what}: {reason}")))

    verdict = F.coalesce(
        guard(F.col("source").isNull(), "source is null"),
        guard(F.col("_n") > 1, "source appears twice"),
        guard(F.col("extract_date").isNull(), "extract_date is null"),
        F.lit(True),
    )
    return grouped.filter(verdict).drop("_n")


def upsert_control(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Apply (source, extract_date) rows to the control table.

    A known source gets the new date and keeps everything else, also its
    `updated_ts`; a new source gets the defaults. Counting per source before the
    join makes the key unique on both sides, so no key can be hot in it.
    """
    old = _checked(current, "control table").withColumn("_known", F.lit(True))
    new = _checked(incoming.select("source", "extract_date"), "incoming rows").withColumnRenamed(
        "extract_date", "_new_date"
    )
    known = F.col("_known").isNotNull()
    return old.join(new, "source", "full_outer").select(
        "source",
        F.coalesce("_new_date", "extract_date").alias("extract_date"),
        F.when(known, F.col("active")).otherwise(F.lit(True)).alias("active"),
        "comment",
        F.when(known, F.col("updated_ts")).otherwise(F.current_timestamp()).alias("updated_ts"),
    )


class LostUpdate(RuntimeError):
    """Another writer committed the version after the one that was read."""


def control_version(spark: SparkSession, path: str) -> int:
    """The newest committed version; 0 if there is none."""
    names = [e.name for e in Store(spark, path).entries(f"{path}/{COMMITS}")]
    return max((int(name) for name in names if name.isdigit()), default=0)


def _version_folder(spark: SparkSession, path: str, version: int) -> str:
    return f"{path}/{Store(spark, path).read(f'{path}/{COMMITS}/{version:08d}')}"


def write_control(df: DataFrame, path: str, after: int | None = None) -> int:
    """Write the table as the version after `after`, by default after the newest one.

    The rows are written to a folder of this attempt, which then becomes the version by a
    marker that only one writer can create; the others get `LostUpdate` and leave nothing.
    Readers go by markers, so a version that was never finished is none.
    """
    spark = df.sparkSession
    store = Store(spark, path)
    version = (control_version(spark, path) if after is None else after) + 1
    folder = f"version={version}/attempt={uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    if not store.create_once(f"{path}/{COMMITS}/{version:08d}", folder):
        store.remove(f"{path}/{folder}")
        raise LostUpdate(f"version {version} of {path} was written by another")
    return version


def read_control(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest committed version, or the one given."""
    version = control_version(spark, path) if version is None else version
    if not version:
        raise FileNotFoundError(f"no control table at {path}")
    return spark.read.parquet(_version_folder(spark, path, version))


def _table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location").rstrip("/")


def control_table(spark: SparkSession, name: str) -> DataFrame:
    """The catalog table at its newest committed version; null and repeated keys fail.

    The catalog is brought up to date if a writer died between its commit and that.
    """
    location = _table_location(spark, name)
    root = location.partition("/version=")[0]
    version = control_version(spark, root)
    if version:
        folder = _version_folder(spark, root, version)
        if folder != location:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    return _checked(spark.table(name), name).select(*spark.table(name).columns)


def upsert_control_table(spark: SparkSession, name: str, incoming: DataFrame) -> int:
    """Upsert into the catalog table itself; returns its new version.

    Keys and dates of both sides are checked. Rows that INSERT put into the table before are
    part of it. Of two upserts from the same version one gets `LostUpdate`.
    """
    root = _table_location(spark, name).partition("/version=")[0]
    version = control_version(spark, root)
    updated = upsert_control(control_table(spark, name), incoming)
    version = write_control(updated.select(*spark.table(name).columns), root, version)
    control_table(spark, name)  # moves the catalog to the new version
    return version


def resolve_dates(
    params: DataFrame, sources: DataFrame, fallback: date | Column | None = None
) -> DataFrame:
    """The extract date of every asked source, as text, and the folder it names.

    An active control row decides; without one it is `fallback`, today if not given.
    """
    default = F.current_date() if fallback is None else fallback
    if not isinstance(default, Column):
        default = F.lit(default)
    active = params.filter(F.col("active")).groupBy("source").agg(
        F.count("*").alias("_n"), F.first("extract_date").alias("extract_date")
    )
    twice = F.raise_error(F.lit("control table: source is active twice")).cast("date")
    active = active.select(
        "source", F.when(F.col("_n") > 1, twice).otherwise(F.col("extract_date")).alias("extract_date")
    )
    resolved = F.coalesce(F.col("extract_date"), default.cast("date")).cast("string")
    return (
        sources.select("source")
        .join(active, "source", "left")
        .select("source", resolved.alias("extract_date"))
        .withColumn(
            "folder",
            F.concat(
                F.lit("extract_source="), "source", F.lit("/extract_date="), "extract_date"
            ),
        )
    )


def resolve_date(
    params: DataFrame, source: str, fallback: date | Column | None = None
) -> str:
    """The extract date of one source, to be put into a scan's path."""
    asked = params.sparkSession.createDataFrame([(source,)], "source string")
    return resolve_dates(params, asked, fallback).first().extract_date


def at_resolved_date(
    rows: DataFrame, params: DataFrame, source: str, fallback: date | Column | None = None, key: str = "date"
) -> DataFrame:
    """The rows of the date that the control table names for the source.

    The date is found as the query runs and prunes the partitions of `rows` then; nothing
    is fetched to plan it.
    """
    asked = params.sparkSession.createDataFrame([(source,)], "source string")
    resolved = resolve_dates(params.filter(F.col("source") == source), asked, fallback)
    return rows.filter(F.col(key) == resolved.select(F.col("extract_date").cast("date")).scalar())
