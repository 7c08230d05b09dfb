"""Continuous standardization of arriving snapshots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from headway.functions.casting import LENIENT
from headway.operators.layer import append_batch, forget_batches
from headway.operators.standardize import standardize_gps
from headway.sources.landing import GPS_OPTIONS, date_glob, gps_raw_schema, with_snapshot_file


def stream_gps(
    spark: SparkSession,
    root: str,
    mode: str = LENIENT,
    max_files: int = 10_000,
    dates: list[date | str] | None = None,
) -> DataFrame:
    """Standardized positions of each snapshot as it lands, of all dates or the given ones.

    Row by row: no state is kept.
    """
    raw = (
        spark.readStream.schema(gps_raw_schema())
        .option("maxFilesPerTrigger", max_files)
        # a late file is taken however old its time is; the default drops it after a week
        .option("maxFileAge", "36500d")
        .options(**GPS_OPTIONS)
        .csv(date_glob(root, "gps", dates))
    )
    return standardize_gps(with_snapshot_file(raw), mode).withColumnRenamed("extract_date", "date")


def start_gps_stream(
    spark: SparkSession,
    root: str,
    target: str,
    checkpoint: str,
    interval: str | None = None,
    mode: str = LENIENT,
    max_files: int = 10_000,
) -> StreamingQuery:
    """Append the stream to a date-partitioned table.

    The checkpoint records which files were taken, so each is taken once, also
    across restarts. With `interval` ("15 seconds") it runs on; without it takes
    what has landed and stops. The checkpoint must lie in a shared folder.
    """
    writer = (
        stream_gps(spark, root, mode, max_files)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("date")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_layer_stream(
    spark: SparkSession,
    root: str,
    name: str,
    checkpoint: str,
    interval: str | None = None,
    mode: str = LENIENT,
    max_files: int = 10_000,
    dates: list[date | str] | None = None,
) -> StreamingQuery:
    """Append the stream to a catalog table that backfills and compaction write, too.

    A batch is known by the id in the checkpoint and its number, and is added once, also when
    it is run again after a crash. `interval` and checkpoint are as in `start_gps_stream`.
    """

    def add(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        append_batch(rows, name, f"{stream}-{number:012d}")
        # a batch starts when the one before is settled
        forget_batches(session, name, stream, number)

    writer = (
        stream_gps(spark, root, mode, max_files, dates)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
