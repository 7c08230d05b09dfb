"""Writers of date-partitioned and catalog tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources.store import Store


def dates_of(names: Iterable[str]) -> list[date]:
    """The dates among folder values, oldest first; undated rows lie in a folder that is none."""
    found = []
    for name in names:
        try:
            found.append(date.fromisoformat(name))
        except ValueError:
            continue
    return sorted(found)


def written_dates(spark: SparkSession, path: str, key: str = "date") -> list[date]:
    """Dates that have a folder below `path`. A date without rows is given none."""
    return dates_of(Store(spark, path).folders(path, key))


def check_not_streamed(spark: SparkSession, path: str) -> None:
    """A file sink's table has a list of its files; Spark reads no others beside it."""
    if Store(spark, path).exists(f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is written by a stream; files added to it would not be read")


def write_dates(
    df: DataFrame,
    path: str,
    key: str = "date",
    overwrite: bool = False,
    sort_by: str | list[str] | None = "extract_ts",
    find_by: tuple[str, ...] = (),
) -> list[date]:
    """Write one folder per date; return the dates left alone because they exist.

    Without `overwrite` existing dates are filtered out before the read, which
    prunes their input partitions. With it only the dates in `df` are replaced.
    Dates without rows get no folder. The rebalance gathers the many small
    snapshot files of a date, and splits a date that is too large for one task.

    Rows are sorted by `sort_by` within each file, so a filter on its first column, or a
    range of it, passes over row groups by their bounds. The columns of `find_by` get bloom
    filters, by which a filter for one value passes over row groups that lack it.
    """
    check_not_streamed(df.sparkSession, path)
    skipped: list[date] = []
    if not overwrite:
        skipped = written_dates(df.sparkSession, path, key)
        if skipped:
            df = df.filter(F.col(key).isNull() | ~F.col(key).isin(skipped))
    out = df.hint("rebalance", key)
    if sort_by:
        out = out.sortWithinPartitions(key, *([sort_by] if isinstance(sort_by, str) else sort_by))
    blooms = {f"parquet.bloom.filter.enabled#{name}": "true" for name in find_by}
    (
        out.write.mode("overwrite")
        .options(**blooms)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )
    return skipped


def create_schemas(spark: SparkSession, names: list[str], location: str | None = None) -> None:
    """Databases, where absent; `location` is their common parent folder."""
    for name in names:
        where = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Replace a catalog table with the rows of `df` and return the table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)
