"""Helpers on Arrow batches of text: bounded slices, words and hashes of byte spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from headway.session import shared_folder

BLOCK_BYTES = 2 << 20  # numpy work takes about a hundred times as much memory
FILE_ROWS = 100_000  # of a table of numbers, one or two MB
SLICE_BYTES = 256 << 10  # of a block, where numpy holds several numbers for each byte
# white space of the word pattern [^\x20\x09-\x0D]+
SPACES = (32, 9, 10, 11, 12, 13)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """Write `df` below the shared folder and read it back: a cut of the lineage.

    `most` is a bound of its rows, of a few numbers each, where it is known: every task writes
    as many as make a file worth its while. Hadoop forks a process for each file it makes.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    if most is not None:
        df = few(df, most)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, most: int) -> DataFrame:
    """`df` in no more parts than at most `most` rows of a few numbers make files worth their while."""
    return df.coalesce(max(1, -(-most // FILE_ROWS)))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores in front as keep it apart from the columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row starts; null rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    if not len(column) or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    starts = np.frombuffer(
        buffers[1], width, len(column) + 1, column.offset * np.dtype(width).itemsize
    ).astype(np.int64)
    if buffers[2] is None or starts[0] == starts[-1]:
        return np.zeros(0, np.uint8), starts - starts[0]
    data = np.frombuffer(buffers[2], np.uint8)[starts[0] : starts[-1]]
    return data, starts - starts[0]


def blocks(
    batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of `batch` with at most `limit` bytes of `column`, or a single row."""
    _, starts = utf8(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(starts, starts[first] + limit, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def by_rows(starts: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """First row and end of slices with at most `limit` bytes, or a single row."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = int(np.searchsorted(starts, starts[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and row of each word of [^\\x20\\x09-\\x0D]+."""
    is_space = np.zeros(256, bool)
    is_space[list(SPACES)] = True
    gap = is_space[data]
    opens, closes = ~gap, ~gap
    filled = np.flatnonzero(starts[1:] > starts[:-1])
    first, last = starts[filled], starts[filled + 1] - 1
    opens[1:] &= gap[:-1]
    closes[:-1] &= gap[1:]
    opens[first], closes[last] = ~gap[first], ~gap[last]
    begin = np.flatnonzero(opens)
    return begin, np.flatnonzero(closes) + 1, np.searchsorted(starts, begin, "right") - 1


class SpanHash:
    """64-bit hashes of byte spans of `data`, from prefix sums of a polynomial."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, data: np.ndarray, seed: int = 1):
        byte = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(self.BASE + 2 * seed))
        power = np.full(len(data) + 1, self.BASE, np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(byte[data] * power[:-1], out=self.sums[1:])
        self.back = np.full(len(data) + 1, pow(self.BASE, -1, 1 << 64), np.uint64)
        self.back[0] = 1
        np.cumprod(self.back, out=self.back)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = (end - begin).astype(np.uint64)
        return mixed((self.sums[end] - self.sums[begin]) * self.back[begin] + size)


def sums_by(row: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(row, weights, minlength=n).astype(np.int64)
