"""Packing of tokenized documents into fixed windows by best-fit decreasing.

Documents are tokenized in one pass and cut into full windows and a remainder. Pieces of
equal length are interchangeable, so the plan is made from the number of pieces of each
length (at most `window` rows, whatever the input), and every piece finds its place from
its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.common import keep

WINDOW = 2048
END_ID = 1
TABLE_CHUNKS = 400_000
# pre-tokenization of the byte-level vocabulary, a fixed value of its format
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class BytePairEncoder:
    """Little-endian ids of a text under a byte-level `tokenizers` file.

    A pre-token never holds a space behind its first character unless it is white space
    only, so a text may be cut before every space that a visible character follows. Each
    distinct chunk is encoded once while the table has room; special tokens of the file
    are cut out first, as the library does.
    """

    def __init__(self, path: str, limit: int = TABLE_CHUNKS):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in shown}
        for i, b in enumerate(b for b in range(256) if b not in shown):
            letters[chr(256 + i)] = b
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): i
            for token, i in spec["model"]["vocab"].items()
            if token not in self.special
        }
        self.encoding = tiktoken.Encoding(
            "file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.limit, self.table = limit, {}

    def _raw(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        head, *rest = text.split(" ")
        try:
            return self._raw(head) + b"".join(map(self.table.__getitem__, rest))
        except KeyError:
            pass
        # a chunk that starts with white space belongs to what stands before it
        if any(not c or c[0].isspace() for c in rest):
            return self._raw(text)
        new = [c for c in dict.fromkeys(rest) if c not in self.table]
        if len(self.table) + len(new) > self.limit:
            self.table.clear()
            new = list(dict.fromkeys(rest))
        for chunk in new:
            self.table[chunk] = self._raw(f" {chunk}")
        return self._raw(head) + b"".join(map(self.table.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        for token, i in self.special.items():
            if token in text:
                mark = np.array([i], "<u4").tobytes()
                return mark.join(self.encode(part) for part in text.split(token))
        return self._plain(text) if text else b""


def pieces(documents: DataFrame, tokenizer: str, window: int = WINDOW, text: str = "text") -> DataFrame:
    """Full windows of each document and what remains, with the checksum of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BytePairEncoder(tokenizer)
        tail = np.array([END_ID], "<u4").tobytes()
        step = window * 4
        for batch in batches:
            rows, start, length, check, total = [], [], [], [], []
            for row, value in enumerate(batch.column(1)):
                ids = encoder.encode(value.as_py() or "") + tail
                for at in range(0, len(ids), step):
                    part = ids[at : at + step]
                    rows.append(row)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    check.append(zlib.crc32(part))
                    total.append(len(ids) // 4)
            yield pa.record_batch(
                [batch.column(0).take(pa.array(rows, pa.int64())),
                 *(pa.array(x, pa.int64()) for x in (start, length, check, total))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return documents.select("doc_id", text).mapInArrow(run, PIECES)


class OpenWindows:
    """Runs of windows with equal room, in a segment tree indexed by the room left."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, first: int, count: int) -> None:
        if room and count:
            self.runs.setdefault(room, []).append((first, count))
            self._step(room, count)

    def _step(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node //= 2

    def tightest(self, size: int) -> int | None:
        """The smallest room of at least `size`."""
        node = size + self.leaves
        if self.count[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None

    def take(self, room: int) -> tuple[int, int]:
        first, count = self.runs[room].pop()
        self._step(room, -count)
        return first, count


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing on numbers of pieces by length.

    Rows (length, first rank, pieces, first window, pieces per window, offset): the piece of
    rank r goes to window `first + (r - first rank) // per`. A window that takes a piece of
    length s and still holds s is the tightest for the next one, so a run of equal windows
    is filled window after window.
    """
    rows, opened, windows = [], 0, OpenWindows(window)
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            room = windows.tightest(size)
            if room is None:
                room, per = window, window // size
                first, count = opened, -(-left // per)
                opened += count
            else:
                per = room // size
                first, count = windows.take(room)
            full = min(count, left // per)
            if full:
                rows.append((size, rank, full * per, first, per, window - room))
                windows.add(room - per * size, first, full)
                rank, left = rank + full * per, left - full * per
            if left and full < count:
                rows.append((size, rank, left, first + full, per, window - room))
                windows.add(room - left * size, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            windows.add(room, first + full, count - full)
    return rows


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`; equal rows are placed one by one."""
    spark = pieces.sparkSession
    pieces = keep(pieces, "pieces")
    slots = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    slot = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(slots))
    pieces = pieces.withColumn("slot", slot)
    # one row per length and slot, so a length that many pieces share is ranked in parts
    shares = pieces.groupBy("length", "slot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = shares.select("length", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in shares.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.createDataFrame(
        plan(counts, window),
        "length long, first_rank long, n long, first long, per long, room_used long",
    )
    places = places.groupBy("length").agg(
        F.array_sort(F.collect_list(F.struct("first_rank", "n", "first", "per", "room_used"))).alias("places")
    )
    within = Window.partitionBy("length", "slot").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1).join(bases, ["length", "slot"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("base"))
    # at most `window` lengths, so the plan is small whatever the input
    placed = ranked.join(F.broadcast(places), "length").withColumn(
        "place",
        F.filter("places", lambda p: (p.first_rank <= F.col("rank")) & (F.col("rank") < p.first_rank + p.n))[0],
    )
    nth = F.col("rank") - F.col("place.first_rank")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("place.first") + F.floor(nth / F.col("place.per"))).alias("sequence_id"),
        (F.col("place.room_used") + nth % F.col("place.per") * F.col("length")).alias("offset"),
    )


def pack_documents(documents: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Every piece of every document and its place.

    A null text is empty and gives one piece, the end id. Repeated rows are placed each,
    an empty table gives no rows, and columns besides `doc_id` and `text` are not read.
    """
    return pack(pieces(documents, tokenizer, window), window)
