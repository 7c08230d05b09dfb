"""Removal of word windows that start earlier in the corpus, by level-wise doubling.

Windows of a quarter of the length asked for are looked at first. Those that are repeated,
and those alone, are extended to twice the length, and so on up to the full length, where
what is still repeated is removed but for its first occurrence.

1. Quarter length. A full window is spoken for by one quarter window in it, that of the
   smallest hash, which equal full windows share. Consecutive full windows with the same one
   are a run. Runs whose quarter window is in no other run go.
2. Runs that are equal word for word are one candidate from here on, the first of them: each
   full window of the others is repeated. Where all runs of a quarter window are equal
   nothing is left to extend. The others are extended to half the length, to the side on
   which the full windows have room, which cuts a run in two. Halves that are in no other
   candidate go.
3. The full windows of what is left are counted one by one; all but the first of equal ones
   are repeated.

Equal runs of a block of texts are joined in the task that finds them and a quarter window
of a block is one row in the shuffle, so a passage that many documents share is one row per
block. Windows are known by pairs of 64-bit hashes: a run with its quarter window, a full
window with its half.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.common import SPACES, SpanHash, blocks, free_name, keep, mixed, utf8, words
from headway.llm.ordering import with_order

WORDS = 20
SEGMENT = 4 << 20  # bytes whose words are hashed at a time
SPREAD = np.uint64(0x9E3779B97F4A7C15)
RUN_BITS = 12  # of the number of windows in a run, beside its start
FIRST, KNOWN, REPEAT = 0, 1, 2  # of a quarter window in its block, another run of it, equal to an earlier run

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True


def segments(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of at most SEGMENT bytes that end at white space, or where a word that long does."""
    at = 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        while end < len(data):
            gap = np.flatnonzero(IS_SPACE[data[end : end + 4096]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + 4096, len(data))
        yield at, end
        at = end


def hashed_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word."""
    codes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, end in segments(data):
        piece = data[at:end]
        begin, stop, row = words(piece, np.clip(starts, at, end) - at)
        codes.append(SpanHash(piece).of(begin, stop))
        rows.append(row)
    return np.concatenate(codes), np.concatenate(rows)


def doubled(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of windows of twice `size` words from those of `size` words."""
    if len(codes) <= size:
        return codes[:0]
    return mixed(mixed(codes[:-size] * SPREAD + np.uint64(size)) + codes[size:])


def of_size(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of windows of `size` words from those of the words."""
    code = np.full(max(len(codes) - size + 1, 0), size, np.uint64)
    for i in range(size):
        code = mixed(code * SPREAD + codes[i : i + len(code)])
    return code


class Levels:
    """Hashes of quarter, half and full windows of a block of texts, and its runs.

    Run i consists of the full windows that start at `first[i]` and the `count[i] - 1` words
    after it; its quarter window starts at `anchor[i]`. Places count the words of the block.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, size: int):
        self.size, least = size, size // 4
        codes, row = hashed_words(data, starts)
        self.quarter = of_size(codes, least)
        self.half = doubled(self.quarter, least)
        self.full = doubled(self.half, 2 * least)
        # the first word of each row
        self.opens = np.searchsorted(row, np.arange(len(starts) - 1))
        whole = row[size - 1 :] == row[: len(self.full)] if len(self.full) else np.zeros(0, bool)
        at = np.flatnonzero(whole)
        own = self._anchors()[at]
        new = np.ones(len(at), bool)
        new[1:] = (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)
        edge = np.flatnonzero(new)
        self.first, self.anchor = at[edge], own[edge]
        self.count = np.diff(np.append(edge, len(at)))
        self.row = row[self.first]

    def _anchors(self) -> np.ndarray:
        """For each full window the smallest quarter window in it, the last of equal ones."""
        low = np.uint64((1 << 31) - 1)
        place = np.arange(len(self.quarter), dtype=np.uint64)
        key = (self.quarter & ~low) | (low - place)
        width, reach = self.size - self.size // 4 + 1, 1
        if len(key) < width:
            return np.zeros(0, np.int64)
        while reach * 2 <= width:
            key = np.minimum(key[:-reach], key[reach:])
            reach *= 2
        rest = width - reach
        key = np.minimum(key[: len(key) - rest], key[rest:]) if rest else key
        return (low - (key & low)).astype(np.int64)

    def contents(self) -> np.ndarray:
        """A hash of all words of each run; its first and last full window cover them."""
        ends = self.full[self.first] + mixed(self.full[self.first + self.count - 1])
        shape = self.count.astype(np.uint64) << np.uint64(32) | (self.anchor - self.first).astype(np.uint64)
        return mixed(ends + mixed(shape))


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def local_runs(documents: DataFrame, size: int) -> DataFrame:
    """quarter, run, doc, start, n, kind and several: runs after joining equal ones of a block.

    `several` tells whether the block has other runs of the same quarter window.
    """
    names = ["quarter", "run", "doc", "start", "n", "kind", "several"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                level = Levels(*utf8(part.column("text")), size)
                if not len(level.first):
                    continue
                doc = part.column("doc").to_numpy(zero_copy_only=False)[level.row]
                start, n = level.first - level.opens[level.row], level.count
                quarter, code = level.quarter[level.anchor], level.contents()
                order = np.lexsort((start, doc, code, quarter))
                doc, start, n, quarter, code = (x[order] for x in (doc, start, n, quarter, code))
                new_quarter = np.ones(len(doc), bool)
                new_quarter[1:] = quarter[1:] != quarter[:-1]
                new = new_quarter.copy()
                new[1:] |= code[1:] != code[:-1]
                lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
                group = np.cumsum(new_quarter) - 1
                several = (np.bincount(group, new) > 1)[group]
                again = ~new & ((doc != doc[lead]) | (start != start[lead]))
                kind = np.where(again, REPEAT, np.where(new_quarter, FIRST, KNOWN))
                # rows that repeat their own document add nothing
                shown = new | again
                columns = [as_long(x[shown]) for x in (quarter, code, doc, start)]
                columns += [pa.array(x[shown].astype(np.int32)) for x in (n, kind)]
                yield pa.record_batch([*columns, pa.array(several[shown])], names=names)

    return documents.select("doc", "text").mapInArrow(
        run, "quarter long, run long, doc long, start long, n int, kind int, several boolean"
    )


def met_runs(local: DataFrame) -> DataFrame:
    """quarter, run, doc, start, n of each block's distinct runs whose quarter window is repeated.

    A quarter window is one row per block here, so no key is hot.
    """
    same = Window.partitionBy("quarter")
    own = ["quarter", "run", "doc", "start", "n"]
    first = local.filter(F.col("kind") == FIRST).withColumn("blocks", F.count("*").over(same))
    known = local.filter(F.col("kind") == KNOWN)
    return first.filter("several or blocks > 1").select(*own).unionByName(known.select(*own))


def halves(documents: DataFrame, candidates: DataFrame, size: int) -> DataFrame:
    """half, doc, start, n, fulls: the candidates extended to half the length, on either side.

    `fulls` has the hashes of the full windows, for the next level.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["half", "doc", "start", "n", "fulls"]
        for batch in batches:
            for part in blocks(batch, "text"):
                level = Levels(*utf8(part.column("text")), size)
                asked = part.column("starts")
                sizes = asked.value_lengths().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(part.num_rows), sizes)
                wanted = level.opens[row] + asked.flatten().to_numpy(zero_copy_only=False)
                at = np.searchsorted(level.first, wanted)
                first, anchor, end = level.first[at], level.anchor[at], (level.first + level.count)[at]
                # windows from here on have room for the half that starts at the anchor
                turn = np.clip(anchor - size // 2, first, end)
                left, right = first < turn, turn < end
                begin = np.concatenate([first[left], turn[right]])
                stop = np.concatenate([turn[left], end[right]])
                half = np.concatenate([
                    level.half[anchor[left] + size // 4 - size // 2], level.half[anchor[right]],
                ])
                owner = np.concatenate([row[left], row[right]])
                n = stop - begin
                offsets = np.concatenate([[0], np.cumsum(n)])
                each = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n) + np.repeat(begin, n)
                doc = part.column("doc").to_numpy(zero_copy_only=False)[owner]
                fulls = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), as_long(level.full[each]))
                columns = [as_long(half), as_long(doc), as_long(begin - level.opens[owner]), as_long(n), fulls]
                yield pa.record_batch(columns, names=names)

    grouped = candidates.groupBy("doc").agg(F.collect_set("start").alias("starts"))
    return documents.join(grouped, "doc").select("doc", "text", "starts").mapInArrow(
        run, "half long, doc long, start long, n long, fulls array<long>"
    )


def repeated(documents: DataFrame, size: int = WORDS) -> DataFrame:
    """doc, start, n: every window of `size` words that starts earlier, as runs of starts.

    `documents` has the columns doc, which orders them, and text. Runs may overlap.
    """
    if size % 4:
        raise ValueError(f"windows are doubled twice, so {size} words must be a multiple of four")
    local = keep(local_runs(documents, size), "runs")
    same = Window.partitionBy("quarter", "run").orderBy("doc", "start")
    met = met_runs(local).withColumn("lead", F.first(F.struct("doc", "start")).over(same))
    met = keep(met.withColumn("leads", F.struct("doc", "start") == F.col("lead")).drop("lead"), "met-runs")
    leads = met.filter("leads").select("quarter", "run", "doc", "start").distinct()
    several = leads.groupBy("quarter").agg(F.count("*").alias("runs")).filter("runs > 1").select("quarter")
    candidates = leads.join(keep(several, "quarters"), "quarter", "left_semi")
    half = keep(halves(documents, keep(candidates.select("doc", "start"), "candidates"), size), "halves")
    again = half.groupBy("half").agg(F.count("*").alias("places")).filter("places > 1").select("half")
    half = half.join(keep(again, "repeated-halves"), "half", "left_semi")
    full = half.select("half", "doc", "start", F.posexplode("fulls").alias("at", "full"))
    full = keep(full.select("half", "full", "doc", (F.col("start") + F.col("at")).alias("start")), "fulls")
    firsts = full.groupBy("half", "full").agg(
        F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("places")
    )
    firsts = keep(firsts.filter("places > 1").drop("places"), "first-fulls")
    later = full.join(firsts, ["half", "full"]).filter(F.struct("doc", "start") != F.col("first"))
    runs = local.filter(F.col("kind") == REPEAT).unionByName(met.filter("not leads"), allowMissingColumns=True)
    return runs.select("doc", "start", F.col("n").cast("long").alias("n")).unionByName(
        later.select("doc", "start", F.lit(1).cast("long").alias("n"))
    )


def covered(count: int, first: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Which of `count` words lie in windows of `size` words that start in the given runs."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, np.minimum(first + n + size - 1, count), -1)
    return np.cumsum(change[:-1]) > 0


def kept_words(
    data: np.ndarray, starts: np.ndarray, begin: np.ndarray, end: np.ndarray, row: np.ndarray
) -> list[bytes]:
    """The given words of each row, joined by one space."""
    change = np.zeros(len(data) + 2, np.int8)
    change[begin] += 1
    # with the byte after it, which is white space unless the row ends there
    change[end + (end < starts[row + 1])] -= 1
    shown = np.cumsum(change[: len(data)], dtype=np.int8) > 0
    out = np.where(IS_SPACE[data], np.uint8(32), data)[shown].tobytes()
    place = np.concatenate([[0], np.cumsum(shown)])[starts]
    return [out[a:b].rstrip(b" ") for a, b in zip(place[:-1].tolist(), place[1:].tolist())]


def with_runs(documents: DataFrame, size: int, order: str, runs: str) -> DataFrame:
    """The documents with `order` and `runs`, the packed runs of repeats or null."""
    numbered = with_order(documents, order)
    found = repeated(numbered.select(F.col(order).alias("doc"), "text"), size).groupBy(F.col("doc").alias(order)).agg(
        F.collect_set(F.shiftleft("start", RUN_BITS).bitwiseOR(F.col("n"))).alias(runs)
    )
    return numbered.join(found, order, "left")


def left_over(part: pa.RecordBatch, runs: str, size: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words and removed words of each row of a block, and what is left of it."""
    data, starts = utf8(part.column("text"))
    begin, end, row = words(data, starts)
    opens = np.searchsorted(row, np.arange(part.num_rows + 1))
    lost = np.zeros(len(row), bool)
    for i, packed in enumerate(part.column(runs)):
        if packed.is_valid:
            code = packed.values.to_numpy(zero_copy_only=False)
            a, b = opens[i], opens[i + 1]
            lost[a:b] = covered(int(b - a), code >> RUN_BITS, code & ((1 << RUN_BITS) - 1), size)
    left = ~lost
    removed = np.bincount(row[lost], minlength=part.num_rows)
    return np.diff(opens), removed, kept_words(data, starts, begin[left], end[left], row[left])


def summaries(documents: DataFrame, size: int = WORDS) -> DataFrame:
    """Words, removed words and the digest of the words left, per document.

    A null, empty or blank text has no word and the digest of nothing, as has a text of which
    nothing is left. Rows that repeat a doc_id and its text are one document and get the same
    result each; other texts of a repeated id, and rows without an id, which come last, are
    documents of their own. An empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                n, removed, left = left_over(part, "runs", size)
                digests = [hashlib.sha256(x).hexdigest() for x in left]
                yield pa.record_batch(
                    [part.column("doc_id"), as_long(n), as_long(removed), pa.array(digests, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    found = with_runs(documents.select("doc_id", "text"), size, "order", "runs")
    return found.select("doc_id", "text", "runs").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


def without_repeats(documents: DataFrame, size: int = WORDS) -> DataFrame:
    """The documents without the words removed; `n_chars`, if there, is set to what is left.

    A text that loses words has the others joined by one space; all others stay as they are.
    """
    names = documents.columns
    order, runs = free_name(documents, "order"), free_name(documents, "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                _, removed, left = left_over(part, runs, size)
                cut = [x.decode() if n else None for n, x in zip(removed, left)]
                text = pa.array(cut, part.column("text").type)
                text = pc.if_else(pa.array(removed > 0), text, part.column("text"))
                yield pa.record_batch([text if c == "text" else part.column(c) for c in names], names=names)

    out = with_runs(documents, size, order, runs).mapInArrow(run, documents.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out
