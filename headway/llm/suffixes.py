"""Removal of long byte strings that start earlier in the corpus, by families of suffix arrays.

A string of `span` bytes is judged by the suffix that starts with it. Three steps keep the
suffixes that have to be sorted few, without losing a match:

1. In each string the smallest hash of its `GRAM`-byte grams names an anchor, which equal
   strings share. Consecutive strings with one anchor form a region. A region whose anchor
   gram occurs in no other region holds no repeat. Equal regions are pre-aggregated, in a
   task and over all: those after the first hold nothing but repeats.
2. Distinct regions that share an anchor gram are dealt by it to buckets of the suffix
   space. In a bucket, batches come in document order. Each gets a suffix array, which is
   merge-scanned against the levels of the bucket's family: a suffix that agrees over `span`
   bytes with one of a level, or with an earlier one of its batch, is a repeat. The others
   become a new level, and levels merge when they are of about equal size, so a family has
   logarithmically many.
3. The repeats of each document are united into runs of bytes.

A gram that more regions share than half an average bucket holds is split: its suffixes go
by their whole `span` bytes, as 16-byte fingerprints, to a bucket each, equal ones of one
task after joining to the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.common import SpanHash, blocks, by_rows, free_name, keep, mixed, utf8
from headway.llm.ordering import with_order

SPAN = 100
GRAM = 16
BATCH = 100_000  # suffixes of one new suffix array
BUCKET = 500_000  # suffixes of one bucket
LEAST_SHARE = 64  # regions of a gram that are never split
PLACE_BITS = 31
LAST = np.iinfo(np.int64).max
FIRST, KNOWN, REPEAT = 0, 1, 2  # of a gram in its task, another of a known gram, equal to an earlier


def regions(data: np.ndarray, starts: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Row, first string, number of strings, gram and content of every region."""
    found = []
    # regions are few, but finding them takes a dozen numbers for each byte
    for first, end in by_rows(starts):
        row, *rest = slice_regions(data[starts[first] : starts[end]], starts[first : end + 1] - starts[first], span)
        found.append((row + first, *rest))
    return tuple(map(np.concatenate, zip(*found))) if found else slice_regions(data, starts, span)


def slice_regions(data: np.ndarray, starts: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """The regions of a few rows.

    Ties between equal grams go to the last one in the string, so the anchor depends on the
    string's bytes alone.
    """
    none = np.zeros(0, np.int64)
    if len(data) < span:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes = SpanHash(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = hashes.of(at, at + GRAM)
    low = np.uint64((1 << PLACE_BITS) - 1)
    key = (gram & ~low) | (low - at.astype(np.uint64))
    width, reach = span - GRAM + 1, 1
    while reach * 2 <= width:
        key = np.minimum(key[:-reach], key[reach:])
        reach *= 2
    rest = width - reach
    key = np.minimum(key[: len(key) - rest], key[rest:]) if rest else key
    anchor = (low - (key & low)).astype(np.int64)
    fits = np.ones(len(anchor), bool)
    # strings that would run into the next row
    sizes = np.diff(starts)
    for row_end, size in zip(starts[1:][sizes > 0], sizes[sizes > 0]):
        fits[max(row_end - min(span - 1, size), 0) : row_end] = False
    first = np.flatnonzero(fits)
    if not len(first):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    own = anchor[first]
    edge = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (first[1:] != first[:-1] + 1)]))
    count = np.diff(np.append(edge, len(first)))
    begin, own = first[edge], own[edge]
    row = np.searchsorted(starts, begin, "right") - 1
    content = hashes.of(begin, begin + count + span - 1)
    content = mixed(content + mixed((own - begin).astype(np.uint64)))
    return row, begin - starts[row], count, gram[own], content


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def doc_ids(column: pa.Array) -> np.ndarray:
    """Rows without an id come after all others."""
    return column.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def local_regions(documents: DataFrame, span: int) -> DataFrame:
    """gram, content, doc, place: regions after joining the equal ones of a block.

    `place` holds start, number of strings, whether the block knows several contents of the
    gram, and the kind of row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                row, start, count, gram, content = regions(*utf8(part.column("text")), span)
                if not len(row):
                    continue
                doc = doc_ids(part.column("doc_id"))[row]
                order = np.lexsort((start, doc, content, gram))
                doc, start, count, gram, content = (x[order] for x in (doc, start, count, gram, content))
                new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
                new = new_gram | np.concatenate([[True], content[1:] != content[:-1]])
                lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
                group = np.cumsum(new_gram) - 1
                several = (np.bincount(group, new) > 1)[group]
                again = ~new & ((doc != doc[lead]) | (start != start[lead]))
                kind = np.where(again, REPEAT, np.where(new_gram, FIRST, KNOWN))
                place = start << 10 | count << 3 | several.astype(np.int64) << 2 | kind
                gram, content = (np.where(again, np.uint64(0), x) for x in (gram, content))
                # a row that repeats its document's own region adds nothing
                shown = new | again
                yield pa.record_batch(
                    [as_long(x[shown]) for x in (gram, content, doc, place)],
                    names=["gram", "content", "doc", "place"],
                )

    return documents.select("doc_id", "text").mapInArrow(
        run, "gram long, content long, doc long, place long"
    )


def met_regions(local: DataFrame) -> DataFrame:
    """Repeats, and regions whose gram has several contents; all others hold no repeat.

    One row of a gram and task is grouped by the gram. The rest of a task's rows are spread.
    """
    kind = F.col("place").bitwiseAND(3)
    spread = F.when(kind == FIRST, F.lit(0)).otherwise(F.xxhash64("doc", "place"))
    of_gram = Window.partitionBy("gram", "spread").orderBy("content", "doc", "place")
    every = of_gram.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_content = Window.partitionBy("gram", "spread", "content").orderBy("doc", "place")
    start = F.shiftright("place", 10)
    met = local.withColumn("spread", spread).withColumns(
        {
            "low": F.min("content").over(every),
            "high": F.max("content").over(every),
            "several": F.max(F.col("place").bitwiseAND(4)).over(every),
            "lead": F.first(F.struct("doc", start.alias("start"))).over(of_content),
        }
    )
    repeat = (kind == REPEAT) | (F.struct("doc", start.alias("start")) != F.col("lead"))
    met = met.withColumn("repeat", repeat)
    met = met.filter("repeat or several > 0 or low <> high")
    return met.select(
        "gram", "content", "doc", start.alias("start"),
        F.shiftright("place", 3).bitwiseAND(127).alias("n"), "repeat",
    )


class SuffixFamily:
    """Suffixes, cut to a fixed width, in sorted levels of geometrically growing size."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def repeats(self, suffixes: np.ndarray) -> np.ndarray:
        """Which of a batch, in document order, agree with an earlier suffix; adds the others."""
        order = np.argsort(suffixes, kind="stable")  # the batch's suffix array
        ranked = suffixes[order]
        again = np.zeros(len(ranked), bool)
        again[1:] = ranked[1:] == ranked[:-1]
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, ranked), len(level) - 1)
            again |= level[at] == ranked
        fresh = ranked[~again]
        while len(fresh) and self.levels and len(self.levels[-1]) <= 2 * len(fresh):
            level = self.levels.pop()
            merged = np.concatenate([level, fresh])
            merged.sort(kind="stable")
            fresh = merged
        if len(fresh):
            self.levels.append(fresh)
        out = np.zeros(len(suffixes), bool)
        out[order] = again
        return out


def strings(piece: bytes, n: int, span: int) -> np.ndarray:
    """The `n` strings of `span` bytes that start in `piece`."""
    data = np.frombuffer(piece, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, span)[:n]


def cut_out(documents: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """bucket, doc, start, n, piece, repeat: the bytes of wanted regions, or the
    fingerprints of their strings where the gram is split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "doc", "start", "n", "piece", "repeat"]
        for batch in batches:
            for part in blocks(batch, "text"):
                data, starts = utf8(part.column("text"))
                ids = part.column("doc").to_numpy(zero_copy_only=False)
                parts = part.column("parts")
                row = np.repeat(np.arange(part.num_rows), parts.value_lengths().to_numpy(zero_copy_only=False))
                fields = parts.flatten()
                gram, start, n, split = (fields.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                begin = starts[row] + start
                whole = np.flatnonzero(~split)
                raw = data.tobytes()
                piece = [raw[b : b + k + span - 1] for b, k in zip(begin[whole].tolist(), n[whole].tolist())]
                yield pa.record_batch(
                    [as_long(gram[whole]), as_long(ids[row[whole]]), as_long(start[whole]), as_long(n[whole]),
                     pa.array(piece, pa.binary()), pa.array(np.zeros(len(whole), bool))], names=names,
                )
                hot = np.flatnonzero(split)
                if not len(hot):
                    continue
                step = np.arange(n[hot].sum()) - np.repeat(np.cumsum(n[hot]) - n[hot], n[hot])
                at = np.repeat(begin[hot], n[hot]) + step
                one, two = (SpanHash(data, seed).of(at, at + span) for seed in (1, 2))
                doc = np.repeat(ids[row[hot]], n[hot])
                place = np.repeat(start[hot], n[hot]) + step
                order = np.lexsort((place, doc, two, one))
                one, two, doc, place = one[order], two[order], doc[order], place[order]
                new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
                lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
                again = (doc != doc[lead]) | (place != place[lead])
                shown = new | again
                prints = np.stack([one, two], axis=1)[shown].tobytes()
                size = pa.array(np.arange(shown.sum() + 1, dtype=np.int32) * 16)
                yield pa.record_batch(
                    [as_long(np.where(again, doc.astype(np.uint64), one)[shown]), as_long(doc[shown]),
                     as_long(place[shown]), as_long(np.ones(shown.sum(), np.int64)),
                     pa.Array.from_buffers(pa.binary(), int(shown.sum()), [None, size.buffers()[1], pa.py_buffer(prints)]),
                     pa.array(again[shown])], names=names,
                )

    grouped = wanted.groupBy("doc").agg(
        F.collect_set(F.struct("gram", "start", "n", "split")).alias("parts")
    )
    texts = documents.select(F.coalesce("doc_id", F.lit(int(LAST))).alias("doc"), "text")
    return texts.join(grouped, "doc").select("doc", "text", "parts").mapInArrow(
        run, "bucket long, doc long, start long, n long, piece binary, repeat boolean"
    )


def matched(pieces: DataFrame, span: int, buckets: int) -> DataFrame:
    """doc, start, n: strings that a bucket's family has seen before, in document order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        families = {16: SuffixFamily(), span: SuffixFamily()}
        waiting: dict[int, list] = {16: [], span: []}

        def found(width: int) -> pa.RecordBatch:
            held, waiting[width] = waiting[width], []
            matrix = np.ascontiguousarray(np.concatenate([s for s, _, _ in held]))
            again = families[width].repeats(matrix.view(f"S{width}").ravel())
            size = [len(s) for s, _, _ in held]
            doc = np.repeat([d for _, d, _ in held], size)
            start = np.concatenate([np.arange(p, p + k) for (_, _, p), k in zip(held, size)])
            doc, start = doc[again], start[again]
            edge = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)])) if len(doc) else np.zeros(0, np.int64)
            n = np.diff(np.append(edge, len(doc)))
            return pa.record_batch([as_long(doc[edge]), as_long(start[edge]), as_long(n)], names=["doc", "start", "n"])

        last = None
        total = {16: 0, span: 0}
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(1, 6)]
            for doc, start, n, piece, repeat in zip(*columns):
                if repeat:
                    yield pa.record_batch([[doc], [start], [n]], names=["doc", "start", "n"])
                    continue
                width = 16 if len(piece) == 16 else span
                if (doc, start, n, piece) == last:
                    continue  # rows that repeat a document
                last = (doc, start, n, piece)
                waiting[width].append((strings(piece, n, width), doc, start))
                total[width] += n
                if total[width] >= BATCH:
                    total[width] = 0
                    yield found(width)
        for width, held in waiting.items():
            if held:
                yield found(width)

    dealt = pieces.repartition(buckets, "bucket").sortWithinPartitions("doc", "start", "bucket")
    return dealt.mapInArrow(run, "doc long, start long, n long")


def repeated(documents: DataFrame, span: int = SPAN) -> DataFrame:
    """doc, start, n: every string of `span` bytes that starts earlier, as runs of starts.

    `doc_id` is not null here and tells the texts apart. Runs may overlap in one document.
    """
    spark = documents.sparkSession
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = keep(met_regions(local_regions(documents, span)), "regions")
    several = met.filter("not repeat")
    # regions that tasks knew to share a gram were spread; their equal ones meet here
    leads = several.groupBy("gram", "content").agg(F.min(F.struct("doc", "start")).alias("lead"))
    leads = keep(leads, "leads")
    placed = several.join(leads, ["gram", "content"])
    is_lead = F.struct("doc", "start") == F.col("lead")
    grams = keep(leads.groupBy("gram").agg(F.count("*").alias("contents")).filter("contents > 1"), "grams")
    total = grams.agg(F.sum("contents")).first()[0] or 0
    share = F.lit(max(LEAST_SHARE, total // (2 * slots)))
    wanted = placed.filter(is_lead).join(grams, "gram").select(
        "gram", "doc", "start", "n", (F.col("contents") > share).alias("split")
    )
    wanted = keep(wanted, "wanted")
    strings_in_all = wanted.agg(F.sum("n")).first()[0] or 0
    buckets = max(slots, -(-strings_in_all // BUCKET))
    found = keep(matched(cut_out(documents, wanted, span), span, buckets), "matched")
    return (
        met.filter("repeat").select("doc", "start", "n")
        .unionByName(placed.filter(~is_lead).select("doc", "start", "n"))
        .unionByName(found)
    )


def united(start: np.ndarray, n: np.ndarray, span: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by strings that start in the given runs."""
    begin, end = start, np.minimum(start + n + span - 1, size)
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order]) if len(order) else end
    new = np.concatenate([[True], begin[1:] > reach[:-1]]) if len(begin) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(begin)) - 1
    return begin[first], reach[last] if len(begin) else reach


def with_runs(documents: DataFrame, span: int, name: str) -> DataFrame:
    """The documents with `name`, the packed starts of their repeats or null."""
    key = free_name(documents, f"{name}_doc")
    numbered = with_order(documents, key)
    runs = repeated(numbered.select(F.col(key).alias("doc_id"), "text"), span).groupBy(F.col("doc").alias(key)).agg(
        F.collect_set(F.shiftleft("start", 20).bitwiseOR(F.col("n"))).alias(name)
    )
    return numbered.join(runs, key, "left").select(*documents.columns, name)


def spans_of(data: bytes, packed: np.ndarray | None, span: int) -> list[tuple[int, int]]:
    if packed is None:
        return []
    begin, end = united(packed >> 20, packed & ((1 << 20) - 1), span, len(data))
    return list(zip(begin.tolist(), end.tolist()))


def summaries(documents: DataFrame, span: int = SPAN) -> DataFrame:
    """What is removed of each document, and the digest of its remaining bytes.

    A null text is empty. Rows that repeat a doc_id and its text are one document: they do
    not count as earlier than each other at the same start, and share what is removed. Other
    texts of a repeated id, and rows without an id, which come last, are documents of their
    own. An empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, digests = [], [], [], []
            for text, packed in zip(batch.column(1), batch.column(2)):
                data = (text.as_py() or "").encode()
                cuts = spans_of(data, packed.values.to_numpy() if packed.is_valid else None, span)
                sha, at = hashlib.sha256(), 0
                for begin, end in cuts:
                    sha.update(data[at:begin])
                    at = end
                sha.update(data[at:])
                sizes.append(len(data))
                removed.append(sum(e - b for b, e in cuts))
                spans.append(len(cuts))
                digests.append(sha.hexdigest())
            yield pa.record_batch(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(digests, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    found = with_runs(documents.select("doc_id", "text"), span, "runs")
    return found.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(documents: DataFrame, span: int = SPAN) -> DataFrame:
    """The documents with their repeats cut out of `text`, and `n_chars` set to what is left.

    A character of which only some bytes are repeated stays. Documents of which nothing but
    white space is left are dropped if something was cut from them.
    """
    names = documents.columns
    runs = free_name(documents, "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept = [], []
            for text, packed in zip(batch.column("text"), batch.column(runs)):
                value = text.as_py()
                if value is None or not packed.is_valid:
                    texts.append(value)
                    kept.append(True)
                    continue
                data, parts, at = value.encode(), [], 0
                for begin, end in spans_of(data, packed.values.to_numpy(), span):
                    while begin < end and data[begin] & 0xC0 == 0x80:
                        begin += 1
                    while end < len(data) and end > begin and data[end] & 0xC0 == 0x80:
                        end -= 1
                    parts.append(data[at:begin])
                    at = end
                parts.append(data[at:])
                texts.append(b"".join(parts).decode())
                kept.append(bool(texts[-1].strip()))
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.record_batch(columns, names=names).filter(pa.array(kept))

    out = with_runs(documents, span, runs).mapInArrow(run, documents.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out
