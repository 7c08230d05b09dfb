"""Ranked lexical search by the Best Position Algorithm over impact lists.

Documents are dealt into shards. In a shard every term of the queries has an impact list: its
postings, highest contribution to a score first. A query reads its lists in parallel from the
top. Each document met is scored at once by direct accesses to its postings in the other
lists, and these accesses count as seen, too. The best position of a list is the last one
before the first that has not been seen. No document unseen so far scores above the sum of
the contributions at the best positions, so a query stops once that sum lies strictly below
its k-th score: an equal one could still bring a smaller doc_id.

Queries are worked off in blocks of bounded size. A task carries the best k of its shards
from one to the next and gives only those on, so the last ranking sees k rows per query and
task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.common import blocks, keep, utf8

TOP = 20
BLOCK_BYTES = 8 << 20  # of query text in a block, on average
SHARD_POSTINGS = 2_000_000
STEP = 32  # places of each list that the first round reads; every round doubles it
CHUNK = 1 << 20  # bytes of a text that are cut into terms at a time

# Ranges of ASCII characters that part terms, [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+
PARTING = ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
FOLDED = bytes(
    32 if any(low <= b <= high for low, high in PARTING) else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of bounded size."""
    folded, at = text.translate(FOLDED), 0
    while at < len(folded):
        end = folded.find(b" ", at + CHUNK)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def counted(text: bytes) -> tuple[int, Counter]:
    n, found = 0, Counter()
    for terms in terms_of(text):
        n += len(terms)
        found.update(terms)
    return n, found


def postings(documents: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """doc_id, n, and the numbers and counts of the given terms, per document with any term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                data, starts = utf8(part.column("text"))
                raw, starts = data.tobytes(), starts.tolist()
                sizes, numbers, counts, ends = [], [], [], [0]
                for begin, end in zip(starts[:-1], starts[1:]):
                    n, found = counted(raw[begin:end])
                    for term in found.keys() & terms.keys():
                        numbers.append(terms[term])
                        counts.append(found[term])
                    sizes.append(n)
                    ends.append(len(numbers))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (numbers, counts)]
                sizes = pa.array(sizes, pa.int64())
                rows = pa.record_batch([part.column("doc_id"), sizes, *lists], names=["doc_id", "n", "terms", "counts"])
                yield rows.filter(pa.array(sizes.to_numpy() > 0))

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


class Shard:
    """Impact lists of some documents, and where each document stands in them."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray,
                 weights: np.ndarray, documents: int, length: int):
        doc = np.repeat(np.arange(len(n)), sizes)
        m = 100 - 25 + (25 * n * documents) // length
        impact = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 12 * m[doc]))
        order = np.lexsort((-impact, terms))
        self.doc, self.term, self.impact = doc[order], terms[order], impact[order]
        edges = np.arange(len(weights) + 1)
        self.begin = np.searchsorted(self.term, edges)
        # places in the lists by document, for direct accesses
        self.places = np.argsort(self.doc, kind="stable")
        self.opens = np.searchsorted(self.doc[self.places], np.arange(len(n) + 1))
        self.n_documents = len(n)

    def places_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every place of the given documents in the lists, and which of them it belongs to."""
        sizes = self.opens[docs + 1] - self.opens[docs]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.opens[docs] - ends + sizes, sizes)
        return self.places[at], np.repeat(np.arange(len(docs)), sizes)

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores that may be among the best k, given `known` scores of others."""
        begin, end = self.begin[terms], self.begin[terms + 1]
        filled = np.flatnonzero(end > begin)
        # a list whose top adds nothing adds nothing anywhere
        filled = filled[self.impact[begin[filled]] > 0]
        terms, times, begin, end = terms[filled], times[filled], begin[filled], end[filled]
        weight = np.zeros(len(self.begin), np.int64)
        weight[terms] = times
        seen, met = np.zeros(len(self.doc), bool), np.zeros(self.n_documents, bool)
        read, position, step = begin.copy(), begin.copy(), STEP
        docs, scores, top = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], known
        while (read < end).any():
            stop = np.minimum(read + step, end)
            new = np.unique(np.concatenate([self.doc[a:b] for a, b in zip(read, stop)]))
            new = new[~met[new]]
            met[new] = True
            read, step = stop, step * 2
            place, owner = self.places_of(new)
            used = weight[self.term[place]] > 0
            place, owner = place[used], owner[used]
            seen[place] = True
            score = np.zeros(len(new), np.int64)
            np.add.at(score, owner, self.impact[place] * weight[self.term[place]])
            docs.append(new)
            scores.append(score)
            top = np.concatenate([top, score])
            if len(top) > k:
                top = np.partition(top, len(top) - k)[len(top) - k :]
            bound = 0
            for i in range(len(terms)):
                # all that was read is seen; direct accesses may have seen what follows
                at = max(position[i], read[i])
                while at < end[i]:
                    unseen = np.flatnonzero(~seen[at : min(at + 1024, end[i])])
                    at += int(unseen[0]) if len(unseen) else min(1024, end[i] - at)
                    if len(unseen):
                        break
                position[i] = at
                if at < end[i]:
                    bound += int(times[i]) * int(self.impact[at - 1])
            if len(top) == k and bound < top.min():
                break
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        good = scores >= max(1, int(top.min()) if len(top) == k else 1)
        return docs[good], scores[good]


class Best:
    """The best k of a query so far: score, doc_id and whether that is missing."""

    def __init__(self) -> None:
        self.score, self.id, self.missing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, missing: np.ndarray, k: int) -> None:
        score, ids, missing = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.missing, missing)))
        order = np.lexsort((ids, missing, -score))[:k]
        self.score, self.id, self.missing = score[order], ids[order], missing[order]


def task_best(
    found: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray,
    documents: int, length: int, k: int, shard_postings: int,
) -> DataFrame:
    """item_id, doc_id and score: the best k documents of each task for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best() for _ in items]
        held: list[pa.RecordBatch] = []

        def work() -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            ids = rows["doc_id"].combine_chunks()
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            lists = [rows[c].combine_chunks() for c in ("terms", "counts")]
            sizes = lists[0].value_lengths().to_numpy(zero_copy_only=False)
            numbers, counts = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
            shard = Shard(rows["n"].to_numpy(), sizes, numbers, counts, weights, documents, length)
            for (_, terms, times), own in zip(items, best):
                docs, scores = shard.best(terms, times, k, own.score)
                own.add(scores, ids[docs], missing[docs], k)

        size = 0
        for batch in batches:
            at = 0
            ends = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
            while at < batch.num_rows:
                # whole documents until the shard is full
                room = shard_postings - size + (int(ends[at - 1]) if at else 0)
                to = max(int(np.searchsorted(ends, room, "right")), at if held else at + 1)
                if to > at:
                    held.append(batch.slice(at, to - at))
                    size += int(ends[to - 1]) - (int(ends[at - 1]) if at else 0)
                    at = to
                if at < batch.num_rows:
                    work()
                    size = 0
        if held:
            work()
        for (item, _, _), own in zip(items, best):
            if len(own.score):
                columns = [
                    pa.array([item] * len(own.score), pa.int64()), pa.array(own.id, mask=own.missing), pa.array(own.score),
                ]
                yield pa.record_batch(columns, names=["item_id", "doc_id", "score"])

    return found.mapInArrow(run, "item_id long, doc_id long, score long")


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """The queries, in blocks of about `block_bytes` of text that the driver can hold."""
    own = items.groupBy("item_id").agg(F.min("text").alias("text")).filter("text is not null")
    own = keep(own, "items")
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for block in range(n):
        rows = own.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == block) if n > 1 else own
        yield [(r.item_id, r.text) for r in rows.collect()]


def search(
    documents: DataFrame, items: DataFrame, k: int = TOP,
    block_bytes: int = BLOCK_BYTES, shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """item_id, rank, doc_id and score of the best k documents for each item, exactly.

    Every row of `documents` is a document of its own, also where it repeats another; a null
    text has no terms. Documents without an id come last among equal scores. Items that
    share an id are one, with the smallest of their texts; an item without terms, or whose
    terms are in no document, gives no rows, as does an empty table on either side. Other
    columns are not read.
    """
    spark = documents.sparkSession
    out = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for block in item_blocks(items.select("item_id", "text"), block_bytes):
        asked = [(item, counted(text.encode())[1]) for item, text in block]
        terms = {term: i for i, term in enumerate(sorted(set().union(*(found for _, found in asked))))}
        found = keep(postings(documents, terms), "postings")
        documents_n, length = found.agg(F.count("*"), F.sum("n")).first()
        if not documents_n:
            continue
        # one row per term of this block
        holders = found.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(terms), np.int64)
        for term, df in holders:
            weights[term] = math.floor(1000 * math.log((2 * documents_n + 2) / (2 * df + 1)))
        queries = [
            (item, np.array([terms[t] for t in own], np.int64), np.array(list(own.values()), np.int64)) for item, own in asked
        ]
        best = task_best(found, queries, weights, documents_n, length, k, shard_postings)
        out = out.unionByName(best)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
