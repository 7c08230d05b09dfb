"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A rotation is three rounds of random signs and a fast Hadamard transform; its hash is the
coordinate of the largest magnitude and that one's sign. `HASHES` of them name a bucket of
a table. Each vector lies in its own bucket of every table and visits those that differ in
the one hash that nearly fell the other way. Whoever shares a bucket with its owner is
compared by cosine in double precision, and a pair counts only where it meets first, so
every pair is counted once without a list of pairs.

Equal vectors are one class with a weight. A bucket of more than `CHUNK` vectors is cut
into chunks, and each two of them are compared in a group of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import keep, mixed
from headway.llm.components import components, labelled

TABLES = 16
HASHES = 3
VISITS = 2
CHUNK = 512
ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows, whose length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x


def of_length_one(vectors: np.ndarray) -> np.ndarray:
    """The rows divided by their norms; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def buckets(vectors: np.ndarray, tables: int = TABLES, hashes: int = HASHES, visits: int = VISITS) -> np.ndarray:
    """Buckets by vector, table and rank: its own first, then the nearest others."""
    n, d = vectors.shape
    width = 1 << max(1, (d - 1).bit_length())
    x = np.zeros((n, width), np.float32)
    x[:, :d] = of_length_one(vectors)
    here = np.arange(n)
    out = np.zeros((n, tables, 1 + visits), np.int64)
    for table in range(tables):
        code = np.zeros((n, hashes), np.int64)
        other = np.zeros((n, hashes), np.int64)
        gap = np.zeros((n, hashes))
        for h in range(hashes):
            y = x
            for r in range(ROUNDS):
                seed = (table * hashes + h) * ROUNDS + r
                bits = mixed(np.arange(width, dtype=np.uint64) + np.uint64(1 + seed * 65_537))
                y = hadamard(y * np.where(bits & np.uint64(1), 1, -1).astype(np.float32)) / np.float32(width**0.5)
            size = np.abs(y)
            best = size.argmax(axis=1)
            top = size[here, best]
            code[:, h] = 2 * best + (y[here, best] < 0)
            size[here, best] = -1
            second = size.argmax(axis=1)
            other[:, h] = 2 * second + (y[here, second] < 0)
            gap[:, h] = top - size[here, second]
        scale = (2 * width) ** np.arange(hashes)
        out[:, table, 0] = code @ scale
        nearest = np.argsort(gap, axis=1)
        for v in range(visits):
            h = nearest[:, v % hashes]
            out[:, table, 1 + v] = out[:, table, 0] + (other[here, h] - code[here, h]) * scale[h]
    return out


def matrix(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64)


def hashed(classes: DataFrame) -> DataFrame:
    """The classes with `codes`, their buckets of all tables in one list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("size").to_numpy(zero_copy_only=False)
            for d in np.unique(size):
                part = batch.filter(pa.array(size == d))
                codes = buckets(matrix(part.column("vector"))).reshape(part.num_rows, -1)
                edge = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * codes.shape[1])
                lists = pa.ListArray.from_arrays(edge, pa.array(codes.ravel()))
                yield pa.record_batch([*part.columns, lists], names=[*part.schema.names, "codes"])

    schema = "label long, size int, id long, weight long, vector array<double>, codes array<long>"
    return classes.select("label", "size", "id", "weight", "vector").mapInArrow(run, schema)


def met_first(a: np.ndarray, b: np.ndarray, table: int, code: np.ndarray) -> np.ndarray:
    """Whether pairs of codes, smaller ids in `a`, meet first in bucket `code` of `table`."""
    to_b = (a[:, :, :1] == b).any(axis=2)  # the owner is a, and b is there
    to_a = (b[:, :, :1] == a).any(axis=2)
    meets = to_b | to_a
    here = np.arange(len(a))
    place = np.where(to_b[:, table], a[here, table, 0], b[here, table, 0])
    return (meets.argmax(axis=1) == table) & meets[:, table] & (place == code)


def compared(dealt: DataFrame, cosine: float) -> DataFrame:
    """Per group: `links`, the weight that each id found, and pairs that span what is linked."""

    def group(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        table, code, i, j = (rows.column(c)[0].as_py() for c in ("table", "code", "i", "j"))
        ids, weight, chunk = (rows.column(c).to_numpy() for c in ("id", "weight", "chunk"))
        owner = rows.column("owner").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, weight, chunk, owner = ids[order], weight[order], chunk[order], owner[order]
        x = of_length_one(matrix(rows.column("vector").combine_chunks())[order])
        codes = matrix(rows.column("codes").combine_chunks())[order].astype(np.int64)
        codes = codes.reshape(len(ids), TABLES, -1)
        near = np.triu(x @ x.T >= cosine, 1)
        near &= owner[:, None] | owner[None, :]
        if i != j:
            near &= chunk[:, None] != chunk[None, :]
        a, b = np.nonzero(near)
        for at in range(0, len(a), 1 << 15):
            p, q = a[at : at + (1 << 15)], b[at : at + (1 << 15)]
            ok = met_first(codes[p], codes[q], table, np.int64(code))
            p, q = p[ok], q[ok]
            found = np.bincount(p, weight[q], len(ids)) + np.bincount(q, weight[p], len(ids))
            some = np.flatnonzero(found)
            more = spanning(len(ids), p, q)
            yield pa.record_batch(
                [pa.array(np.concatenate([ids[some], ids[q[more]]])),
                 pa.array(np.concatenate([ids[some], ids[p[more]]])),
                 pa.array(np.concatenate([found[some], np.zeros(len(more))]).astype(np.int64))],
                names=["a", "b", "links"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "i", "j")], axis=1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for begin, end in zip([0, *edges], [*edges, batch.num_rows]):
                key = tuple(keys[begin])
                if held and key != last:
                    yield from group(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(begin, end - begin))
                last = key
        if held:
            yield from group(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "a long, b long, links long")


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of pairs that connect what all pairs connect: a forest, at most n - 1."""
    root = list(range(n))
    out = []
    left = n
    for at, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        while root[y] != y:
            root[y] = root[root[y]]
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append(at)
            left -= 1
            if left == 1:
                break
    return np.array(out, np.int64)


def link_vectors(embeddings: DataFrame, cosine: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Rows are compared within a label. A vector that is null, empty, zero or holds a null or
    non-finite component, or whose label or id is null, links with nothing and is its own
    component; so do vectors of different length. Rows that repeat an id are vectors of
    their own. An empty table gives no rows; other columns are not read.
    """
    rows = embeddings.select(
        "vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector")
    )
    finite = ~F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda v: v != 0)
    rows = rows.withColumns({
        "usable": F.coalesce(usable, F.lit(False)),
        "h1": F.xxhash64(F.lit(1), "vector"), "h2": F.xxhash64(F.lit(2), "vector"),
    })
    same = ["label", "h1", "h2"]
    classes = rows.filter("usable").groupBy(*same).agg(
        F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.first("vector").alias("vector")
    )
    classes = keep(classes.withColumn("size", F.size("vector")), "vector-classes")
    coded = keep(hashed(classes), "vector-codes")

    slots = coded.select(
        "label", "size", "id",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(TABLES - 1)),
            lambda t: F.slice("codes", t * (1 + VISITS) + 1, 1 + VISITS))).alias("table", "places"),
    )
    slots = slots.select("label", "size", "id", "table", F.posexplode("places").alias("rank", "code"))
    slots = slots.select(
        "id", "table", "code", (F.col("rank") == 0).alias("owner"),
        F.xxhash64("label", "size", "table", "code").alias("bucket"),
    )
    full = slots.groupBy("bucket").agg(
        F.count("*").alias("n"), F.max("owner").alias("owned"), F.min("id").alias("low"), F.max("id").alias("high")
    )
    full = keep(full.filter("owned and low <> high").select("bucket", "n"), "buckets")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    members = slots.join(full, "bucket").withColumn("chunk", F.pmod(F.xxhash64("id"), chunks).cast("int"))
    members = members.join(coded.select("id", "weight", "vector", "codes"), "id")
    # a chunk meets each other one, and itself
    each = F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other")
    dealt = members.select("*", each).select(
        "bucket", "table", "code", "id", "weight", "chunk", "owner", "vector", "codes",
        F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
    )
    dealt = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "id")
    found = keep(compared(dealt, cosine), "vector-links")
    links = found.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    labels = components(found.filter("a <> b"))
    by_class = labelled(classes.select(*same, "id", "weight"), "id", labels, "component").join(links, "id", "left")
    by_class = by_class.select(
        *same, "component", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    by_class = keep(by_class.withColumn("usable", F.lit(True)), "vector-results")
    return rows.drop("vector").join(by_class, [*same, "usable"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"),
    )
