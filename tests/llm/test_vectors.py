from __future__ import annotations

import numpy as np

from headway.llm import vectors
from headway.llm.queries import op3_embedding_dedup
from tests.llm.test_partenum import roots

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows: list, cosine: float = 0.98) -> list:
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not np.any(np.float32(v)):
            return None
        x = np.array(v, np.float32).astype(float)
        return x / np.linalg.norm(x)

    units = [unit(v) for _, v, _ in rows]
    counts, links = [0] * len(rows), []
    for i, (a, _, la) in enumerate(rows):
        for j, (b, _, lb) in enumerate(rows[:i]):
            x, y = units[i], units[j]
            if None in (a, b, la, lb) or la != lb or x is None or y is None or len(x) != len(y):
                continue
            if x @ y >= cosine:
                counts[i] += 1
                counts[j] += 1
                links.append((a, b))
    root = roots([i for i, _, _ in rows if i is not None], links)
    return sorted(((i, n, root.get(i), i is not None and root[i] == i or None) for (i, _, _), n in zip(rows, counts)), key=str)


def found(df) -> list:
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept or None) for r in df.collect()), key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert found(op3_embedding_dedup(spark, SF_DIR)) == brute(rows)


def test_clusters(spark, monkeypatch):
    """Copies, near copies on both sides of the bound, a bucket of several chunks, odd vectors."""
    rng = np.random.default_rng(4)
    rows = []
    for label, members, noise in ((1, 60, 0.07), (1, 60, 0.1), (2, 40, 0.12), (3, 6, 0.01)):
        centre = rng.normal(size=48)
        centre /= np.linalg.norm(centre)
        for _ in range(members):
            v = centre + rng.normal(size=48) * noise / 48**0.5
            rows.append((len(rows), [float(np.float32(x)) for x in v], label))
    rows += [(len(rows) + k, rows[k % 3][1], rows[k % 3][2]) for k in range(20)]
    odd = [None, [], [0.0] * 48, [None] + [1.0] * 47, [float("nan")] * 48, [float("inf")] * 48, [1.0] * 48, [1.0] * 20]
    rows += [(1000 + k, v, 3) for k, v in enumerate(odd)]
    rows += [(2000, rows[0][1], None), (None, rows[0][1], 1), (2001, [2.0] * 48, 3)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as bucket")
    monkeypatch.setattr(vectors, "CHUNK", 16)
    wanted = brute(rows)
    got = found(vectors.link_vectors(df))
    assert got == wanted
    assert vectors.link_vectors(df.limit(0)).count() == 0


def test_recall_of_buckets():
    """Pairs just at the bound share a visited bucket nearly always."""
    rng = np.random.default_rng(8)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.98 * a + (1 - 0.98**2) ** 0.5 * side
    x, y = vectors.buckets(a), vectors.buckets(b)
    met = ((x[:, :, :1] == y).any(axis=2) | (y[:, :, :1] == x).any(axis=2)).any(axis=1)
    assert met.mean() >= 0.99
    assert np.allclose(vectors.hadamard(np.eye(4)), [[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]])


def test_magnitudes(spark):
    """Finite vectors whose squares overflow or vanish are judged like any other."""
    rows = [(1, [1e200, 0.0], 1), (2, [1e200, 1e190], 1), (3, [1e-200, 0.0], 1), (4, [1.0, 0.0], 1), (5, [0.0, 1e-200], 1),
            (6, [1e-200, 1e-200], 1), (7, [1e300, 1e300], 1), (8, [5e-324, 0.0], 1), (9, [-1e308, 0.0], 1)]
    got = {r[0]: r[1:3] for r in found(vectors.link_vectors(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))))}
    assert got == {**{i: (4, 1) for i in (1, 2, 3, 4, 8)}, 5: (0, 5), 6: (1, 6), 7: (1, 6), 9: (0, 9)}
