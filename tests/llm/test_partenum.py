from __future__ import annotations

import re
import tracemalloc

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import components as components_module
from headway.llm import partenum
from headway.llm.components import components
from headway.llm.queries import op6_jaccard_join
from tests.llm.conftest import EDGES

SF_DIR = "/root/testdata/sf0.001"


def features(text: str | None, n: int = 4) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def roots(ids: list, links: list) -> dict:
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def brute(rows: list, share: int = 85, n: int = 4) -> list:
    sets = [(i, features(t, n)) for i, t in rows]
    links = [
        (i, j)
        for k, (i, a) in enumerate(sets)
        for j, b in sets[:k]
        if a and b and i is not None and j is not None and 100 * len(a & b) >= share * len(a | b)
    ]
    root = roots([i for i, _ in rows if i is not None], links)
    return sorted(((i, len(s), root.get(i)) for i, s in sets), key=str)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert sorted(map(tuple, op6_jaccard_join(spark, SF_DIR).collect()), key=str) == brute(rows)


def test_edges(spark, edges, documents):
    found = partenum.link_components(edges.withColumnRenamed("n_words", "signature"), 4, 85).collect()
    assert sorted(map(tuple, found), key=str) == brute(EDGES)
    assert partenum.link_components(documents([]), 4, 85).count() == 0


def test_near_copies(spark, documents):
    """Chains of edited texts of many sizes, some just above and some just below the bound."""
    rng = np.random.default_rng(3)
    rows = []
    for size in (3, 5, 8, 13, 22, 40, 90, 200):
        words = [f"w{rng.integers(400)}" for _ in range(size)]
        for _ in range(14):
            rows.append((len(rows) * 7 % 1009, " ".join(words)))
            for _ in range(rng.integers(0, 1 + size // 25 + 1)):
                words[rng.integers(size)] = f"w{rng.integers(400)}"
    found = partenum.link_components(documents(rows), 4, 85).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.sampled_from([60, 80, 85, 95]))
def test_similar_sets_share_a_signature(size, seed, share):
    rng = np.random.default_rng(seed)
    a = rng.choice(1 << 62, size, replace=False).astype(np.uint64)
    drop = rng.integers(0, size * (100 - share) // 100 + 1)
    b = a[drop:]
    more = rng.choice(1 << 62, max(0, len(b) * 100 // share - size), replace=False).astype(np.uint64)
    b = np.unique(np.concatenate([b, more]))
    common, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
    if 100 * common < share * union or not len(b):
        return
    for n2, k2 in ((2, 1), (3, 1), (3, 2), (1, 0)):
        code = np.concatenate([np.sort(a), np.sort(b)])
        row = np.repeat([0, 1], [len(a), len(b)])
        owner, found = partenum.signatures(row, code, 2, share, n2, k2)
        assert set(found[owner == 0].tolist()) & set(found[owner == 1].tolist())


def test_components(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 120, (70, 2))] + [(200 + i, 201 + i) for i in range(40)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = roots(sorted({i for x in links for i in x}), links)
    assert found == {i: c for i, c in wanted.items() if i != c}


def test_asked_of_smaller_partners():
    """What a set is asked for is no more than any pair of it is sure to share."""
    for share in (50, 80, 85, 95):
        size = np.arange(1, 400)
        own, asks = partenum.asked(size, share)
        for s in size:
            partner = np.arange(-(-s * share // 100), min(399, s * 100 // share) + 1)
            differ = np.minimum(own[s - 1], own[partner - 1])
            sure = np.maximum(1, differ + 1 - (s + partner) * (100 - share) // (100 + share))
            assert asks[s - 1] <= sure.min()
    assert partenum.asked(np.array([28, 30]), 85)[1][1] == 2


def test_sketches_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 1 << 62, 300).astype(np.uint64))
    for gone in (0, 1, 20, 290):
        b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 62, gone).astype(np.uint64)]))
        edge = np.array([0, len(a), len(a) + len(b), len(a) + len(b)])
        found = np.array(partenum.sketches(np.concatenate([a, b]), edge)).view(np.uint64)
        bits = np.bitwise_count(found[:, 0] ^ found[:, 1]).sum()
        assert bits <= len(np.setxor1d(a, b)) and (bits > gone or gone in (0, 290)) and not found[:, 2].any()


def test_large_group_below_the_bound(spark, documents, monkeypatch):
    """Members of one group that share signatures and mostly no link are few rows, and no link is lost."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(8 if i % 20 else 4):
            words[rng.integers(150)] = f"w{rng.integers(150, 170)}"
        rows.append((i, " ".join(words)))
    counts, meeting = [], partenum.meeting

    def seen(members, sizes, share):
        found = meeting(members, sizes, share)
        each = members.groupBy("signature").count()
        counts.append((found.count(), each.selectExpr("sum(count * (count - 1) / 2)").first()[0]))
        return found

    monkeypatch.setattr(partenum, "meeting", seen)
    found = partenum.link_components(documents(rows), 4, 85).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)
    (made, pairs) = counts[0]
    assert pairs > 10_000 and made < pairs / 20


def test_texts_of_no_pair_stay_out_of_the_comparison(spark, documents, monkeypatch):
    rows = [(i, " ".join(f"w{i // 2 * 100 + j}" for j in range(40 + i % 2))) for i in range(400)]
    counts, sifted = [], partenum.sifted

    def seen(df, kept, columns):
        found = sifted(df, kept, columns)
        counts.append((df.count(), found.count()))
        return found

    monkeypatch.setattr(partenum, "sifted", seen)
    pairs = spark.createDataFrame([(1, 0), (7, 6), (9, 6)], "a long, b long")
    found = partenum.compared(documents(rows), pairs, 4, 85).collect()
    assert sorted(map(tuple, found)) == [(1, 0), (7, 6)]
    assert len(counts) == 2 and all(n == 400 and passed < 10 for n, passed in counts)


def test_members_kept_are_all_viable_ones_and_few_others(spark):
    members = spark.range(4_000).selectExpr("id % 7 AS signature", "id div 4 AS id")
    sizes = spark.range(1_000).selectExpr("id AS doc_id", "IF(id % 10 = 0, 4L, 5L) AS asks")
    ids = partenum.viable(members, sizes).groupBy("id").count().collect()
    assert {r.id for r in ids} >= set(range(0, 1_000, 10)) and len(ids) < 110 and all(r["count"] == 4 for r in ids)


def test_shingles_of_a_block_take_little_memory():
    rng = np.random.default_rng(4)
    sizes = rng.integers(0, 5_000, 800)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    data = rng.choice(np.frombuffer(b"abcdefgh \n", np.uint8), starts[-1])
    tracemalloc.start()
    found = partenum.shingles(data, starts, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15 * len(data)
    whole = partenum.slice_shingles(data, starts, 5)
    assert len(whole[0]) > 10_000 and all(np.array_equal(a, b) for a, b in zip(found, whole))


def test_small_rounds_are_few_files(spark, monkeypatch):
    """A table of a round has as many files as its rows need, whatever the number of partitions."""
    kept, files = components_module.keep, []

    def seen(df, name, *most):
        found = kept(df, name, *most)
        files.append((name, len(found.inputFiles())))
        return found

    monkeypatch.setattr(components_module, "keep", seen)
    names = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        edges = spark.range(2_000).selectExpr("id AS a", "id + IF(id % 100 = 99, 0, 1) AS b")
        found = {r.id: r.component for r in components(edges).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == {i: i - i % 100 for i in range(2_000) if i % 100}
    assert len(files) > 5 and max(n for _, n in files[1:]) == 1
