from __future__ import annotations

import hashlib
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import suffixes
from headway.llm.ordering import with_order
from headway.llm.queries import op4_suffix_dedup
from tests.llm.conftest import EDGES, LONG

SF_DIR = "/root/testdata/sf0.001"


def brute(rows: list, span: int = 100) -> list:
    """Every string in a dictionary, documents in order of their ids."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    first: dict[bytes, tuple] = {}
    out = []
    for k in order:
        doc, text = rows[k]
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - span + 1):
            if first.setdefault(data[p : p + span], (doc, p)) != (doc, p):
                gone[p : p + span] = True
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(data) else 0
        left = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def found(df) -> list:
    return sorted(map(tuple, df.collect()), key=str)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert found(op4_suffix_dedup(spark, SF_DIR)) == brute(rows)


def test_edges(edges, documents):
    renamed = edges.withColumnRenamed("n_words", "runs")
    assert found(suffixes.summaries(renamed)) == brute(EDGES)
    assert suffixes.summaries(documents([])).count() == 0
    kept = suffixes.without_repeats(renamed)
    assert kept.columns == renamed.columns
    texts = {r.doc_id: r for r in kept.collect()}
    assert len(texts[7].text) < len(LONG) / 100 and texts[7].n_chars == len(texts[7].text)
    assert texts[1].text is None and texts[8].text == dict(EDGES)[8]


@pytest.mark.parametrize("slots", ["1", "4"])
def test_hot_and_partial_repeats(spark, documents, slots):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdé"), 6))
    line = " ".join(word() for _ in range(11))
    long_line = " ".join(word() for _ in range(40))
    rows = []
    for i in range(260):
        parts = [" ".join(word() for _ in range(rng.integers(1, 40))) for _ in range(3)]
        parts.insert(rng.integers(0, 4), line)
        if i % 3 == 0:
            cut = rng.integers(0, 120)
            parts.insert(rng.integers(0, 4), long_line[cut : cut + rng.integers(90, 200)])
        if i % 7 == 0:
            parts.append("ab" * rng.integers(40, 140))
        rows.append((int(rng.permutation(1000)[0]) * 1000 + i, " ".join(parts)))
    rows += [(10**7 + i, rows[5][1]) for i in range(20)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", slots)
    try:
        assert found(suffixes.summaries(documents(rows).repartition(5))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_split_grams(documents, monkeypatch):
    monkeypatch.setattr(suffixes, "LEAST_SHARE", 2)
    rng = np.random.default_rng(6)
    line = " ".join("".join(rng.choice(list("abc"), 5)) for _ in range(19))
    rows = [(i, f"{rng.integers(10**9)} {line} {rng.integers(10**9)}") for i in range(60)]
    assert found(suffixes.summaries(documents(rows).repartition(3))) == brute(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"aa", b"ab", b"ba", b"bb"]), max_size=30), max_size=20))
def test_family(batches):
    family, seen = suffixes.SuffixFamily(), set()
    for batch in batches:
        wanted = []
        for s in batch:
            wanted.append(s in seen)
            seen.add(s)
        assert family.repeats(np.array(batch, "S2")).tolist() == wanted
        sizes = [len(level) for level in family.levels]
        assert all(a > b for a, b in zip(sizes, sizes[1:]))
        assert sorted(s for level in family.levels for s in level.tolist()) == sorted(seen)


def test_repeated_ids_of_other_texts_and_several_without_one(documents):
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    a, b = word(400), word(900)
    sets = [
        [(1, a), (2, "x" + a), (2, "short")],
        [(1, a), (None, a[:300]), (None, "tiny")],
        [(1, a), (None, "x" + a[:200]), (None, b)],
        [(3, a), (3, a), (3, b + a), (None, b), (None, None), (None, ""), (4, a + b)],
    ]
    for rows in sets:
        df = documents(rows)
        # each distinct pair of id and text is a document, in the order of its number
        numbered = {(r.doc_id, r.text): r.place for r in with_order(df, "place").collect()}
        keys = {place: (i, n) for n, ((i, _), place) in enumerate(sorted(numbered.items(), key=lambda x: x[1]))}
        expected = brute([(numbered[r], r[1]) for r in rows])
        expected = sorted([(keys[e[0]][0], *e[1:]) for e in expected], key=str)
        assert found(suffixes.summaries(df)) == expected
        kept = suffixes.without_repeats(df).collect()
        assert b in {r.text for r in kept} or b not in {r[1] for r in rows}


def test_regions_of_a_block_take_little_memory():
    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 5_000, 800)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    data = rng.integers(97, 123, starts[-1]).astype(np.uint8)
    tracemalloc.start()
    found = suffixes.regions(data, starts, suffixes.SPAN)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * len(data)
    whole = suffixes.slice_regions(data, starts, suffixes.SPAN)
    assert len(whole[0]) > 10_000 and all(np.array_equal(a, b) for a, b in zip(found, whole))
