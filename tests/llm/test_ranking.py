from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from headway.llm import ranking
from headway.llm.common import table
from headway.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return PATTERN.findall((text or "").translate(FOLD))


def plainly(documents, items, k=20):
    """Every document scored for every item."""
    rows = [(r.doc_id, terms(r.text)) for r in documents.select("doc_id", "text").collect()]
    rows = [(i, t, Counter(t)) for i, t in rows if t]
    total, length = len(rows), sum(len(t) for _, t, _ in rows)
    df = Counter(term for _, _, found in rows for term in found)
    texts = {}
    for r in items.select("item_id", "text").collect():
        if r.text is not None:
            texts[r.item_id] = min(texts.get(r.item_id, r.text), r.text)
    out = []
    for item, text in texts.items():
        scored = []
        for doc, own, found in rows:
            m, score = 75 + 25 * len(own) * total // length, 0
            for term, times in Counter(terms(text)).items():
                if tf := found.get(term, 0):
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[term] + 1)))
                    score += times * w * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return out


def check(documents, items, k=20, **how):
    found = [tuple(r) for r in ranking.search(documents, items, k, **how).collect()]
    order = lambda r: tuple(map(str, r))
    assert sorted(found, key=order) == sorted(plainly(documents, items, k), key=order)


@pytest.fixture(scope="module")
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def test_whole_tables(spark):
    found = QUERIES["op11_lexical_search"](spark, TABLES)
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    expected = plainly(table(spark, TABLES, "documents"), table(spark, TABLES, "benchmark"))
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_edges(edges, items, documents):
    asked = items([
        (1, "same TEXT word"), (1, "zz"), (2, None), (3, " .,- "), (4, "é 漢字 ß word"), (5, "absent"), (None, "few, few; few words"),
        (6, "q\x00id"),
    ])
    check(edges, asked)
    check(edges, asked, 2)
    assert ranking.search(edges.limit(0), asked).count() == 0
    assert ranking.search(edges, asked.limit(0)).count() == 0
    # no term is rarer than in all documents, and those weigh nothing among many
    check(documents([(i, "all the same") for i in range(1200)] + [(None, "all the same but one")] * 2), items([(1, "all but")]))


@pytest.mark.parametrize("seed", range(3))
def test_shards_blocks_and_ties(documents, items, seed):
    """Small shards and blocks, many equal scores, copies of one text, and few or many terms."""
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 40))) for _ in range(150)]
    rows = documents([(rng.randint(-50, 900), rng.choice(texts)) for _ in range(700)] + [(None, texts[3])] * 4)
    asked = items([(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 25)))) for i in range(25)])
    check(rows, asked, 5, shard_postings=400)
    check(rows, asked, 20, block_bytes=300)
    check(rows, asked, 1, shard_postings=1)


def test_stops_before_the_ends_of_the_lists(monkeypatch):
    """Rare matches on top: most of a long list of weak ones is never read."""
    n = 20_000
    sizes = np.full(n, 2)
    numbers = np.tile([0, 1], n)
    numbers[1::2] = np.where(np.arange(n) < 50, 1, 2)
    counts = np.ones(2 * n, np.int64)
    counts[::2] = np.arange(n) % 7 + 1
    weights = np.array([10, 9000, 0])
    shard = ranking.Shard(np.full(n, 10), sizes, numbers, counts, weights, n, 10 * n)
    met = []
    places_of = shard.places_of
    monkeypatch.setattr(shard, "places_of", lambda docs: met.append(len(docs)) or places_of(docs))
    docs, scores = shard.best(np.array([0, 1]), np.array([1, 1]), 20, np.zeros(0, np.int64))
    impact = weights[numbers] * ((10**9 * counts) // (1000 * counts + 1200))
    everything = impact.reshape(n, 2).sum(axis=1)
    best = np.lexsort((np.arange(n), -everything))[:20]
    assert sorted(docs[np.lexsort((docs, -scores))[:20]]) == sorted(best)
    assert sum(met) < n / 10


def test_direct_accesses_move_the_best_position():
    """Lists in opposite order: what one reads lies at the end of the other, and is seen there."""
    n = 64
    counts = np.stack([np.arange(n) + 1, n - np.arange(n)], axis=1).ravel()
    shard = ranking.Shard(np.full(n, 10), np.full(n, 2), np.tile([0, 1], n), counts, np.array([5, 5]), n, 10 * n)
    docs, scores = shard.best(np.array([0, 1]), np.array([1, 1]), 3, np.zeros(0, np.int64))
    impact = (5 * ((10**9 * counts) // (1000 * counts + 1200))).reshape(n, 2).sum(axis=1)
    assert sorted(scores)[-3:] == sorted(impact)[-3:]


def test_terms_of_a_long_text(monkeypatch):
    text = "Abc dé-f 12_x " * 500
    monkeypatch.setattr(ranking, "CHUNK", 64)
    n, found = ranking.counted(text.encode())
    assert n == len(terms(text)) and found == Counter(t.encode() for t in terms(text))
