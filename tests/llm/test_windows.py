from __future__ import annotations

import hashlib
import random
import re

import pytest

from headway.llm import windows
from headway.llm.common import table
from headway.llm.ordering import with_order
from headway.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plainly(documents, size=20):
    """What is left of every document, from a set of all windows seen before."""
    rows = with_order(documents.select("doc_id", "text"), "place").collect()
    seen, left = set(), {}
    for place, text in sorted({(r.place, r.text) for r in rows}, key=lambda r: r[0]):
        w = words(text)
        lost = [False] * len(w)
        for i in range(len(w) - size + 1):
            window = tuple(w[i : i + size])
            if window in seen:
                lost[i : i + size] = [True] * size
            seen.add(window)
        left[place] = [x for x, gone in zip(w, lost) if not gone]
    return [(r.doc_id, len(words(r.text)), left[r.place]) for r in rows]


def check(documents, size=20, found=None):
    found = windows.summaries(documents, size) if found is None else found
    expected = [
        (i, n, n - len(left), hashlib.sha256(" ".join(left).encode()).hexdigest()) for i, n, left in plainly(documents, size)
    ]
    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.collect()), key=order) == sorted(expected, key=order)


def test_whole_table(spark):
    check(table(spark, TABLES, "documents"), found=QUERIES["op13_substring_dedup"](spark, TABLES))


def test_edges(edges, documents):
    check(edges)
    assert windows.summaries(edges.limit(0)).count() == 0
    passage = " ".join(f"w{i}" for i in range(40))
    check(documents([
        (3, passage), (3, "new " + passage), (3, "new " + passage), (3, "short"), (None, passage[:150]), (None, None),
        (None, "tiny"), (None, " ".join(f"u{i}" for i in range(300))), (1, "\x0b\x1c".join(passage.split(" ")) + " " + passage),
        (2, passage + "\n\t" + passage.replace(" ", " \r\n ")), (-5, " ".join(f"w{i}" for i in range(19))), (9, "same " * 45),
        (10, "same " * 44 + "end"), (11, ("a b " * 30).strip()), (12, "b " + "a b " * 15),
    ]))


def test_ends_of_a_text(documents):
    """A word that ends one text does not run into the first of the next."""
    rows = [(i, " ".join(f"x{j}" for j in range(i % 3, 24))) for i in range(30)]
    check(documents(rows))


@pytest.mark.parametrize("seed", range(4))
def test_few_distinct_words(documents, seed):
    """Repeats within texts and across them, at their ends, close to each other."""
    rng = random.Random(seed)
    vocabulary = ["a", "b", "ab", "é"][: 2 + seed % 3]
    shared = [" ".join(rng.choices(vocabulary, k=rng.randint(3, 60))) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choices(vocabulary, k=rng.randint(1, 30)))
                 for _ in range(rng.randint(0, 6))]
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    check(documents(rows), 8)
    check(documents(rows), 20)


def test_hot_passage_with_different_surroundings(documents):
    """A passage that every document has, between words of its own, and a group of copies."""
    passage = " ".join(f"p{i}" for i in range(23))
    rows = [(i, f"{' '.join(f'l{i}.{j}' for j in range(30))} {passage} {' '.join(f'r{i}.{j}' for j in range(30))}")
            for i in range(300)]
    rows += [(1000 + i, " ".join(f"c{j}" for j in range(90)) + f" {i % 7}") for i in range(200)]
    check(documents(rows))


def test_text_in_several_segments(documents, monkeypatch):
    monkeypatch.setattr(windows, "SEGMENT", 100)
    text = " ".join(f"word{i % 37}" for i in range(900)) + " " + "long" * 300 + " end"
    check(documents([(1, text), (2, "x" + text), (3, "y" * 1000), (4, text[500:4000])]))


def test_without_repeats(documents):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = documents([(1, passage, "en"), (2, f"before\n{passage} after it", "fr"), (3, None), (4, " as \n it is ")], "1 as order")
    out = windows.without_repeats(rows)
    assert out.columns == rows.columns
    found = {r.doc_id: (r.text, r.n_chars, r.lang) for r in out.collect()}
    assert found == {1: (passage, len(passage), "en"), 2: ("before after it", 15, "fr"), 3: (None, None, None), 4: (" as \n it is ", 12, None)}


def test_size_must_double_twice(documents):
    with pytest.raises(ValueError, match="multiple of four"):
        windows.summaries(documents([(1, "a")]), 18)
