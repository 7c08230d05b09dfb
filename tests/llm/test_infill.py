from __future__ import annotations

import hashlib
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from headway.llm import infill
from headway.llm.common import table
from headway.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"


def plainly(doc_id, text, rate=100, spm=50):
    """form, prefix and middle lengths and the output by slicing the whole text."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexed = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[i * 8 : i * 8 + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, len(units))))
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def check(rows, documents):
    expected = []
    for r in documents.select("doc_id", "text").collect():
        n, form, prefix, middle, output = plainly(r.doc_id, r.text)
        expected.append((r.doc_id, n, form, prefix, middle, sha(output), sha(r.text)))
    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, rows), key=order) == sorted(expected, key=order)


def test_whole_table(spark):
    check(QUERIES["op12_fill_in_middle"](spark, TABLES).collect(), table(spark, TABLES, "documents"))


def test_edges(edges, documents):
    check(infill.summaries(edges).collect(), edges)
    more = documents(
        [(20, "has <M> in it\nx"), (21, "\n"), (22, "\n\n\n"), (23, "a\nb"), (24, "a\nb\n"), (24, "other\n" * 9),
         (25, "\r\n x\x0b\n"), (26, "< P >\n<p>\n"), (None, "one\n\ntwo"), (27, "<\nP>\n")]
    )
    check(infill.summaries(more).collect(), more)
    assert infill.summaries(edges.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_frames_of_any_size_give_the_same(documents, size):
    rows = documents([(i, "".join(f"é{j} {'x' * (j % 9)}\n" for j in range(i)) + "end" * (i % 2)) for i in range(60)])
    made = infill.fill_in_middle(infill.store_frames(rows, size))
    check(infill.digests(made).collect(), rows)
    expected = {r.doc_id: plainly(r.doc_id, r.text)[4] for r in rows.collect()}
    assert {r.doc_id: r.output for r in infill.texts(made).collect()} == expected


def test_frames_are_seekable_and_join_to_one_stream(documents):
    text = "".join(f"line {i} ñ\n" for i in range(1000))
    stored = infill.store_frames(documents([(1, text)]), 512).first()
    opener = zstandard.ZstdDecompressor()
    assert len(stored.frames) > 5
    units = 0
    for frame in stored.frames:
        piece = opener.decompress(frame.data).decode()
        assert frame.first_unit == units and text[frame.first_char :].startswith(piece)
        units += piece.count("\n")
    made = infill.fill_in_middle(infill.store_frames(documents([(1, text)]), 512)).first()
    joined = zstandard.ZstdDecompressor().stream_reader(b"".join(made.output), read_across_frames=True).read()
    assert joined.decode() == plainly(1, text)[4]
    # all but the frames at the two cuts are the stored ones
    kept = {f.data for f in stored.frames}
    assert sum(bytes(f) not in kept for f in made.output) <= 3 + 4


def test_rate_and_share(documents):
    rows = documents([(i, "a\nb\nc\n") for i in range(400)])
    made = infill.fill_in_middle(infill.store_frames(rows), rate=30, spm_share=0)
    forms = {r.form: r["count"] for r in made.groupBy("form").count().collect()}
    expected = [plainly(i, "a\nb\nc\n", 30, 0)[1] for i in range(400)]
    assert forms == {"plain": expected.count("plain"), "psm": expected.count("psm")}
    assert made.filter(F.col("form") == "spm").isEmpty()
