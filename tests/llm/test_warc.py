from __future__ import annotations

import base64
import hashlib

import pytest

from headway.llm import warc
from headway.llm.queries import op8_warc

SF_DIR = "/root/testdata/sf0.001"


def expected(pages: list) -> list:
    last = {}
    for page_id, html in pages:
        last[html or ""] = max(page_id, last.get(html or "", page_id))
    out = []
    for page_id, html in pages:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = last[html or ""]
        out.append((page_id, len(payload), digest, "response" if first == page_id else "revisit", None if first == page_id else first))
    return sorted(out, key=str)


def test_query(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    assert sorted(map(tuple, op8_warc(spark, SF_DIR).collect()), key=str) == expected(pages)


def test_edges(spark):
    pages = [(1, None), (2, ""), (3, "é <p>"), (4, "x" * 400_000), (5, "x" * 400_000), (5, "x" * 400_000), (6, "WARC/1.1\r\n\r\n")]
    df = spark.createDataFrame([(i, None if i == 3 else f"http://a/{i}", h, "z") for i, h in pages], "page_id long, url string, html string, payload string")
    rows = warc.archived(df, archive_bytes=100).collect()
    assert sorted((tuple(r)[0], *tuple(r)[2:6]) for r in rows) == [tuple(x) for x in sorted(expected(pages), key=lambda x: x[0])]
    assert {r.url for r in rows if r.page_id == 3} == {None}
    assert next(bytes(r.payload) for r in rows if r.page_id == 6) == b"WARC/1.1\r\n\r\n"
    assert len({r.archive for r in rows}) >= 2
    assert warc.archived(df.limit(0)).count() == 0


def test_pages_without_an_id(spark):
    pages = [(None, "a"), (3, "a"), (1, "a"), (None, "b"), (None, "b"), (7, "c"), (None, None)]
    df = spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string")
    rows = [(r.page_id, bytes(r.payload).decode(), r.record_type, r.refers_to) for r in warc.archived(df).collect()]
    assert sorted(rows, key=str) == sorted([
        (3, "a", "response", None), (1, "", "revisit", 3), (None, "", "revisit", 3), (None, "b", "response", None),
        (None, "b", "response", None), (7, "c", "response", None), (None, "", "response", None),
    ], key=str)


def test_reader_finds_damage():
    good = warc.record(1, "u", "response", 3, warc.payload_digest(b"abc"), None, b"abc")
    assert [b for _, b in warc.RecordReader().feed(good + good)] == [b"abc", b"abc"]
    slow = warc.RecordReader()
    assert sum(len(list(slow.feed(good[i : i + 1]))) for i in range(len(good))) == 1
    wrong = warc.record(1, "u", "response", 3, warc.payload_digest(b"abd"), None, b"abc")
    with pytest.raises(ValueError, match="payload"):
        list(warc.RecordReader().feed(wrong))
    cut = warc.RecordReader()
    assert list(cut.feed(good[:-9])) == []
    with pytest.raises(ValueError, match="within a record"):
        cut.close()
