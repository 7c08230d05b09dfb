"""Quality measures, languages and page extraction."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import html_text, language, quality
from headway.llm.queries import op1_html_extraction, op2_language_id, op7_quality_rules
from tests.llm.conftest import EDGES

SF_DIR = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


def measures(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(WORD, text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def measured(texts: list[str]) -> list[tuple]:
    data = [t.encode() for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    found = quality.measured(np.frombuffer(b"".join(data), np.uint8), starts)
    return [tuple(int(x) for x in row) for row in zip(*found[:5])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab é#\n\t\r漢|", max_size=30), min_size=1, max_size=4))
def test_measures(texts):
    assert measured(texts) == [measures(t) for t in texts]


def test_quality_query(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    rows = op7_quality_rules(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n, chars, symbols, dup, repeat = measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert not (r.base_failed and r.kept)


def test_quality_edges(spark, edges):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.judged(edges, none).collect()
    assert sorted(tuple(r.m)[:5] for r in rows) == sorted(measures(t) for _, t in EDGES)
    assert quality.judged(edges.limit(0), none).count() == 0
    kept = quality.filtered(edges.withColumnRenamed("n_words", "measures"), none)
    assert kept.columns == [*edges.columns[:-1], "measures"]


def test_rules_reject_junk_and_keep_clean(spark, documents):
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(500)]
    rows, marks = [], []
    for i in range(900):
        words = [str(w) for w in rng.choice(vocabulary, 80)]
        junk = i % 10 == 0
        rows.append((i, " ".join(w + "###" if junk else w for w in words), "en" if i % 3 else None))
        marks.append((i, 0 if junk else 1, 0))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.filtered(documents(rows), labels).collect()}
    assert not kept & {i for i, q, _ in marks if not q}
    clean = [i for i, q, _ in marks if q]
    assert len(kept) >= (1 - quality.RISK) * len(clean)


def plain_cutoffs(rows, risk, error):
    """Cutoffs by stratum from one row per text: its fold, whether it is clean, and its scores."""
    def quantile(values, p):
        return sorted(values)[max(math.ceil(p * len(values)), 1) - 1]

    def bound(failures, n):
        low, high = failures / n, 1.0
        for _ in range(60):
            p = (low + high) / 2
            tail = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(failures + 1))
            low, high = (p, high) if tail > error / len(strata) else (low, p)
        return high

    strata = {s for s, fit, clean, _ in rows if fit and clean}
    found = {}
    for stratum in strata:
        fit = [x for s, f, c, x in rows if s == stratum and f and c]
        apart = [x for s, f, c, x in rows if s == stratum and c and not f]
        bad = [x for s, f, c, x in rows if s == stratum and not c]
        steps = []
        for share, margin in quality.SEVERITIES:
            cut = {}
            for rule in fit[0]:
                middle, high = (quantile([x[rule] for x in fit], p) for p in (0.5, 1 - share))
                cut[rule] = high + margin * (high - middle)
            hit = lambda x: any(x[rule] > cut[rule] for rule in cut)  # noqa: B023, E731
            failures = sum(map(hit, apart))
            if not apart or failures > risk * len(apart) or bound(failures, len(apart)) > risk:
                break
            steps.append((sum(map(hit, bad)), cut))
        if steps:
            found[stratum] = next(cut for caught, cut in steps if caught >= quality.NEARLY * steps[-1][0])
    return found


@pytest.mark.parametrize("copies", [0, 400])
def test_verdicts_are_those_of_a_plain_recomputation(spark, documents, copies):
    """Also with many copies of one clean text, each text being one trial."""
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(300)]
    rows, marks = [], []
    for i in range(1600):
        words = [str(w) for w in rng.choice(vocabulary, 70)]
        junk = i % 9 == 0
        marked = rng.random(70) < (0.3 if junk else 0.02)
        text = " ".join(w + "#" if m else w for w, m in zip(words, marked))
        rows.append((i, text, "en" if i % 3 else "de"))
        marks.append((i, 0 if junk else 1, 0))
    rows += [(5000 + k, rows[1][1], "en") for k in range(copies)]
    marks += [(5000 + k, 1, 0) for k in range(copies)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    df = documents(rows)
    fold = {r.doc_id: r.fold for r in df.selectExpr("doc_id", "pmod(xxhash64(text), 4) AS fold").collect()}
    judged = quality.judged(df, labels).collect()
    quality_of, score = dict((i, q) for i, q, _ in marks), {}
    for r in judged:
        m = r.m.asDict()
        n, chars = max(m["n_words"], 1), max(m["word_chars"], 1)
        score[r.doc_id] = {
            "symbols": m["n_symbols"] / n, "marks": m["n_marks"] / n, "capitals": m["n_upper"] / chars,
            "repeated_lines": m["n_dup_lines"] / max(m["n_lines"], 1), "repeated_words": m["n_repeat_words"] / n,
            "long_words": m["word_chars"] / n, "short_words": -m["word_chars"] / n,
        }
    once = {}
    for i, text, lang in rows:
        was = once.get((text, lang), (lang, fold[i] == 0, True, score[i]))
        once[text, lang] = (*was[:2], was[2] and quality_of[i] == 1, was[3])
    good = {r.doc_id for r in judged if not r.base_failed}
    known = [once[text, lang] for text, lang in {(t, x): 0 for i, t, x in rows if i in good}]
    cuts = plain_cutoffs(known, quality.RISK, quality.ERROR)
    assert set(cuts) == {"en", "de"}
    for r in judged:
        high = any(score[r.doc_id][rule] > cut for rule, cut in cuts[r.stratum].items())
        assert r.kept == (not r.base_failed and not high)
    assert 0 < sum(not r.kept for r in judged if not r.base_failed) < len(judged) / 4


def test_exact_bound():
    assert abs(quality.upper_bound(0, 100, 0.05) - (1 - 0.05**0.01)) < 1e-9
    assert abs(quality.upper_bound(2, 50, 0.05) - 0.12061) < 1e-4
    assert quality.upper_bound(5, 5, 0.1) == quality.upper_bound(0, 0, 0.1) == 1.0
    assert quality.certify([(0, 500), (1, 500), (400, 500), (0, 500)], 0.05, 0.03) == 1
    assert quality.certify([(0, 10)], 0.05, 0.03) is None


def test_language_query(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = op2_language_id(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    held = [r for r in rows if r.held_out]
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, edges, documents):
    rows = language.identify(edges).collect()
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert len(rows) == len(EDGES) and {r.lang_pred for r in rows} == {"und"}
    two = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de") for i in range(80)]
    found = {(r.doc_id, r.lang_pred) for r in language.identify(documents([*two, (90, "12 34"), (91, "漢字")])).collect()}
    assert {(i, lang) for i, _, lang in two} <= found
    assert (90, "und") in found and (91, "und") not in found
    assert language.identify(documents([])).count() == 0


PAGE = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<header><p>Site header words that are long enough to look like prose, really.</p></header>
<nav><ul><li><a href=x>Menu one</a></li><li><a href=y>Menu two</a></li></ul></nav>
<div class="notice">We use cookies on this page, and would like your consent to that.</div>
%s<h1>A &amp; B</h1><p>First   long paragraph with <b>bold</b> words &eacute; and much more prose in it.
<br>After a break there is some more of the prose.<p>Short one.</p>
<form><p>Sign up for our letter</p><input name=q></form><div class="ad">Buy this thing now, it is cheap.</div>
<p>Last paragraph, again with a fair number of words in it.</p>%s
<aside>Sidebar text with a number of words in it that might be taken for prose.</aside>
<section class="comments"><article class="comment"><p>Reader comment that is long enough to be prose.</p></article></section>
<footer>Copyright words</footer></body></html>"""
MAIN = (
    "A & B First long paragraph with bold words é and much more prose in it. After a break there is "
    "some more of the prose. Short one. Last paragraph, again with a fair number of words in it."
)


def test_main_text():
    assert html_text.main_text(PAGE % ("<article>", "</article>")) == MAIN
    assert html_text.main_text(PAGE % ("<main><div>", "</div></main>")) == MAIN
    assert html_text.main_text(PAGE % ("", "")) == MAIN
    assert html_text.main_text(PAGE % ("<div id=content>", "</div>")) == MAIN
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    assert html_text.main_text("plain text") == "plain text"
    assert html_text.main_text("<nav>menu<article><p>unclosed menu</p></article>") == "unclosed menu"
    assert html_text.main_text("<p>" + "word " * 50_000 + "</p>") == ("word " * 50_000).strip()


def test_page_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = op1_html_extraction(spark, SF_DIR).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    import html

    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", article)).split())
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_page_edges(spark):
    df = spark.createDataFrame([(1, None, None, 0), (1, "u", "", 0), (None, "u", "<p>x", 1)], "page_id long, url string, html string, text int")
    assert sorted(r.text for r in html_text.extract(df).collect()) == ["", "", "x"]
    assert html_text.extract(df.limit(0)).count() == 0
