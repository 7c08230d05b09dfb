"""Language of a text from averaged embeddings of hashed subwords and a linear softmax.

The model is fastText's shape: every run of three or four bytes that holds no white space
inside is hashed to a row of an embedding table, the rows are averaged, and a linear layer
with a softmax gives the languages. It is trained by stochastic gradient descent in numpy,
its confidence is set by a temperature fitted on documents kept apart, and predictions whose
confidence falls below the level that keeps `precision` there are marked as not accepted.

Since the layer is linear, the average of rows times the weights is the average of the
rows' own scores, so a text is scored by one table look-up per subword.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import SPACES, blocks, mixed, utf8

BUCKETS = 1 << 14
DIMENSIONS = 16
SIZES = (3, 4)
PER_LANGUAGE = 800  # bound of the labelled sample, documents of each language
EPOCHS = 6
BATCH = 32
RATE = 0.5
PRECISION = 0.99
UNKNOWN = "und"


def subwords(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and first byte of every subword, for one size after the other.

    ASCII letters count in lower case and all white space alike. A subword may start or end
    with white space, so beginnings and ends of words are told apart.
    """
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    fold[list(SPACES)] = 32
    text = fold[data]
    code = mixed(np.arange(256, dtype=np.uint64) + np.uint64(11)).astype(np.uint32)[text]
    gap = text == 32
    # rows left in the text of each byte
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(data))
    for size in SIZES:
        n = len(data) - size + 1
        if n <= 0:
            continue
        value = np.zeros(n, np.uint32)
        for i in range(size):
            value = value * np.uint32(0x01000193) ^ code[i : i + n]
        value ^= value >> np.uint32(15)
        value = value * np.uint32(0x85EBCA6B)
        ok = left[:n] >= size
        for i in range(1, size - 1):
            ok &= ~gap[i : i + n]
        at = np.flatnonzero(ok)
        yield (value[at] >> np.uint32(16)) % np.uint32(BUCKETS), at


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # bucket x language: embedding times weights, over the temperature
    bias: np.ndarray
    accept: float

    def predict(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Probability of each language for each text."""
        n = len(starts) - 1
        total = np.zeros((n, len(self.languages)))
        count = np.zeros(n)
        for bucket, at in subwords(data, starts):
            edge = np.searchsorted(at, starts)
            some = np.flatnonzero(edge[1:] > edge[:-1])
            if len(some):
                total[some] += np.add.reduceat(self.scores[bucket], edge[some], axis=0, dtype=np.float64)
                count += np.diff(edge)
        return softmax(total / np.maximum(count, 1)[:, None] + self.bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fold_of(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; remainder 2 is held out of all learning."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def features(documents: DataFrame) -> DataFrame:
    """Distinct buckets of each text and their shares, at most BUCKETS of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                data, starts = utf8(part.column("text"))
                keys = [
                    (np.searchsorted(starts, at, "right") - 1) * BUCKETS + bucket
                    for bucket, at in subwords(data, starts)
                ]
                key, count = np.unique(np.concatenate(keys or [np.zeros(0, np.int64)]), return_counts=True)
                edge = np.searchsorted(key, np.arange(len(starts)) * BUCKETS).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(edge), pa.array(x, pa.int32()))
                    for x in (key % BUCKETS, count)
                ]
                yield pa.record_batch(
                    [part.column("lang"), part.column("fold"), *lists],
                    names=["lang", "fold", "buckets", "counts"],
                )

    return documents.select("lang", "fold", "text").mapInArrow(
        run, "lang string, fold long, buckets array<int>, counts array<int>"
    )


def sample(documents: DataFrame, per_language: int) -> list:
    """At most about `per_language` labelled documents of each language, by a hash of the id."""
    known = documents.select("doc_id", "text", "lang", fold_of().alias("fold")).filter(
        "fold <> 2 and lang is not null and text is not null"
    )
    totals = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    wanted = F.lit(False)
    for lang, n in totals.items():
        wanted = wanted | ((F.col("lang") == lang) & (draw < per_language / n))
    rows = features(known.filter(wanted)).collect()
    return sorted(rows, key=lambda r: (r["lang"], r["fold"], r["buckets"], r["counts"]))


def train(rows: list, epochs: int = EPOCHS, seed: int = 5) -> Model | None:
    """Fit on folds 0 and 1, set temperature and acceptance on fold 3."""
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return None
    index = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    pack = [
        (np.array(r["buckets"]), np.array(r["counts"], np.float32) / max(1, sum(r["counts"])), index[r["lang"]], r["fold"])
        for r in rows
        if r["buckets"]
    ]
    fit = [p for p in pack if p[3] != 3] or pack
    apart = [p for p in pack if p[3] == 3] or pack
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps = max(1, epochs * len(fit) // BATCH)
    step = 0
    for _ in range(max(epochs, -(-400 * BATCH // max(1, len(fit))) if len(fit) < 400 else epochs)):
        order = rng.permutation(len(fit))
        for i in range(0, len(order), BATCH):
            part = [fit[j] for j in order[i : i + BATCH]]
            sizes = np.array([len(p[0]) for p in part])
            at = np.concatenate([p[0] for p in part])
            share = np.concatenate([p[1] for p in part])[:, None]
            edge = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(table[at] * share, edge, axis=0)
            slope = softmax((mean @ weights + bias).astype(np.float64)).astype(np.float32)
            slope[np.arange(len(part)), [p[2] for p in part]] -= 1
            rate = RATE * max(0.1, 1 - step / steps)
            back = slope @ weights.T
            weights -= rate * mean.T @ slope / len(part)
            bias -= rate * slope.mean(axis=0)
            # each subword is a small share of its text, so its own rate is larger
            np.subtract.at(table, at, 20 * rate * share * np.repeat(back, sizes, axis=0))
            step += 1
    scores = table @ weights
    logits = np.array([(scores[p[0]] * p[1][:, None]).sum(axis=0) + bias for p in apart], np.float64)
    truth = np.array([p[2] for p in apart])
    if not len(truth):
        return Model(languages, scores, bias.astype(np.float64), 1.0)
    here = np.arange(len(truth))
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(logits / t)[here, truth] + 1e-12).mean() for t in grid]
    heat = float(grid[int(np.argmin(loss))])
    found = softmax(logits / heat)
    sure, right = found.max(axis=1), found.argmax(axis=1) == truth
    order = np.argsort(-sure)
    good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= PRECISION
    accept = float(sure[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Model(languages, (scores / heat).astype(np.float32), bias / heat, accept)


def has_letter(part: pa.Array, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = True
    total = np.concatenate([[0], np.cumsum(letter[data], dtype=np.int64)])
    found = total[starts[1:]] > total[starts[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in part[int(i)].as_py() or "")
    return found


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, accepted; `und` and 0 for texts without letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                data, starts = utf8(part.column("text"))
                known = has_letter(part.column("text"), data, starts)
                if model is None:
                    known[:] = False
                    chance = np.zeros((len(known), 1))
                    names = np.array([UNKNOWN], object)
                else:
                    chance = model.predict(data, starts)
                    names = np.array(model.languages, object)
                score = np.where(known, chance.max(axis=1), 0.0)
                lang = np.where(known, names[chance.argmax(axis=1)], UNKNOWN)
                accepted = known & (score >= (model.accept if model else 1.0))
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score),
                     pa.array(accepted)],
                    names=["doc_id", "lang_pred", "score", "accepted"],
                )

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, accepted boolean"
    )


def identify(documents: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Train on the labelled documents and predict the language of every whole text.

    A null text, or one without a letter, is `und` with score 0; so is every text if no
    document is labelled. Repeated rows get equal results, an empty table gives none. A
    document without an id has no fold: it is neither learned from nor held out.
    """
    model = train(sample(documents, per_language))
    found = predict(documents, model)
    return found.withColumn("held_out", F.coalesce(fold_of() == 2, F.lit(False)))
