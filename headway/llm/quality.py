"""Quality rules whose cutoffs are chosen under a bound on false rejection.

Every text is measured in one pass. Labelled clean documents are dealt into two folds. The
first gives, for each stratum and severity, a cutoff per rule: the quantile that leaves the
severity's share of clean documents above it, moved further out by a margin of its distance
to the median for the mildest. On the second, severities are tried from the
mildest on. One is certified while the exact binomial upper bound on its share of falsely
rejected clean documents stays below `risk`; the first failure ends the sequence, so trying
many severities costs nothing, and the error is divided by the number of strata. Every
certified severity keeps the bound, so the mildest holds that rejects nearly all (`NEARLY`)
of the bad documents that the strictest does; a stratum without one rejects nothing by
these rules.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import SpanHash, blocks, free_name, keep, mixed, sums_by, utf8, words

RISK = 0.03
ERROR = 0.1
NEARLY = 0.99
# (share of clean documents above the cutoff, margin put on it), the mildest first
SEVERITIES = (
    (0.0, 1.0), (0.0, 0.5), (0.0, 0.25), (0.0, 0.0), (0.0005, 0.0), (0.001, 0.0), (0.002, 0.0),
    (0.004, 0.0), (0.006, 0.0), (0.008, 0.0), (0.01, 0.0), (0.015, 0.0), (0.02, 0.0),
)
MIN_WORDS = 50
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_marks",
)
SYMBOLS = b"#*$%&|<>"
MARKS = b"!?~^=_@"


def measured(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """MEASURES of the texts `data[starts[i]:starts[i + 1]]`."""
    n = len(starts) - 1
    begin, end, row = words(data, starts)
    n_words = sums_by(row, n)

    def bytes_in(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[starts[1:]] - total[starts[:-1]]

    kind = np.zeros((4, 256), bool)
    kind[0] = True
    kind[0, 0x80:0xC0] = kind[0, [32, 9, 10, 11, 12, 13]] = False
    kind[1, list(SYMBOLS)] = kind[2, 65:91] = kind[3, list(MARKS)] = True
    word_chars, n_symbols, n_upper, n_marks = (bytes_in(k[data]) for k in kind)
    hashes = SpanHash(data)

    # windows of three words, equal within a text
    n_repeat = np.zeros(n, np.int64)
    if len(row) >= 3:
        w = hashes.of(begin, end)
        whole = row[2:] == row[:-2]
        key = mixed(mixed(w[:-2] + np.uint64(1)) + mixed(w[1:-1] + np.uint64(2)) * np.uint64(3))
        key = mixed(key + w[2:] * np.uint64(5)) ^ mixed(row[2:].astype(np.uint64))
        at = np.flatnonzero(whole)
        order = at[np.argsort(key[at])]
        same = key[order[1:]] == key[order[:-1]]
        again = np.zeros(len(row), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        covered = again.copy()
        covered[1:] |= again[:-1]
        covered[2:] |= again[:-2]
        n_repeat = sums_by(row[covered], n)

    # lines with a word; a line starts with its row or after a line break
    breaks = np.flatnonzero(data == 10)
    first = np.union1d(starts[:-1][starts[1:] > starts[:-1]], breaks + 1)
    first = first[first < len(data)]
    line_row = np.searchsorted(starts, first, "right") - 1
    last = np.minimum(np.concatenate([first[1:], [len(data)]]), starts[line_row + 1])
    ends_in_break = data[last - 1] == 10 if len(last) else np.zeros(0, bool)
    has_word = np.searchsorted(begin, last) > np.searchsorted(begin, first)
    first, last, line_row = first[has_word], (last - ends_in_break)[has_word], line_row[has_word]
    n_lines = sums_by(line_row, n)
    # keys hold the row, so the distinct ones per row are counted through their rows
    key = hashes.of(first, last) ^ mixed(line_row.astype(np.uint64) + np.uint64(7))
    _, one = np.unique(key, return_index=True)
    n_dup = n_lines - sums_by(line_row[one], n)
    return [n_words, word_chars, n_symbols, n_dup, n_repeat, n_lines, n_upper, n_marks]


def measure(documents: DataFrame, name: str, text: str = "text", carry: bool = True) -> DataFrame:
    """`documents` with a struct column `name` of MEASURES; a null text measures as empty.

    Without `carry` the text itself is left out.
    """
    fields = [f for f in documents.schema.fields if carry or f.name != text]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text):
                found = measured(*utf8(part.column(text)))
                struct = pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in found], names=list(MEASURES)
                )
                yield pa.record_batch([*(part.column(c) for c in names), struct], names=[*names, name])

    struct = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
    return documents.mapInArrow(run, T.StructType([*fields, T.StructField(name, struct)]))


def base_failed(m: str) -> Column:
    """Too short, or mostly windows of three words that the text repeats."""
    n = F.col(f"{m}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{m}.n_repeat_words") > 50 * n)


def scores(m: str) -> dict[str, Column]:
    """Rules by name; the higher the score, the worse the text."""
    n = F.greatest(F.col(f"{m}.n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col(f"{m}.word_chars"), F.lit(1)).cast("double")
    return {
        "symbols": F.col(f"{m}.n_symbols") / n,
        "marks": F.col(f"{m}.n_marks") / n,
        "capitals": F.col(f"{m}.n_upper") / chars,
        "repeated_lines": F.col(f"{m}.n_dup_lines") / F.greatest(F.col(f"{m}.n_lines"), F.lit(1)),
        "repeated_words": F.col(f"{m}.n_repeat_words") / n,
        "long_words": F.col(f"{m}.word_chars") / n,
        "short_words": -F.col(f"{m}.word_chars") / n,
    }


def upper_bound(failures: int, trials: int, error: float) -> float:
    """Exact (Clopper-Pearson) upper bound on a share, at confidence 1 - `error`."""
    if trials == 0 or failures >= trials:
        return 1.0
    logs = [
        math.lgamma(trials + 1) - math.lgamma(k + 1) - math.lgamma(trials - k + 1)
        for k in range(failures + 1)
    ]

    def at_most(p: float) -> float:
        terms = [c + k * math.log(p) + (trials - k) * math.log1p(-p) for k, c in enumerate(logs)]
        return sum(map(math.exp, terms))

    low, high = failures / trials, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        if middle <= 0 or at_most(middle) > error:
            low = middle
        else:
            high = middle
    return high


def certify(trials: list[tuple[int, int]], error: float, risk: float) -> int | None:
    """Index of the last severity that holds, in a fixed sequence of (failures, trials)."""
    held = None
    for i, (failures, n) in enumerate(trials):
        # a share above the risk cannot have a bound below it
        if failures > risk * n or upper_bound(failures, n, error) > risk:
            break
        held = i
    return held


def measures(documents: DataFrame, stratum: str) -> DataFrame:
    """doc_id, stratum, hash `same` of the text and measures `m` of every document, kept:
    rows without their texts."""
    rows = documents.select(
        "doc_id", F.coalesce(stratum, F.lit("und")).alias("stratum"), F.xxhash64("text").alias("same"), "text"
    )
    return keep(measure(rows, "m", carry=False), "measures")


def thresholds(
    measured: DataFrame,
    labels: DataFrame,
    risk: float = RISK,
    error: float = ERROR,
    severities: tuple[tuple[float, float], ...] = SEVERITIES,
) -> dict[str, dict[str, float]]:
    """Cutoff of each rule by stratum, from `measures`; a score above it rejects.

    A text is bad if a label of a document with it says quality 0, else clean. All labelled
    texts count, each once: the bounds are of independent trials, and copies of one text are
    none. For the same reason the text, not the document, decides which part of the labels it
    is in. Only quantiles and counts per stratum reach the driver.
    """
    marks = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = measured.filter(~base_failed("m")).join(marks.filter("quality is not null"), "doc_id").select(
        "stratum", "same", (F.col("quality") == 1).alias("clean"), *(score.alias(name) for name, score in scores("m").items())
    )
    rules = list(scores("m"))
    # equal texts of a stratum have equal scores
    once = known.groupBy("stratum", "same").agg(F.min("clean").alias("clean"), *(F.min(r).alias(r) for r in rules))
    known = keep(once.withColumn("fit", F.pmod("same", F.lit(4)) == 0), "scores")
    levels = F.array(F.lit(0.5), *(F.lit(1 - share) for share, _ in severities))

    def spread(found: list[float]) -> list[float]:
        return [q + margin * (q - found[0]) for q, (_, margin) in zip(found[1:], severities)]

    cuts = {
        r["stratum"]: {name: spread(r[name]) for name in rules}
        for r in known.filter("fit and clean").groupBy("stratum").agg(
            *(F.percentile_approx(name, levels, 10_000).alias(name) for name in rules)
        ).collect()
    }
    if not cuts:
        return {}

    def rejected(i: int) -> Column:
        by = {s: {name: c[name][i] for name in rules} for s, c in cuts.items()}
        return rejects(by, F.col("stratum"), {name: F.col(name) for name in rules})

    held = {}
    bad = ~F.col("clean")
    tests = known.filter("not fit or not clean").groupBy("stratum").agg(
        F.count_if("clean").alias("n"),
        *(F.count_if(F.col("clean") & rejected(i)).alias(f"f{i}") for i in range(len(severities))),
        *(F.count_if(bad & rejected(i)).alias(f"b{i}") for i in range(len(severities))),
    )
    for r in tests.collect():
        if r["stratum"] in cuts:
            trials = [(r[f"f{i}"], r["n"]) for i in range(len(severities))]
            last = certify(trials, error / len(cuts), risk)
            if last is not None:
                best = next(i for i in range(last + 1) if r[f"b{i}"] >= NEARLY * r[f"b{last}"])
                held[r["stratum"]] = {name: cuts[r["stratum"]][name][best] for name in rules}
    return held


def rejects(cutoffs: dict[str, dict[str, float]], stratum: Column, by_rule: dict[str, Column]) -> Column:
    """Whether any rule exceeds the cutoff of its stratum; false without cutoffs."""
    verdict = F.lit(False)
    for name, score in by_rule.items():
        cut = None
        for value, cuts in cutoffs.items():
            here = stratum == F.lit(value)
            cut = F.when(here, cuts[name]) if cut is None else cut.when(here, cuts[name])
        if cut is not None:
            verdict = verdict | F.coalesce(score > cut, F.lit(False))
    return verdict


def failed(cutoffs: dict[str, dict[str, float]], m: str, stratum: Column) -> Column:
    return base_failed(m) | rejects(cutoffs, stratum, scores(m))


def judged(documents: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, measures `m`, `base_failed` and `kept` of every document.

    Null or empty texts have no words and fail. Repeated rows are judged alike, an empty
    table gives no rows, and without labels only the base rules reject. One pass over the
    texts; labels meet rows of a few numbers.
    """
    rows = measures(documents, stratum)
    cutoffs = thresholds(rows, labels)
    return rows.withColumns({
        "base_failed": base_failed("m"), "kept": ~failed(cutoffs, "m", F.col("stratum")),
    })


def filtered(documents: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents that pass, with their own columns.

    Texts are measured a second time rather than shuffled to meet their verdicts.
    """
    cutoffs = thresholds(measures(documents, stratum), labels)
    name = free_name(documents, "measures")
    verdict = failed(cutoffs, name, F.coalesce(F.col(stratum), F.lit("und")))
    return measure(documents, name).filter(~verdict).select(*documents.columns)
