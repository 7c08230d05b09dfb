"""From documents to packed sequences: rules, line and document duplicates, repeats, packing.

Each stage works on all that the one before kept, and what it decides takes effect: texts
lose lines and repeated strings, documents go, and what is left is packed. Every stage but
the last returns the columns of `documents`. All handle null, empty, very long and repeated
texts, empty tables and further columns as their operators say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import lines, packing, partenum, quality, suffixes
from headway.llm.common import keep, table
from headway.llm.queries import tokenizer

# word shingles and similarity in percent that make two documents near copies
SHINGLE_WORDS = 5
SIMILARITY = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs of their language."""
    return quality.filtered(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that come earlier, in this form or a similar one."""
    return lines.without_repeated_lines(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id.

    Rows that repeat a doc_id are one document, of which one row stays; rows without an id
    are in no group and stay.
    """
    found = partenum.link_components(docs, SHINGLE_WORDS, SIMILARITY)
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    left = docs.join(keep(gone, "near-copies"), "doc_id", "left_anti").select(*docs.columns)
    again = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 and doc_id is not null")
    if again.isEmpty():
        return left
    known = left.filter("doc_id is not null").dropDuplicates(["doc_id"])
    return known.unionByName(left.filter("doc_id is null"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes or more that start earlier."""
    return suffixes.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the pieces of every document in sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("packing", packed),
]

# similarity joins, certified cutoffs and tokenizers are beyond SQL: tests/llm/test_pipeline.py
# holds every stage against a plain version of it
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES: dict[str, str] = {}
