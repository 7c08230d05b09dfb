"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import html_text, infill, language, lines, packing, partenum, pieces, quality, ranking, suffixes, vectors, warc, windows
from headway.llm.common import table


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link_vectors(table(spark, sf_dir, "embeddings"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.summaries(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return packing.pack_documents(documents, tokenizer("byte_bpe_50k.json"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.link_components(table(spark, sf_dir, "documents"), words_each=4, share=85)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select(
        "doc_id", *(F.col(f"m.{name}").alias(name) for name in base), "base_failed", "kept"
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.summaries(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.summaries(table(spark, sf_dir, "documents"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.summaries(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_language_id, op3_embedding_dedup, op4_suffix_dedup, op5_packing, op6_jaccard_join, op7_quality_rules, op8_warc,
        op9_line_dedup, op10_sentencepiece, op11_lexical_search,
        op12_fill_in_middle, op13_substring_dedup,
    )
}

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = (
    f"regexp_extract_all(translate(text, '{_LETTERS}', '{_LETTERS.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
_LEXICAL_SEARCH = f"""
WITH found AS (
    SELECT doc_id, term, count(*) AS tf
    FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) AS every
    GROUP BY doc_id, term
), sized AS (
    SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM found GROUP BY doc_id
), totals AS (
    SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM sized
), asked AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) AS every
    GROUP BY item_id, term
), weighted AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM found GROUP BY term) AS holders, totals
), scored AS (
    SELECT item_id, doc_id,
           CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * documents) // length)))) AS BIGINT) AS score
    FROM asked JOIN found USING (term) JOIN weighted USING (term) JOIN sized USING (doc_id), totals
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, doc_id, score,
           CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
_FILL_IN_MIDDLE = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
    FROM documents
), cut AS (
    SELECT doc_id, text, units, len(units) AS n,
           CAST('0x' || substr(hex, 1, 8) AS BIGINT) % (len(units) + 1) AS one,
           CAST('0x' || substr(hex, 9, 8) AS BIGINT) % (len(units) + 1) AS two,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR CAST('0x' || substr(hex, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
                WHEN CAST('0x' || substr(hex, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT *, array_to_string(units[:least(one, two)], '') AS prefix,
           array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
           array_to_string(units[greatest(one, two) + 1:], '') AS suffix
    FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

ORACLES: dict[str, str] = {
    "op11_lexical_search": _LEXICAL_SEARCH,
    "op12_fill_in_middle": _FILL_IN_MIDDLE,
}
