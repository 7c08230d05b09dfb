"""Encoding and decoding with a SentencePiece model through a table of distinct chunks."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
TABLE_CHUNKS = 200_000
OUTPUT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class ChunkEncoder:
    """Ids of texts, each distinct marked word segmented once.

    No piece of the model holds a mark behind another character, so a text splits
    before every run of marks, and the segments of the chunks, joined in order, are
    the segments of the text. The table is emptied when it holds `limit` chunks.
    """

    def __init__(self, model: str, limit: int = TABLE_CHUNKS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.limit, self.table, self.end = limit, {}, self.model.eos_id()
        crossing = re.compile(f"[^{MARK}]{MARK}")
        if any(crossing.search(self.model.id_to_piece(i)) for i in range(len(self.model))):
            raise ValueError("pieces of this model cross white space")
        self.mark = self.model.piece_to_id(MARK)
        if self.mark == self.model.unk_id():
            raise ValueError("this model has no piece for a lone mark")

    def _add(self, chunks: list[str]) -> None:
        """The model puts one mark in front, so a chunk is given without its first."""
        if len(self.table) + len(chunks) > self.limit:
            self.table.clear()
        for chunk, ids in zip(chunks, self.model.encode(chunks, num_threads=1)):
            # the library gives nothing for an empty text, but a lone mark is a piece
            self.table[chunk] = ids if chunk else [self.mark]

    def ids(self, text: str) -> list[int]:
        if not text:
            return [self.end]
        chunks = text.split(" ")
        if MARK in text or "" in chunks:
            chunks = [c[1:] for c in re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))]
        try:
            found = list(map(self.table.__getitem__, chunks))
        except KeyError:
            self._add([c for c in dict.fromkeys(chunks) if c not in self.table])
            if not all(c in self.table for c in chunks):
                self._add(list(dict.fromkeys(chunks)))
            found = list(map(self.table.__getitem__, chunks))
        ids = list(itertools.chain.from_iterable(found))
        ids.append(self.end)
        return ids


def encode(documents: DataFrame, model: str, text: str = "text") -> DataFrame:
    """`doc_id` and `ids`, an array that ends with the model's end id; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(model)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = encoder.ids(batch.column(1)[row].as_py() or "")
                yield pa.record_batch(
                    [batch.column(0).slice(row, 1), pa.array([ids], pa.list_(pa.int32()))],
                    names=["doc_id", "ids"],
                )

    return documents.select("doc_id", text).mapInArrow(run, "doc_id long, ids array<int>")


def digests(documents: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Token count and digests of the ids and of the text decoded from them, per document.

    A null text is empty: one id, the end. Repeated rows give repeated results, an empty
    table an empty one, and other columns are not read. Needs no shuffle; a task holds one
    Arrow batch and a table of at most TABLE_CHUNKS chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(model)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            counts, coded, decoded = [], [], []
            for value in batch.column(1):
                ids = encoder.ids(value.as_py() or "")
                counts.append(len(ids))
                coded.append(sha(" ".join(map(str, ids))))
                decoded.append(sha(encoder.model.decode(ids)))
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()),
                 pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents.select("doc_id", text).mapInArrow(run, f"doc_id long, {OUTPUT}")
