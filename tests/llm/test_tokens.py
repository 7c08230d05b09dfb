"""Packing and piece encoding against the libraries themselves."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from headway.llm import packing, pieces
from headway.llm.queries import op5_packing, op10_sentencepiece, tokenizer
from tests.llm.conftest import EDGES

SF_DIR = "/root/testdata/sf0.001"
BPE = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
PIECE = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
OURS = packing.BytePairEncoder(tokenizer("byte_bpe_50k.json"), limit=50)
CHUNKS = pieces.ChunkEncoder(tokenizer("piece_bpe_32k.model"), limit=50)
TEXT = st.text(st.sampled_from("ab '▁s\n\t\x0b\x1c\x85\xa0  1.é漢\U0001f600<|endoftext|>") | st.characters(exclude_categories=["Cs"]), max_size=40)


def ids(text: str) -> list[int]:
    return np.frombuffer(OURS.encode(text), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_byte_pairs_equal_library(text):
    assert ids(text) == BPE.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_chunks_equal_library(text):
    assert CHUNKS.ids(text) == PIECE.encode(text) + [PIECE.eos_id()]


@pytest.mark.parametrize("text", ["", " ", "  a", "a <|endoftext|> b", "<|endoftext|>", "x\n y", "a  \n  b "])
def test_chosen_texts(text):
    assert ids(text) == BPE.encode(text, add_special_tokens=False).ids
    assert CHUNKS.ids(text) == PIECE.encode(text) + [PIECE.eos_id()]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def check_digests(rows, texts):
    found = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)
    wanted = []
    for i, text in texts:
        codes = PIECE.encode(text or "") + [PIECE.eos_id()]
        wanted.append((i or -1, len(codes), sha(" ".join(map(str, codes))), sha(PIECE.decode(codes))))
    assert found == sorted(wanted)


def test_pieces_query(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in df.collect()]
    check_digests(op10_sentencepiece(spark, SF_DIR).collect(), texts)


def test_pieces_edges(edges):
    check_digests(pieces.digests(edges, tokenizer("piece_bpe_32k.model")).collect(), EDGES)
    assert pieces.digests(edges.limit(0), tokenizer("piece_bpe_32k.model")).count() == 0
    found = pieces.encode(edges, tokenizer("piece_bpe_32k.model")).collect()
    assert sorted(len(r.ids) for r in found) == sorted(len(PIECE.encode(t or "")) + 1 for _, t in EDGES)


def check_packing(rows, texts, window):
    wanted = []
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, text in texts:
        codes = BPE.encode(text or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(codes), window):
            part = codes[at : at + window]
            wanted.append((i or -1, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(codes)))
    found = [(r.doc_id or -1, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows]
    assert sorted(found) == sorted(wanted)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return by_sequence


def test_packing_query(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = check_packing(op5_packing(spark, SF_DIR).collect(), [(r.doc_id, r.text) for r in df.collect()], 2048)
    used = sum(n for parts in found.values() for _, n in parts)
    assert used > 0.97 * 2048 * len(found)


def test_packing_edges(edges):
    path = tokenizer("byte_bpe_50k.json")
    check_packing(packing.pack_documents(edges, path, 64).collect(), EDGES, 64)
    assert packing.pack_documents(edges.limit(0), path).count() == 0


def best_fit(counts: dict[int, int], window: int) -> int:
    rooms: list[int] = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            fits = [r for r in rooms if r >= size]
            if fits:
                rooms[rooms.index(min(fits))] -= size
            else:
                rooms.append(window - size)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(4)
    for _ in range(60):
        window = rng.choice([7, 16, 40])
        counts = {rng.randint(1, window): rng.randint(1, 12) for _ in range(rng.randint(1, 9))}
        used = defaultdict(int)
        ranks = defaultdict(list)
        for size, first_rank, n, first, per, offset in packing.plan(counts, window):
            for k in range(n):
                ranks[size].append(first_rank + k)
                assert used[first + k // per] == offset + (k % per) * size
                used[first + k // per] += size
        assert {s: sorted(r) for s, r in ranks.items()} == {s: list(range(n)) for s, n in counts.items()}
        assert sorted(window - u for u in used.values()) == best_fit(counts, window)
