from __future__ import annotations

import zlib

import numpy as np
import pytest
from casework.llm import packing
from casework.llm.queries import vocabulary
from casework.llm.tokens import Encoder
from tokenizers import Tokenizer

from .conftest import doc_rows


@pytest.fixture(scope="module")
def tokenizer():
    return Encoder(vocabulary())


@pytest.mark.parametrize(
    "text",
    ["", " ", "a  b", "don't 's'll it's", "x\n\n y\tz ", "é̀ ½ ² 中文 ١٢", "<|endoftext|> here", "hello <|endoftext|> world",
     "a<|endoftext|>", "<|endoftext|", "<|endoftext|><|endoftext|>", "a b c", "ß,ñ. Ça va?"],
)
def test_ids_are_the_tokenizers(tokenizer, text):
    plain = Tokenizer.from_file(vocabulary())
    assert np.frombuffer(tokenizer(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_ids_of_whole_documents(tokenizer):
    for _, text, *_ in doc_rows()[:70]:
        ids = tokenizer.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(tokenizer(text or ""), "<u4").tolist() == ids


def test_pieces_cover_documents_and_fill_sequences(docs, tokenizer):
    rows = packing.pack(docs, vocabulary()).collect()
    want = []
    for doc, text, *_ in doc_rows():
        ids = np.append(np.frombuffer(tokenizer(text or ""), "<u4"), np.uint32(0)).astype("<u4")
        for piece, (start, length) in enumerate(packing.piece_bounds(len(ids), 2048)):
            want.append((doc, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 2048) + 1


def greedy(lengths, capacity):
    """Vector best-fit piece by piece, the rule as stated."""
    bins = []
    for n in sorted(lengths, reverse=True):
        best = None
        for b in bins:
            left = (b[0] - n, b[1] - 1, b[2] - n * n)
            if min(left) >= 0:
                norm = sum(w * (x / c) ** 2 for w, x, c in zip(capacity.weights, left, (capacity.tokens, capacity.documents, capacity.cost)))
                if best is None or norm < best[0]:
                    best = (norm, b)
        if best is None:
            bins.append([capacity.tokens - n, capacity.documents - 1, capacity.cost - n * n])
        else:
            best[1][0] -= n
            best[1][1] -= 1
            best[1][2] -= n * n
    return len(bins)


@pytest.mark.parametrize("limits", [(100, 100, 10_000), (100, 3, 10_000), (100, 10, 4_200)])
def test_placement_holds_every_capacity(limits):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 61, 400).tolist()
    capacity = packing.Capacity(*limits)
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.place(counts, capacity)
    used = {}
    for n, steps in plan.items():
        for (first, target, _), after in zip(steps, [*steps[1:], (counts[n],)]):
            for k in range(after[0] - first):
                t = used.setdefault(target + k, [0, 0, 0])
                t[0] += n
                t[1] += 1
                t[2] += n * n
    assert sum(t[1] for t in used.values()) == 400
    assert all(t[0] <= limits[0] and t[1] <= limits[1] and t[2] <= limits[2] for t in used.values())
    assert len(used) <= greedy(lengths, capacity) * 1.05 + 1


def test_a_piece_beyond_a_capacity_is_an_error():
    with pytest.raises(ValueError):
        packing.place({90: 1}, packing.Capacity(100, 10, 1000))


def test_empty_table(no_docs):
    assert packing.pack(no_docs, vocabulary()).count() == 0
