from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from casework.llm import suffix_dedup as sd

from .conftest import doc_rows, sentence, text_of

SMALL = sd.SuffixDedup(length=24, period=13, cover=(0, 1, 3, 9))


def brute(texts, length):
    """Bytes that go, from a count of every string of ``length`` bytes."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def report(df, plan):
    return sorted((tuple(r) for r in sd.repeat_report(df, plan).collect()), key=repr)


def wanted(rows, length):
    found = brute([r[1] for r in rows], length)
    return sorted(((r[0], *f) for r, f in zip(rows, found)), key=repr)


def repeated_rows(rng, unit):
    """Exact and near copies, a shared passage, short periods, and texts about as long as the strings."""
    base = [text_of(rng, 4) for _ in range(12)]
    passage = sentence(rng, 4 * unit)
    rows = []
    for i in range(60):
        text = rng.choice(base) if rng.random() < 0.5 else text_of(rng, rng.randint(1, 5))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["ß", "x", passage, passage[: 5 * unit]]) + text[at + rng.randint(0, 2) :]
        rows.append((i, text))
    rows += [(60, "ab" * 5 * unit), (61, "a" * 9 * unit), (62, None), (63, ""), (64, passage), (None, passage)]
    rows += [(70 + d, passage[d : d + n]) for d, n in enumerate((unit * 4 - 1, unit * 4, unit * 4 + 1, 1))]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("block", [300, 4 << 20])
def test_equals_brute_force(some_docs, monkeypatch, seed, block):
    monkeypatch.setattr(sd, "BUCKET", 2_000)
    monkeypatch.setattr(sd, "BLOCK", block)
    rows = repeated_rows(random.Random(seed), 6)
    assert report(some_docs(rows).repartition(5), SMALL) == wanted(rows, SMALL.length)


def test_equals_brute_force_in_production(spark, docs):
    rng = random.Random(8)
    rows = [(r[0], r[1]) for r in doc_rows()] + [(100 + i or 0, t) for i, t in repeated_rows(rng, 100) if i is not None]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, block string, data int")
    assert report(df.repartition(4), sd.SuffixDedup()) == wanted(rows, 400)


def test_spans_and_kept_bytes(some_docs):
    rng = random.Random(2)
    passage = sentence(rng, 90)
    rows = [(0, "A" + passage + "B" + sentence(rng, 20)), (1, sentence(rng, 30) + passage), (2, "alone")]
    got = {r.doc_id: r for r in sd.repeated_spans(some_docs(rows)).collect()}
    assert (got[0].begin, got[0].end) == ([1], [1 + len(passage)])
    assert bytes(got[1].kept).decode() == rows[1][1][: -len(passage)]
    assert got[2].begin == [] and bytes(got[2].kept) == b"alone"


def test_cover_has_every_difference():
    for plan in (SMALL, sd.SuffixDedup()):
        differences = {(a - b) % plan.period for a in plan.cover for b in plan.cover}
        assert differences == set(range(plan.period)) and plan.core > 0


def test_hashes_name_strings(monkeypatch):
    monkeypatch.setattr(sd, "SEGMENT", 64)
    data = np.frombuffer(random.Random(1).randbytes(500).translate(bytes(b % 2 for b in range(256))), dtype=np.uint8)
    first = np.arange(480)
    for length in (1, 3, 20):
        for found in sd.string_hashes(data, first, first + length):
            named = {}
            for i, h in enumerate(found.tolist()):
                assert named.setdefault(h, bytes(data[i : i + length])) == bytes(data[i : i + length])
            assert len(named) == len({bytes(data[i : i + length]) for i in range(480)})


def test_a_hot_core_sends_two_contexts_per_block():
    rng = random.Random(6)
    passage = sentence(rng, 8).encode()
    texts = [sentence(rng, 6).encode() + passage + sentence(rng, 6).encode() for _ in range(200)]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    block = sd.Block(data, np.cumsum([len(t) for t in texts]), SMALL, 1)
    block.learn_cores({})
    _, number = np.unique(block.contexts[0][block.sent], return_counts=True)
    assert number.max() == 2 and len(block.sent) > 5 * block.sent.sum()


def test_empty_table(no_docs):
    assert sd.repeat_report(no_docs).collect() == []
