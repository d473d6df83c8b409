"""The pipeline's stages in a chain, each against what it must keep of its predecessor's rows."""

from __future__ import annotations

import random

import pytest
from casework.llm import packing
from casework.llm.queries import vocabulary
from casework.llm.tokens import Encoder

import corpus_pipeline

from .conftest import DOCS, sentence
from .test_line_dedup import brute as brute_lines
from .test_near_dedup import brute_classes


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Toxic, repeated and near-equal documents, nulls, empty texts, repeated rows and columns of clashing names."""
    rng = random.Random(41)
    path, rows, labels = tmp_path_factory.mktemp("pipeline"), [], []
    for i in range(240):
        bad = i % 4 == 0
        text = "\n".join(sentence(rng, rng.randint(9, 25)) + "." for _ in range(rng.randint(1, 4)))
        if bad:
            text += f"\nyou are a {rng.choice(['grobnak', 'zilfert'])} {rng.choice(['grobnak', 'zilfert'])}."
        rows.append((i, text, "en", rng.choice(["a", "a", "b", "c"])))
        if i < 200:
            labels.append((i, 1, int(bad)))
    clean = [r for r in rows if r[0] % 4]
    rows += [(300 + i, clean[i][1], "de", "b") for i in range(5)]
    for i in range(5):
        words = clean[20 + i][1].split(" ")
        words[len(words) // 2] = "changedword"
        rows.append((310 + i, " ".join(words + ["more"] * (i % 2)), "de", None))
    rows += [(320, None, None, None), (321, "", "en", "c"), (None, "a text without an id", "en", "a"), (322, "one more", "en", "a")] * 2
    documents = [(i, t, lang, s, None if t is None else len(t), 1, 2, "x", 3) for i, t, lang, s in rows]
    spark.createDataFrame(documents, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def key(r):
    return repr((r.doc_id, r.text, r.source, r.lang))


def test_each_stage_keeps_what_it_must(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, kept[-1], folder)
        out.write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}"))
        assert name == "packing" or kept[-1].columns == columns
    start, clean, lines, near, mixed, packed = ([r for r in df.collect()] for df in kept)
    # Toxic ones go, by their planted words; the others stay as they are, but for what a score learned on 200 rows mistakes.
    harmless = [key(r) for r in start if "grobnak" not in (r.text or "") and "zilfert" not in (r.text or "")]
    assert set(map(key, clean)) <= set(harmless) and len(clean) >= 0.97 * len(harmless)
    # Later copies of repeated line runs go; the chain's rows are compared by id and text.
    distinct = sorted({(r.doc_id, r.text) for r in clean if r.doc_id is not None}, key=repr)
    want = dict(zip([i for i, _ in distinct], brute_lines([(i, t) for i, t in distinct], 8)))
    assert all(r.text == want[r.doc_id] for r in lines if r.doc_id is not None) and len(lines) == len(clean)
    # One document of each class stays.
    ids = [(r.doc_id if r.doc_id is not None else -1, r.text) for r in lines]
    classes = brute_classes(ids)
    assert len(near) == len(classes)
    assert all(sum((r.doc_id if r.doc_id is not None else -1) in c for r in near) >= 1 for c in classes)
    # The mix repeats documents at most twice and invents none.
    times = {}
    for r in mixed:
        times[key(r)] = times.get(key(r), 0) + 1
    assert set(times) <= {key(r) for r in near} and max(times.values()) <= 2
    # Every token of the mix is packed once, in sequences without gaps.
    encoder = Encoder(vocabulary())
    total = sum(len(encoder(r.text or "")) // 4 + 1 for r in mixed)
    assert sum(r.length for r in packed) == total
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.Capacity().tokens
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r.length, r.ids_crc32) for r in whole.collect()) == sorted((r.length, r.ids_crc32) for r in packed)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
