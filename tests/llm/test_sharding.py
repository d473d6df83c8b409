from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

import pytest
from casework.llm import sharding
from pyspark.sql import functions as F

from .conftest import doc_rows, sentence


@pytest.mark.parametrize(("n", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, n, bits):
    cells = list(itertools.product(range(1 << bits), repeat=n))
    names = [f"c{i}" for i in range(n)]
    frame = spark.createDataFrame(cells, ", ".join(f"{c} int" for c in names))
    walk = frame.select("*", sharding.hilbert_index([F.col(c) for c in names], bits).alias("h")).orderBy("h").collect()
    assert [r.h for r in walk] == list(range(len(cells)))
    for a, b in itertools.pairwise(walk):
        assert sum(abs(a[c] - b[c]) for c in names) == 1


def check(rows, docs, layout):
    shards = defaultdict(list)
    by_id = {}
    for r in rows:
        shards[r.shard].append(r)
        by_id.setdefault(r.doc_id, r)
    for part in shards.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    total = sum(r.size for r in rows)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < layout.shards
    return {s: sum(r.size for r in part) for s, part in shards.items()}, total


def test_sizes_slots_and_groups(spark):
    import random

    rng = random.Random(6)
    rows = [(i, sentence(rng, rng.randint(5, 60)), rng.choice("ab"), rng.choice("xyz")) for i in range(2000)]
    copies = {}
    for k, n in enumerate((2, 5, 20, 90, 1500)):
        text = sentence(rng, 30)
        copies[text] = n
        rows += [(10_000 * (k + 1) + i, text, rng.choice("ab"), rng.choice("xyz")) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    layout = sharding.Layout(shards=10)
    found = sharding.shard(frame, layout).collect()
    sizes, total = check(found, rows, layout)
    assert len(sizes) == 10
    assert max(sizes.values()) < 1.06 * total / 10 and min(sizes.values()) > 0.94 * total / 10
    text_of = {r[0]: r[1] for r in rows}
    placed = defaultdict(set)
    for r in found:
        placed[text_of[r.doc_id]].add(r.shard)
        assert r.size == len(text_of[r.doc_id].encode()) + 16
        assert r.text_crc32 == zlib.crc32(text_of[r.doc_id].encode())
    for text, n in copies.items():
        whole = n * (len(text.encode()) + 16) <= total / 10
        assert not whole or len(placed[text]) == 1
    assert all(len(s) == 1 for t, s in placed.items() if t not in copies)


def test_shards_prune_by_every_dimension(spark):
    """A shard holds few of the values of each dimension."""
    rows = [(i, "word " * (1 + (i * 7) % 300), "abcdefgh"[i % 8], f"s{i % 16:02}") for i in range(4096)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = sharding.shard(frame, sharding.Layout(shards=32)).collect()
    langs = defaultdict(set)
    for r in found:
        langs[r.shard].add(rows[r.doc_id][2])
    assert sum(len(v) for v in langs.values()) / len(langs) <= 5


def test_edge_rows(docs, no_docs):
    layout = sharding.Layout()
    rows = sharding.shard(docs, layout).collect()
    assert len(rows) == len(doc_rows())
    check(rows, None, layout)
    empty = next(r for r in rows if r.doc_id == 60)
    assert empty.size == 16 and empty.text_crc32 == 0
    assert sharding.shard(no_docs, layout).count() == 0
    assert sorted(map(repr, sharding.shard(docs.repartition(5), layout).collect())) == sorted(map(repr, rows))
