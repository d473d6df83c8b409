from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from casework.llm import mixing

from .conftest import doc_rows


def filled(sizes: list[float], weights: list[float], share: float, most: float) -> list[float]:
    """Targets by the rule as stated: give by weight, stop at the limit, give the rest again."""
    targets, free, left = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while free and left > 1e-9:
        total = sum(weights[i] for i in free)
        over = {i for i in free if targets[i] + left * weights[i] / total >= most * sizes[i]}
        if not over:
            for i in free:
                targets[i] += left * weights[i] / total
            break
        level = left
        for i in over:
            left -= most * sizes[i] - targets[i]
            targets[i] = most * sizes[i]
        free -= over
        assert level >= left
    return targets


def test_targets_and_taken_words(docs):
    rows = mixing.mix_report(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by_source = defaultdict(int)
    for _, text, _, source, *_ in doc_rows():
        by_source[source] += size(text)
    names = sorted((s for s in by_source if s is not None), key=lambda s: s.encode()) + [None]
    want = dict(zip(names, filled([by_source[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2)))
    source_of = Counter()
    targets = {}
    for r in rows:
        targets.setdefault(r.source_size, r.target)
        source_of[r.source_size] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    assert len(rows) == len(doc_rows())
    for name in names:
        assert targets[by_source[name]] == pytest.approx(want[name])
    # The cut falls on a document of the source, so the words are near the target.
    for total, taken in source_of.items():
        assert abs(taken - targets[total]) <= max(r.size for r in rows if r.source_size == total) / 2 + 1


def test_repeats_agree_and_positions_rise_with_time(docs):
    first = sorted(mixing.mix_report(docs).collect(), key=repr)
    assert first == sorted(mixing.mix_report(docs.repartition(5)).collect(), key=repr)
    assert all(0 <= r.position <= 1 for r in first if r.copies)


def test_demand_is_inverted(spark):
    from pyspark.sql import functions as F

    plan = mixing.Curriculum()
    frame = spark.range(0, 101).select((F.col("id") / 100).alias("share"), F.lit(0).alias("cls"))
    got = [r.p for r in frame.select(mixing._position(plan, F.col("share"), "cls").alias("p")).collect()]

    def demand(t):
        done = 0.0
        for a, b, u, v in plan.segments(0):
            x = min(max(t - a, 0.0), b - a)
            done += u * x + (v - u) / (b - a) * x * x / 2
        return done / plan.integral(0)

    assert all(abs(demand(p) - i / 100) < 1e-9 for i, p in enumerate(got))


def test_mixed_documents_repeat_rows_and_keep_columns(docs):
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in mixing.mix_report(docs).collect())


def test_empty_table(no_docs):
    assert mixing.mix_report(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0
