from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from casework.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label string, code int, error string, ints int"


def brute(rows, plan):
    """Codes by plain search over all entries, in Python integers."""
    kept = [
        (i, [math.floor(x * plan.scale) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
    width = len(kept[0][1]) // plan.parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[: plan.entries]] for p in range(plan.parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))

    for _ in range(plan.rounds):
        found = [[nearest(v, p)[1] for p in range(plan.parts)] for _, v, _ in kept]
        for p in range(plan.parts):
            for k in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), codes in zip(kept, found) if codes[p] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    last = [[nearest(v, p) for p in range(plan.parts)] for _, v, _ in kept]
    errors = [sum(d for d, _ in row) for row in last]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(flat.encode()).hexdigest()
    return sorted(
        (
            (i, "".join(f"{k:02x}" for _, k in row), e, by_label[label], digest)
            for (i, _, label), row, e in zip(kept, last, errors)
        ),
        key=repr,
    )


def vector_rows():
    """Clusters, ties, repeated rows, a hot label and unusable vectors."""
    rng = random.Random(3)
    centres = [[rng.uniform(-1, 1) for _ in range(16)] for _ in range(5)]
    rows = []
    for i in range(300):
        c = rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, 0.1) for x in c], rng.choice(["hot", "hot", "a", None])))
    rows += [(300, rows[4][1], "a"), (4, rows[4][1], "b"), (301, [0.0] * 16, "a"), (302, [0.0] * 16, None)]
    rows += [(i, [round(x) / 2 for x in rows[i - 303][1]], "tie") for i in range(303, 360)]
    rows += [(400, None, "a"), (401, [math.nan] * 16, "a"), (402, [0.0] * 15 + [None], "a")]
    rows += [(403, [0.0] * 15 + [-math.inf], "a"), (None, [0.25] * 16, "a"), (-5, [-0.3] * 16, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", 2) for i, v, label in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("plan", [vc.ProductCodes(), vc.ProductCodes(parts=4, entries=7, rounds=2, scale=3)])
def test_equals_brute_force(spark, plan):
    rows = vector_rows()
    got = sorted((tuple(r) for r in vc.vector_codes(frame(spark, rows), plan).collect()), key=repr)
    assert got == brute(rows, plan)


def test_equals_sql(spark, tmp_path):
    rows = [r for r in vector_rows() if r[0] is not None and r[0] != 4]
    df = frame(spark, rows)
    df.write.parquet(str(tmp_path / "embeddings"))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings/*.parquet'")
        want = con.execute(vc.vector_codes_sql()).fetchall()
    got = [tuple(r) for r in vc.vector_codes(df).collect()]
    assert sorted(got) == sorted(want)


def test_orchard_equals_full_search_and_meets_fewer_entries():
    rng = np.random.default_rng(5)
    for _ in range(40):
        k, w = int(rng.integers(1, 17)), int(rng.integers(1, 9))
        # Few distinct values, so that ties and equal entries are common.
        entries, points = rng.integers(-4, 5, (k, w)), rng.integers(-4, 5, (200, w))
        distances = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
        code, best = vc.orchard(points, entries, *vc.neighbour_lists(entries))
        assert (code == distances.argmin(axis=1)).all()
        assert (best == distances.min(axis=1)).all()


def test_small_and_empty_tables(spark):
    few = [(i, [i / 7] * 8, None) for i in range(3)]
    got = sorted(tuple(r) for r in vc.vector_codes(frame(spark, few)).collect())
    assert got == brute(few, vc.ProductCodes())
    for rows in ([], [(1, None, "a")]):
        empty = vc.vector_codes(frame(spark, rows))
        assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and not empty.collect()


@pytest.mark.parametrize(
    "vectors, cause",
    [([[0.0] * 8, [0.0] * 16], "common codebook"), ([[0.0] * 12], "equal parts"), ([[1e300] + [0.0] * 7], "overflow")],
)
def test_refuses_what_has_no_codes(spark, vectors, cause):
    with pytest.raises(ValueError, match=cause):
        vc.vector_codes(frame(spark, [(i, v, "a") for i, v in enumerate(vectors)])).collect()
