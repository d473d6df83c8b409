from __future__ import annotations

import numpy as np
from casework.llm import vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, n_links int, _cell int"


def brute(rows):
    def sound(e, label):
        return label is not None and e is not None and len(e) > 0 and all(x is not None and np.isfinite(x) for x in e) and any(e)

    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i][:3], rows[j][:3]
            if sound(a, la) and sound(b, lb) and la == lb and len(a) == len(b):
                x, y = np.array(a, dtype=float), np.array(b, dtype=float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    smallest = {}
    for i in range(n):
        if rows[i][0] is not None:
            smallest[find(i)] = min(smallest.get(find(i), rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], links[i], smallest.get(find(i)), rows[i][0] == smallest.get(find(i))) for i in range(n)), key=repr)


def vector_rows(n: int):
    """A dense group, small groups, copies, and vectors that link with nothing."""
    rng = np.random.default_rng(4)
    rows, doc = [], 0

    def add(vector, label):
        nonlocal doc
        rows.append((doc, None if vector is None else [float(np.float32(v)) for v in vector], label))
        doc += 1

    for label in (1, 2):
        for _ in range(n):
            add(rng.standard_normal(32), label)
    centre = rng.standard_normal(32)
    for _ in range(n):
        add(centre + 0.1 * rng.standard_normal(32), 1)
    for _ in range(n // 4):
        x = rng.standard_normal(32)
        for _ in range(3):
            add(x + 0.12 * rng.standard_normal(32), 2)
    for _ in range(12):
        add(centre, 1)
    add(centre, 2)
    add(centre, None)
    add(None, 1)
    add([0.0] * 32, 1)
    add([float("nan")] * 32, 1)
    add([float("inf")] + [1.0] * 31, 1)
    add([1.0, 2.0], 1)
    add([2.0, 4.0], 1)
    add([], 1)
    rows.append((5, rows[5][1], rows[5][2]))
    rows.append((None, rows[6][1], rows[6][2]))
    rows.append((doc + 1, [None, *rows[6][1][1:]], 1))
    return rows


def result(frame, index):
    rows = vector_dedup.vector_classes(frame, index).collect()
    return sorted(((r.vec_id, r.n_links, r.component_id, bool(r.kept)) for r in rows), key=repr)


def test_equals_brute_force(spark):
    rows = vector_rows(60)
    frame = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)
    want = brute(rows)
    for index in (vector_dedup.PivotIndex(), vector_dedup.PivotIndex(pivots=64, tile=8)):
        got = result(frame, index)
        found, true = sum(r[1] for r in got), sum(r[1] for r in want)
        assert len(got) == len(want)
        assert 0.99 * true <= found <= true
        if found == true:
            assert got == want


def test_empty_table(spark):
    assert vector_dedup.vector_classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pair_counts_in_one_cell_only():
    """Rows that share a smaller pivot outside the cell are another cell's pair."""
    x = np.array([[1.0, 0.0], [1.0, 0.01], [1.0, 0.02]])
    run = {
        "x": x,
        "side": np.zeros(3, dtype=int),
        "copies": np.array([1, 2, 4]),
        "mask": np.array([[1], [1], [0]]),
        "same": True,
    }
    rows, links, roots = vector_dedup._compare(run, 0.98)
    assert rows.tolist() == [0, 1, 2] and links.tolist() == [4, 4, 3] and set(roots.tolist()) == {0}
