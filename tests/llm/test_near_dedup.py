from __future__ import annotations

import random
import re

import numpy as np
import pytest
from casework.llm import near_dedup
from casework.llm.components import components
from test_relational import _shuffled_rows

from .conftest import doc_rows, sentence


def labelled(text):
    words = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
    seen, out = {}, []
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
        out.append((g, seen[g]))
    return out


def similarity(a, b):
    """Longest common subsequence of the labelled k-mers over all of them."""
    if not a and not b:
        return 1.0
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b, 1):
            row[j] = before[j - 1] + 1 if x == y else max(row[j - 1], before[j])
    return row[-1] / (len(a) + len(b) - row[-1])


def brute_classes(rows):
    grams = [labelled(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            small, large = sorted((len(grams[i]), len(grams[j])))
            if (large == 0 or small / large >= 0.8) and find(i) != find(j) and similarity(grams[i], grams[j]) >= 0.8:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return {tuple(sorted(g, key=repr)) for g in groups.values()}


def family_rows():
    """Families of edited copies with few to many edits, and unrelated texts."""
    rng = random.Random(5)
    rows, doc = [], 0
    for size in (1, 1, 1, 2, 3, 12, 25):
        base = sentence(rng, rng.randint(60, 140)).split()
        for k in range(size):
            words = base[:]
            for _ in range(rng.randint(0, 5) if k else 0):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], [sentence(rng, 1)], [words[at], sentence(rng, 1)], [words[at] + "."]])
            rows.append((doc, " ".join(words)))
            doc += 1
    return rows


def test_classes_equal_brute_force(some_docs):
    rows = family_rows()
    got = {}
    for r in near_dedup.class_report(some_docs(rows)).collect():
        got.setdefault(r.class_id, []).append(r.doc_id)
        assert r.kept == (r.doc_id == r.class_id)
    assert all(k == min(v) for k, v in got.items())
    assert {tuple(sorted(v, key=repr)) for v in got.values()} == brute_classes(rows)


def test_edge_rows(docs, no_docs):
    rows = near_dedup.class_report(docs).collect()
    assert len(rows) == len(doc_rows())
    classes = {}
    for r in rows:
        classes.setdefault(r.class_id, []).append(r.doc_id)
    assert sorted(classes[60], key=repr) == sorted([60, 61, None, 66], key=repr)
    assert sorted(classes[3]) == [3, 62, 63]
    assert classes[65] == [65, 65]
    one = near_dedup.one_per_class(docs)
    assert one.columns == docs.columns
    # Id 64 has two texts, so two classes have that id.
    assert one.count() == len(classes) + 1
    assert near_dedup.class_report(no_docs).count() == 0
    assert near_dedup.one_per_class(no_docs).count() == 0


def test_sketches_follow_order():
    """Texts with the same k-mers in another order share fewer sketch values."""
    rng = random.Random(2)
    base = [sentence(rng, 30) for _ in range(10)]
    texts = [" ".join(base), " ".join(base[5:] + base[:5])]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    plan = near_dedup.OrderMinHash(sketches=200)
    a, b = near_dedup.sketches(*near_dedup.kmers(data, np.cumsum([len(t) for t in texts]), 5), plan)
    shared = set(labelled(texts[0])) & set(labelled(texts[1]))
    jaccard = len(shared) / (len(labelled(texts[0])) + len(labelled(texts[1])) - len(shared))
    assert (a == b).mean() < 0.8 * jaccard


@pytest.mark.parametrize("edits", [0, 1, 4, 9, 30])
def test_alignment_equals_longest_common_subsequence(edits):
    rng = random.Random(edits)
    words = sentence(rng, 200).split()
    other = words[:]
    for _ in range(edits):
        other[rng.randrange(len(other))] = sentence(rng, 1)
    if edits == 9:
        other = other[40:] + other[:40]
    texts = [" ".join(words), " ".join(other)]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    _, hashes, _, at = near_dedup.kmers(data, np.cumsum([len(t) for t in texts]), 5)
    found = near_dedup.aligned_similarity(hashes[: at[1]], hashes[at[1] :], 0.8)
    want = similarity(labelled(texts[0]), labelled(texts[1]))
    assert found == pytest.approx(want if want >= 0.8 else 0.0)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 470)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


def chained_rows():
    """Chains in which each text is near the next, and far from most of the others."""
    rng = random.Random(21)
    rows = []
    for chain in range(2):
        words = sentence(rng, 80).split()
        for k in range(30):
            rows.append((100 * chain + k, " ".join(words)))
            for _ in range(1):
                words[rng.randrange(len(words))] = sentence(rng, 1)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("plan", [near_dedup.OrderMinHash(), near_dedup.OrderMinHash(leaders=1, tile=4)])
def test_chains_stay_whole(some_docs, plan):
    """Texts that are linked only to texts already joined to a leader, in whole and in many tiles."""
    rows = chained_rows()
    got = {}
    for r in near_dedup.class_report(some_docs(rows), plan).collect():
        got.setdefault(r.class_id, []).append(r.doc_id)
    assert {tuple(sorted(v, key=repr)) for v in got.values()} == brute_classes(rows)


def test_shared_counts():
    rng = np.random.default_rng(4)
    texts = [rng.choice(60, size=n, replace=False).astype("<u4") for n in (1, 9, 30, 45, 60)]
    left, right = np.array([0, 2, 4]), np.array([1, 3])
    got = near_dedup.shared_counts(texts, left, right, width=7)
    assert got.tolist() == [[len(np.intersect1d(texts[a], texts[b])) for b in right] for a in left]


def brute_jaccard_links(texts, least):
    sets = {k: set(v) for k, v in texts.items()}
    keys = sorted(sets)
    return {
        (a, b)
        for i, a in enumerate(keys)
        for b in keys[:i]
        if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])
    }


@pytest.mark.parametrize("tile, few", [(2, 0), (128, 0), (8, 2), (128, 8), (128, 100)])
def test_every_near_pair_is_paired_or_meets_in_a_tile(spark, monkeypatch, tile, few):
    """All pairs of at least 0.8 in different components, whichever way their k-mers take."""
    monkeypatch.setattr(near_dedup, "FEW", few)
    rng = random.Random(tile + few)
    plan = near_dedup.OrderMinHash(tile=tile)
    texts = {}
    for family in range(6):
        base = rng.sample(range(10_000), rng.randint(5, 60))
        for k in range(12):
            kept = [x for x in base if rng.random() > 0.08]
            texts[bytes([family, k])] = np.array(kept + rng.sample(range(10_000), rng.randint(0, 6)) or [1], dtype="<u4")
    rows = [(k, len(v), bytes([i % 5]), v.tobytes(), i) for i, (k, v) in enumerate(texts.items())]
    df = spark.createDataFrame(rows, "text_key binary, n long, component binary, kmers binary, _id long")
    prefixes = near_dedup._prefixes(df.select("text_key", "n", "component", "_id"), df.select("text_key", "kmers"), plan)
    lists = near_dedup._lists(prefixes, plan)
    sides = {}
    for r in near_dedup._tiles(lists, plan).collect():
        sides.setdefault((r._value, r._tile), ([], []))[r._side].append(bytes(r.text_key))
    paired = {tuple(sorted((bytes(r.a), bytes(r.b)), reverse=True)) for r in near_dedup._few_pairs(lists, plan).collect()}
    met = paired | {tuple(sorted((a, b), reverse=True)) for left, right in sides.values() for a in left for b in right if a != b}
    component = {k: i % 5 for i, k in enumerate(texts)}
    near = {p for p in brute_jaccard_links(texts, 0.8) if component[p[0]] != component[p[1]]}
    assert near and near <= met


def unlinked_group(spark, n):
    """``n`` texts that share two thirds of their k-mers and have the others alone."""
    common = list(range(100))
    rows = [
        (i.to_bytes(4, "big"), 150, i.to_bytes(4, "big"), np.array(common + [1000 + 50 * i + j for j in range(50)], dtype="<u4").tobytes(), i)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "text_key binary, n long, component binary, kmers binary, _id long")


def test_rows_grow_with_a_group_of_unlinked_texts(spark):
    plan, counts = near_dedup.OrderMinHash(), []
    for n in (512, 1024, 2048):
        df = unlinked_group(spark, n)
        prefixes = near_dedup._prefixes(df.select("text_key", "n", "component", "_id"), df.select("text_key", "kmers"), plan)
        lists = near_dedup._lists(prefixes, plan)
        counts.append(near_dedup._tiles(lists, plan).count() + near_dedup._few_pairs(lists, plan).count())
    assert counts[2] <= 2.2 * counts[1] + 100 and counts[1] <= 2.2 * counts[0] + 100


def test_only_texts_that_may_have_near_ones_are_shuffled(spark, some_docs):
    plan, rng = near_dedup.OrderMinHash(), random.Random(5)
    docs = some_docs([(i, sentence(rng, 12)) for i in range(3000)])
    rows = near_dedup._sketch_table(docs, plan)
    wanted = rows.where("doc_id % 300 = 0").select("text_key", *near_dedup.KEY).localCheckpoint()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = near_dedup._labelled_kmers(docs, wanted, plan)
        executed = found._jdf.queryExecution().executedPlan()
        kept = {bytes(r.text_key) for r in found.collect()}
        assert kept == {bytes(r.text_key) for r in wanted.collect()} and len(kept) == 10
        assert _shuffled_rows(executed) < 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
