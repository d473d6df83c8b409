from __future__ import annotations

import hashlib
import random
from collections import Counter

import xxhash
from casework.llm import fingerprints as fp

from .conftest import doc_rows, text_of


def test_rows_follow_falling_ids(some_docs):
    rng = random.Random(8)
    rows = [(rng.randrange(10**12), text_of(rng, rng.randint(1, 5))) for _ in range(300)] + [(-5, ""), (3, None)]
    got = {r.doc_id: r for r in fp.fingerprints(some_docs(rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for k, (doc, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[doc]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fp.fingerprint(text) and r.edited_fingerprint == fp.fingerprint(edited)
        assert r.near_edited == fp.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.edited_lines == "" or r.near_edited < 1.0
        changed = {n for a, b in (x.split("-") for x in r.edited_lines.split()) for n in range(int(a), int(b) + 1)}
        old = Counter(text.split("\n"))
        assert changed >= {n for n, x in enumerate(edited.split("\n")) if x not in old}
        assert r.near_next == fp.likeness(r.fingerprint, fp.fingerprint(following))


def test_hot_and_null_ids(some_docs):
    rng = random.Random(9)
    rows = [(7, text_of(rng, 2)) for _ in range(120)] + [(None, text_of(rng, 2)) for _ in range(60)] + [(9, "x"), (5, "y")]
    got = fp.fingerprints(some_docs(rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in rows)
    assert Counter(r.fingerprint for r in got) == Counter(fp.fingerprint(t) for _, t in rows)
    # Every row is followed by exactly one other: the likenesses come from one cycle.
    halves = sorted(r.edited_sha256 for r in got)
    assert len(set(halves)) == len(halves)


def test_edges(docs, no_docs, some_docs):
    assert len(fp.fingerprints(docs).collect()) == len(doc_rows())
    assert fp.fingerprints(no_docs).count() == 0
    (one,) = fp.fingerprints(some_docs([(1, "only one. here")])).collect()
    assert one.near_next == 1.0


def test_roots_and_branches():
    rng = random.Random(1)
    text = text_of(rng, 30)
    lines = text.split("\n")
    assert fp.likeness(fp.fingerprint(text), fp.fingerprint(text)) == 1.0
    lines[17] = "Changed."
    other = fp.fingerprint("\n".join(lines))
    assert fp.fingerprint(text).split(":")[0] != other.split(":")[0]
    assert fp.differing_paragraphs(other, fp.fingerprint(text)) == [17]
    assert 0.9 < fp.likeness(fp.fingerprint(text), other) < 1.0
    assert fp.likeness(fp.fingerprint(text), fp.fingerprint(text_of(rng, 30))) < 0.05
    assert fp.likeness(fp.fingerprint(""), fp.fingerprint("")) == 1.0
    assert fp.likeness(fp.fingerprint(""), fp.fingerprint("a")) == 0.0
    # A line break is part of the text.
    assert fp.fingerprint("a\nb").split(":")[0] != fp.fingerprint("ab").split(":")[0]


class Tree:
    """A tree of nodes built and compared by recursion, without the fingerprint's text."""

    def __init__(self, children, content=b""):
        self.children = children
        self.digest = xxhash.xxh3_128_digest(b"".join(c.digest for c in children) if children is not None else content)

    def leaves(self):
        return [self.digest] if self.children is None else [x for c in self.children for x in c.leaves()]


def tree_of(text):
    sections = [[]]
    for line in text.split("\n"):
        paragraph = Tree([Tree(None, piece.encode()) for piece in fp.leaves_of(line)])
        sections[-1].append(paragraph)
        if paragraph.digest[-1] % fp.SECTION == 0:
            sections.append([])
    return Tree([Tree(s) for s in sections if s])


def slow_likeness(one, other):
    """Leaves in common, branches of equal digest first, level by level."""
    if one.digest == other.digest:
        return 1.0
    size = len(one.leaves()) + len(other.leaves())
    common, left, right = 0, [one], [other]
    while left and left[0].children is not None:
        left, right = [c for n in left for c in n.children], [c for n in right for c in n.children]
        for node in list(left):
            twin = next((x for x in right if x.digest == node.digest), None)
            if twin:
                left.remove(node)
                right.remove(twin)
                common += len(node.leaves())
    return 2.0 * common / size if size else 1.0


def test_equals_a_tree_of_nodes():
    rng = random.Random(17)
    pool = text_of(rng, 25).split("\n") + ["", "", "a, b, c", "长" * 300, " ".join(text_of(rng, 12).replace(".", "").split())]
    for _ in range(400):
        lines = [rng.choice(pool) for _ in range(rng.randint(1, 20))]
        other = [x if rng.random() < 0.8 else rng.choice(pool) for x in lines]
        if rng.random() < 0.5:
            other.insert(rng.randrange(len(other) + 1), "One more, here.")
        one, two = "\n".join(lines), "\n".join(other)
        first, second = fp.fingerprint(one), fp.fingerprint(two)
        assert first.split(":")[0] == tree_of(one).digest.hex()
        assert fp.likeness(first, second) == slow_likeness(tree_of(one), tree_of(two))
        assert fp.likeness(first, second) == fp.likeness(second, first)


def test_long_clauses_are_cut_by_content():
    rng = random.Random(18)
    for long in (" ".join(text_of(rng, 80).replace(".", "").split()), "".join(rng.choice("的一是不了人我在有他这") for _ in range(4000))):
        assert "".join(fp.pieces(long)) == long and len(fp.pieces(long)) > 20
        assert all(len(p) >= fp.PIECE for p in fp.pieces(long))
        # An insertion at the front moves all places; the pieces behind it stay.
        assert fp.likeness(fp.fingerprint(long), fp.fingerprint("new words " + long)) > 0.9
    assert fp.pieces("a" * 500) == ["a" * 500] or set(map(len, fp.pieces("a" * 500)[:-1])) == {fp.PIECE}


def test_comparison_opens_differing_branches_only():
    rng = random.Random(19)
    lines = text_of(rng, 60).split("\n")
    other = [*lines[:30], "Changed.", *lines[31:]]
    mine, theirs = fp._opened(fp.fingerprint("\n".join(other)), fp.fingerprint("\n".join(lines)))
    assert [n for n, _ in mine] == [30] == [n for n, _ in theirs]
    assert fp.spans([1, 2, 3, 7, 9, 10]) == [(1, 3), (7, 7), (9, 10)]
