from __future__ import annotations

import itertools
import math
import random
import re
import zlib

import pytest
from casework.llm import toxicity

from .conftest import doc_rows, sentence

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labelled(spark):
    """Invented insults of three stems with changing endings; the rest is clean."""
    rng = random.Random(3)
    docs, labels = [], []
    for doc in range(900):
        words = sentence(rng, rng.randint(20, 80)).split()
        toxic = doc % 6 == 0
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["zorgl", "quixp", "wumbl"]) + sentence(rng, 1))
        docs.append((doc, " ".join(words), "en", "s", 0))
        labels.append((doc, 1, int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
        spark.createDataFrame(labels, LABELS),
        {d: t for d, _, t in labels},
    )


def test_held_out_accuracy(labelled):
    docs, labels, truth = labelled
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_held_out_labels_are_not_read(labelled):
    docs, labels, _ = labelled
    flipped = labels.withColumn(
        "toxic",
        toxicity.F.when(toxicity.held_out("doc_id", 5), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")),
    )
    assert toxicity.learn(docs, labels) == toxicity.learn(docs, flipped)


def test_accepted_keeps_clean_documents(labelled):
    docs, labels, truth = labelled
    kept = {r.doc_id for r in toxicity.accepted(docs, labels).collect()}
    clean = {d for d, t in truth.items() if not t}
    assert len(clean - kept) <= 0.01 * len(clean)
    assert len(kept - clean) <= 0.05 * (len(truth) - len(clean))


def test_patterns_of_clauses():
    automaton = toxicity._automaton((("zorgl", 2.0), ("zorglob", 5.0)))
    find = lambda text: dict(zip(toxicity.PATTERNS, toxicity.patterns(text, automaton)))
    assert find("a Zorgler came")["asserted"] > 0
    assert find("you zorgle")["aimed"] > 0 and find("you zorgle")["asserted"] == 0
    assert find("that is not zorgle")["negated"] > 0
    assert find("she said zorgle")["reported"] > 0
    assert find("she said so. zorgle")["reported"] == 0
    assert find("I will kill you")["threat"] > 0 and find("I will kill it")["threat"] == 0
    assert find("overzorgle")["strongest"] == 0
    assert find("zorglobs")["strongest"] == 5.0
    assert set(find("").values()) == {0.0}


def _slow_patterns(text, stems):
    """Every clause and word looked at by hand, without a machine."""
    sums = dict.fromkeys(toxicity.PATTERNS, 0.0)
    for clause in re.split(r"[.!?;\n]", text.lower()):
        words = re.findall(r"[^\W_]+", clause)
        aimed = any(w in toxicity.TARGETS for w in words)
        for k, word in enumerate(words):
            known = [(len(x), w, False) for x, w in stems if word.startswith(x)]
            known += [(len(x), 1.0, True) for x in toxicity.THREATS if word.startswith(x)]
            if not known:
                continue
            _, weight, threat = max(known, key=lambda x: (x[0], not x[2]))
            denied = any(w in toxicity.NEGATIONS for w in words[max(0, k - 3) : k])
            told = any(w in toxicity.REPORTS for w in words[:k])
            if threat:
                sums["threat"] += weight * (aimed and not denied and not told)
            elif denied:
                sums["negated"] += weight
            elif told:
                sums["reported"] += weight
            else:
                sums["aimed" if aimed else "asserted"] += weight
                sums["strongest"] = max(sums["strongest"], weight)
    density = 1000.0 * (sums["asserted"] + sums["aimed"]) / (len(text.lower()) + 200)
    logs = [math.log1p(sums[x]) for x in toxicity.PATTERNS[:5]]
    return [*logs, sums["strongest"], math.log1p(density)]


def test_grammar_equals_clauses_read_by_hand():
    rng = random.Random(12)
    stems = (("zorgl", 2.0), ("zorglob", 5.0), ("kil", 1.5), ("you", 0.5), ("nev", 0.25))
    automaton = toxicity._automaton(stems)
    cues = ["you", "not", "never", "said", "dice", "du", "kill", "killing", "hurt", "zorgl", "zorglobs", "a", "wide", "x_zorgl"]
    for _ in range(3000):
        text = "".join(rng.choice(cues) + rng.choice([" ", " ", " ", " ", ", ", ". ", "\n", ";", "' "]) for _ in range(rng.randint(0, 40)))
        assert toxicity.patterns(text, automaton) == pytest.approx(_slow_patterns(text, stems)), text


def test_long_clauses_are_read_whole():
    automaton = toxicity._automaton((("zorgl", 2.0),))
    find = lambda text: dict(zip(toxicity.PATTERNS, toxicity.patterns(text, automaton)))
    far = " word" * 5000
    assert find(f"you{far} zorgl")["aimed"] > 0 and find(f"zorgl{far} you")["aimed"] > 0
    assert find(f"she said{far} zorgl")["reported"] > 0
    assert find(f"not{far} zorgl")["negated"] == 0


def test_isolated_words_do_not_count():
    automaton = toxicity._automaton((("zorgl", 2.0),))
    for text in ("that is not zorgle", "she said zorgle"):
        found = dict(zip(toxicity.PATTERNS, toxicity.patterns(text, automaton)))
        assert found["strongest"] == found["density"] == 0


def test_composition_reads_what_the_first_writes():
    both = toxicity.compose(toxicity.negation(), toxicity.target())
    for labels in itertools.product(toxicity.READ, repeat=5):
        one, two, state, by_hand, composed = toxicity.negation(), toxicity.target(), both.start, [], []
        first, second = one.start, two.start
        for label in labels:
            first, written = one.step(first, label)
            second, written = two.step(second, written)
            by_hand.append(written)
            state, written = both.step(state, label)
            composed.append(written)
        assert [both.end(state, x) for x in composed] == [two.end(second, one.end(first, x)) for x in by_hand]


def test_edge_rows(spark, docs, no_docs):
    none = spark.createDataFrame([], LABELS)
    some = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (2, None, None), (None, 1, 0), (60, 1, 0), (999, 1, 1)], LABELS)
    for labels in (none, some):
        rows = toxicity.toxicity(docs, labels).collect()
        assert len(rows) == len(doc_rows())
        assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    assert toxicity.accepted(docs, none).columns == docs.columns
    assert toxicity.accepted(docs, none).count() == len(doc_rows())
    assert toxicity.toxicity(no_docs, none).count() == 0
