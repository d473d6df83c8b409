"""Toxicity by a weighted finite-state pattern grammar.

Five transducers read the words of a clause. Insult and threat are one automaton
over characters: at the beginning of a word it writes a learned stem's label and
weight, or that of a threat. Negation, reported speech and target read these
labels and the clause's cue words: negation rewrites finds in the three words
after it, reported speech those after its verb, and target decides at the clause's
end whether what is left was aimed at someone. Composed, they are one machine
(``GRAMMAR``) that reads each word of a clause once and gives the weights of the
clause's patterns: insult asserted, aimed, negated or reported, and threat at a
target. A text's score is logistic in its clauses' patterns, so a word counts by
the clause it stands in, whatever the clause's length.

The insult stems are word beginnings learned from a bounded sample of labelled
rows (``sample`` of them, by the order of a hash): a stem is kept if its share of
toxic texts cannot be chance among all stems tried. Of nested stems the longest
one decides. The score's weights come from a third of the sample that the stems
were not learned on. Rows whose checksum of the id is divisible by ``folds`` are
never learned from. Only clauses with a find are read word by word.

Defined results: null and empty texts have no pattern and get the base score;
repeated rows get one score each; a row with several labels is toxic if one says
so; without labels of both kinds the score is the base rate, below one half; an
empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

import functools
import math
import re
from bisect import bisect_left
from collections.abc import Hashable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import ship, stage

# Function words of the languages at hand.
NEGATIONS = frozenset(
    "not no never none isn aren wasn don doesn nicht kein keine keinen nie niemals ne pas jamais aucun nunca jamás ni tampoco".split()
)
REPORTS = frozenset(
    "said says say wrote called calls quoted claims claimed sagte sagt schrieb nannte zitierte dit disait écrit appelé cité dijo dice escribió llamó citó".split()
)
TARGETS = frozenset(
    "you your yours yourself du dich dir dein deine euch toi vous votre vos tú ti tus vosotros usted ustedes".split()
)
THREATS = (
    "kill hurt destroy beat stab shoot töten umbringen verletzen vernichten tuer frapper détruire matar golpear destruir"
).split()

_CLAUSE_END = re.compile(r"[.!?;\n]")
_WORD = re.compile(r"[^\W_]+")
#: Words after a negation that it reaches.
SCOPE = 3
STEM_LENGTHS = range(3, 9)
#: Stems that a task counts before it passes their sums on.
HELD_STEMS = 100_000
PATTERNS = ("asserted", "aimed", "negated", "reported", "threat", "strongest", "density")


@dataclass(frozen=True)
class Learning:
    sample: int = 20_000
    folds: int = 5
    margin: float = 3.0
    ridge: float = 0.1


@dataclass(frozen=True)
class Model:
    """Stems with weights, and the weights of the patterns with the constant last."""

    stems: tuple[tuple[str, float], ...]
    weights: tuple[float, ...]


def held_out(doc_id: str, folds: int) -> Column:
    """True for the rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


# Labels that the words of a clause carry, and those that finds are rewritten to.
OTHER, NEGATION, REPORT, TARGET, INSULT, THREAT = "other", "negation", "report", "target", "insult", "threat"
NEGATED, REPORTED, AIMED, ASSERTED, IDLE = "negated", "reported", "aimed", "asserted", "idle"
READ = (OTHER, NEGATION, REPORT, TARGET, INSULT, THREAT)
CUES = {
    **dict.fromkeys(TARGETS, TARGET),
    **dict.fromkeys(REPORTS, REPORT),
    **dict.fromkeys(NEGATIONS, NEGATION),
}


@dataclass(frozen=True)
class Transducer:
    """A start state, arcs (state, label) -> (state, label written), and what the last state makes of the written labels.

    A label without an arc is written as it is read, and the state stays.
    """

    start: Hashable
    arcs: dict[tuple[Hashable, str], tuple[Hashable, str]]
    ends: dict[Hashable, dict[str, str]]

    def step(self, state: Hashable, label: str) -> tuple[Hashable, str]:
        return self.arcs.get((state, label), (state, label))

    def end(self, state: Hashable, label: str) -> str:
        return self.ends.get(state, {}).get(label, label)


def negation() -> Transducer:
    """The state counts the words that the last negation still reaches; finds in reach are denied."""
    arcs: dict[tuple[Hashable, str], tuple[Hashable, str]] = {}
    for left in range(SCOPE + 1):
        arcs[left, NEGATION] = (SCOPE, NEGATION)
        if left:
            arcs.update({(left, word): (left - 1, word) for word in (OTHER, REPORT, TARGET)})
            arcs.update({(left, INSULT): (left, NEGATED), (left, THREAT): (left, IDLE)})
    return Transducer(0, arcs, {})


def reported_speech() -> Transducer:
    """After a verb of speech the finds of the clause are someone's words."""
    return Transducer(
        False,
        {(False, REPORT): (True, REPORT), (True, INSULT): (True, REPORTED), (True, THREAT): (True, IDLE)},
        {},
    )


def target() -> Transducer:
    """Whether the clause names a target anywhere decides at its end what its finds are."""
    return Transducer(
        False, {(False, TARGET): (True, TARGET)}, {False: {INSULT: ASSERTED, THREAT: IDLE}, True: {INSULT: AIMED}}
    )


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The second reads what the first writes: one machine over the pairs of states that can be reached."""
    start = (first.start, second.start)
    arcs, ends, open_states = {}, {}, [start]
    while open_states:
        state = open_states.pop()
        # Labels that only the first one writes are carried through to the end.
        ends[state] = {x: second.end(state[1], first.end(state[0], x)) for x in (*READ, NEGATED, REPORTED, IDLE)}
        for label in READ:
            one, written = first.step(state[0], label)
            two, written = second.step(state[1], written)
            arcs[state, label] = ((one, two), written)
            if (one, two) not in ends and (one, two) not in open_states:
                open_states.append((one, two))
    return Transducer(start, arcs, ends)


GRAMMAR = compose(compose(negation(), reported_speech()), target())


@functools.lru_cache(maxsize=4)
def _automaton(stems: tuple[tuple[str, float], ...]):
    """Insult and threat: word beginnings with their length, label and weight."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for stem, weight in stems:
        found.add_word(stem, (len(stem), INSULT, weight))
    for stem in THREATS:
        if stem not in found:
            found.add_word(stem, (len(stem), THREAT, 1.0))
    found.make_automaton()
    return found


def clause_pattern(clause: str, finds: dict[int, tuple[int, str, float]], at: int = 0) -> list[tuple[str, float]]:
    """What the grammar makes of a clause's finds, given by their place in the text; the clause begins at ``at``."""
    state, written = GRAMMAR.start, []
    for word in _WORD.finditer(clause):
        find = finds.get(at + word.start())
        if find:
            state, label = GRAMMAR.step(state, find[1])
            written.append((label, find[2]))
        state, _ = GRAMMAR.step(state, CUES.get(word.group(), OTHER))
    return [(GRAMMAR.end(state, label), weight) for label, weight in written]


def patterns(text: str, automaton) -> list[float]:
    """Totals of the clause patterns of a text, on a log scale."""
    text = text.lower()
    finds: dict[int, tuple[int, str, float]] = {}
    for end, find in automaton.iter(text):
        start = end - find[0] + 1
        if start and text[start - 1].isalnum():
            continue
        if start not in finds or find[0] > finds[start][0]:
            finds[start] = find
    totals = dict.fromkeys((ASSERTED, AIMED, NEGATED, REPORTED, THREAT, IDLE), 0.0)
    strongest = 0.0
    cuts = [m.start() for m in _CLAUSE_END.finditer(text)] if finds else []
    read_to = -1
    for start in sorted(finds):
        if start < read_to:
            continue
        k = bisect_left(cuts, start)
        head = cuts[k - 1] + 1 if k else 0
        read_to = cuts[k] if k < len(cuts) else len(text)
        for label, weight in clause_pattern(text[head:read_to], finds, head):
            totals[label] += weight
            if label in (ASSERTED, AIMED):
                strongest = max(strongest, weight)
    density = 1000.0 * (totals[ASSERTED] + totals[AIMED]) / (len(text) + 200)
    logs = [math.log1p(totals[x]) for x in (ASSERTED, AIMED, NEGATED, REPORTED, THREAT)]
    return [*logs, strongest, math.log1p(density)]


def _stem_set(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return {w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n}


def _stem_counts(sample: DataFrame) -> DataFrame:
    """Texts and toxic texts per stem; each task sums its own rows first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(counts: dict[str, int], is_toxic: bool) -> pa.RecordBatch:
            values, zeros = pa.array(list(counts.values()), pa.int64()), pa.array([0] * len(counts), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), values if is_toxic else zeros, zeros if is_toxic else values],
                names=["stem", "toxic", "clean"],
            )

        counts: dict[bool, dict[str, int]] = {False: {}, True: {}}
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                into = counts[bool(label.as_py())]
                for stem in _stem_set(text.as_py() or ""):
                    into[stem] = into.get(stem, 0) + 1
                # Partial sums go on before they grow large; the aggregate adds them up.
                if len(into) > HELD_STEMS:
                    yield batch_of(into, into is counts[True])
                    into.clear()
        for is_toxic, rest in counts.items():
            if rest:
                yield batch_of(rest, is_toxic)

    rows = sample.select("text", "toxic").mapInArrow(count, "stem string, toxic long, clean long")
    return rows.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _learn_stems(sample: DataFrame, learning: Learning) -> tuple[tuple[str, float], ...]:
    totals = sample.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    toxic, n = totals["toxic"] or 0, totals["n"]
    if not toxic or toxic == n:
        return ()
    counts = stage(_stem_counts(sample), "toxic_stems")
    tried = counts.where("toxic + clean > 1").count()
    share, rate = F.col("toxic") / (F.col("toxic") + F.col("clean")), toxic / n
    gain = F.col("toxic") * F.log(share / rate) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - rate))
    ).otherwise(0.0)
    kept = (
        counts.where((F.col("toxic") > 0) & (share > rate))
        .withColumn("gain", gain)
        .where(F.col("gain") > math.log(max(tried, 1)) + learning.margin)
        .select("stem", "toxic", "clean")
        .collect()
    )
    weight = {
        r["stem"]: math.log((r["toxic"] + 0.5) / (r["clean"] + 0.5)) - math.log(rate / (1 - rate)) for r in kept
    }
    # A longer stem stays only if it says clearly more than a shorter one it begins with.
    chosen: dict[str, float] = {}
    for stem in sorted(weight, key=lambda s: (len(s), s)):
        shorter = [chosen[stem[:k]] for k in range(1, len(stem)) if stem[:k] in chosen]
        if weight[stem] > 0 and (not shorter or abs(weight[stem] - shorter[-1]) > 1.0):
            chosen[stem] = weight[stem]
    return tuple(sorted(chosen.items()))


def _fit(features: np.ndarray, labels: np.ndarray, ridge: float) -> np.ndarray:
    """Logistic weights with the constant last, by Newton steps."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (labels - p) - penalty * w
        )
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, learning: Learning = Learning()) -> Model:
    """Stems and pattern weights from a bounded sample of the labelled rows outside the held-out fold."""
    ship(docs.sparkSession)
    chosen = (
        labels.where(~held_out("doc_id", learning.folds) & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .withColumn("_order", F.xxhash64("doc_id"))
        .orderBy("_order", "doc_id")
        .limit(learning.sample)
    )
    # At most ``sample`` rows, so the broadcast is bounded.
    sample = stage(
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic", "_order")
        .agg(F.max("text").alias("text")),
        "toxic_sample",
    )
    part = F.pmod(F.shiftrightunsigned("_order", 8), F.lit(3))
    stems = _learn_stems(sample.where(part > 0), learning)
    rows = _pattern_rows(sample.where(part == 0), stems).collect()
    base = sample.agg(F.avg("toxic")).first()[0] or 0.0
    found = np.array([r["label"] for r in rows], dtype=float)
    if not len(found) or found.min() == found.max():
        low = min(max(base, 0.01), 0.49)
        return Model(stems, (*(0.0 for _ in PATTERNS), math.log(low / (1 - low))))
    weights = _fit(np.array([r["patterns"] for r in rows]), found, learning.ridge)
    return Model(stems, tuple(float(w) for w in weights))


def _pattern_rows(sample: DataFrame, stems: tuple[tuple[str, float], ...]) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(stems)
        for batch in batches:
            found = [patterns(t.as_py() or "", automaton) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found, pa.list_(pa.float64()))], names=["label", "patterns"]
            )

    return sample.select("text", F.col("toxic").cast("int")).mapInArrow(rows, "label int, patterns array<double>")


def score_text(text: str, automaton, weights: tuple[float, ...]) -> float:
    z = sum(w * f for w, f in zip(weights, [*patterns(text, automaton), 1.0], strict=True))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def with_score(docs: DataFrame, model: Model, column: str = "_score") -> DataFrame:
    """The documents with their score as one more column."""
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        automaton = _automaton(model.stems)
        return texts.fillna("").map(lambda t: score_text(t, automaton, model.weights)).astype("float64")

    return docs.withColumn(column, scored(F.col("text")))


def toxicity(docs: DataFrame, labels: DataFrame, learning: Learning = Learning()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = learn(docs, labels, learning)
    scored = with_score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out("doc_id", learning.folds).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, learning: Learning = Learning()) -> DataFrame:
    """The documents that are not predicted toxic, with their columns."""
    model = learn(docs, labels, learning)
    return with_score(docs, model, "__toxic_score").where(F.col("__toxic_score") < 0.5).select(*docs.columns)
