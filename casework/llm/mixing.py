"""Mixing sources to target weights as a time-varying curriculum.

Each source has a weight schedule over training time 0 to 1, linear between
knots. Its integral is the source's weight in the mix; the target in words
follows from it by raising a common level until the demand is met, where no
target may exceed ``repeats`` times its source (the excess goes to the other
sources by weight). The cumulative demand of a source is its target times the
integral up to a time, and inverting it at a document's place among the words
of its source gives the document's training position. Documents are then
range-sorted by position.

Whole documents are taken. Their order within a source is a hash of the row,
behind the few documents above ``coarse`` of the source, so that the cut falls
on a small one.

Defined results: null text and text without words have size 0; a null source
is a source of its own, ordered last; repeated rows are taken alike; a source
without words has target 0 and nothing of it is taken; an empty table gives an
empty table. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import key_columns, range_totals, running_totals, stage

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Curriculum:
    """Times from 0 to 1 and, per time, the weights that sources take in turn."""

    times: tuple[float, ...] = (0.0, 0.5, 1.0)
    weights: tuple[tuple[float, ...], ...] = ((3.6, 0.8, 1.6), (3.0, 1.0, 2.0), (2.4, 1.2, 2.4))
    share: float = 1.5
    repeats: int = 2
    coarse: float = 0.005
    buckets: int = 1024

    @property
    def cycle(self) -> int:
        return len(self.weights[0])

    def segments(self, k: int) -> list[tuple[float, float, float, float]]:
        """Start, end and weights there of each piece of the k-th schedule."""
        return [
            (self.times[i], self.times[i + 1], self.weights[i][k], self.weights[i + 1][k])
            for i in range(len(self.times) - 1)
        ]

    def integral(self, k: int) -> float:
        return round(sum((b - a) * (u + v) / 2 for a, b, u, v in self.segments(k)), 12)


def word_count(text: str) -> Column:
    """Number of words of a text column; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _by_class(class_column: str, values: list[Column]) -> Column:
    out = values[-1]
    for k in reversed(range(len(values) - 1)):
        out = F.when(F.col(class_column) == k, values[k]).otherwise(out)
    return out


def _position(plan: Curriculum, demand_share: Column, class_column: str) -> Column:
    """Time at which the cumulative demand reaches a share of the target."""
    choices = []
    for k in range(plan.cycle):
        total, done, out = plan.integral(k), 0.0, F.lit(plan.times[-1])
        pieces = []
        for a, b, u, v in plan.segments(k):
            area, slope = (b - a) * (u + v) / 2, (v - u) / (b - a)
            rest = F.greatest(demand_share * total - done, F.lit(0.0))
            root = F.sqrt(F.greatest(F.lit(u * u) + 2 * slope * rest, F.lit(0.0)))
            pieces.append((done + area, F.lit(a) + F.when(u + root > 0, 2 * rest / (u + root)).otherwise(0.0)))
            done += area
        for end, time in reversed(pieces):
            out = F.when(demand_share * total <= end, time).otherwise(out)
        choices.append(F.least(out, F.lit(plan.times[-1])))
    return _by_class(class_column, choices)


def source_targets(sizes: DataFrame, plan: Curriculum) -> DataFrame:
    """Per source: class in the weight cycle, weight, size and target in words.

    ``sizes`` has ``_source`` and ``source_size``. The level is raised step by step;
    each step is one aggregate over the sources and settles at least one of them.
    """
    ranked = range_totals(sizes.withColumn("_one", F.lit(1)), ["_source"], ["_one"], "mix_sources")
    weighed = stage(
        ranked.withColumn("_class", F.pmod(F.col("_one_before"), F.lit(plan.cycle)))
        .withColumn("weight", _by_class("_class", [F.lit(plan.integral(k)) for k in range(plan.cycle)]))
        .withColumn("_most", (F.col("source_size") * plan.repeats).cast("double"))
        .drop("_one", "_one_before"),
        "mix_weights",
    )
    level, settled = 0.0, None
    while True:
        free = F.col("weight") * level < F.col("_most")
        row = weighed.agg(
            F.sum(F.when(free, F.col("weight"))).alias("weight"),
            F.sum(F.when(free, F.lit(0.0)).otherwise(F.col("_most"))).alias("fixed"),
            F.sum("source_size").alias("words"),
            F.count(F.when(free, 1)).alias("n"),
        ).first()
        if not row["weight"] or row["n"] == settled:
            break
        settled = row["n"]
        level = (plan.share * row["words"] - row["fixed"]) / row["weight"]
    return weighed.withColumn("target", F.least(F.col("weight") * level, F.col("_most")))


def mix(docs: DataFrame, plan: Curriculum = Curriculum(), doc_id="doc_id", text="text", source="source") -> DataFrame:
    """One row per document: what the mix takes of it and when it is first seen.

    Columns: the row's key ``_k1 _k2``, ``doc_id size source_size target copies taken
    position positions``; ``positions`` holds one training position per copy.
    """
    narrow = docs.select(
        *key_columns(doc_id, text, source),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("~")).alias("_source"),
        word_count(text).alias("_words"),
    )
    units = stage(
        narrow.groupBy("_k1", "_k2", "doc_id", "_source", "_words")
        .agg(F.count("*").alias("_rows"))
        .withColumn("size", F.col("_words") * F.col("_rows"))
        .withColumn("_bucket", F.pmod(F.shiftrightunsigned("_k1", 20), F.lit(plan.buckets))),
        "mix_units",
    )
    parts = stage(units.groupBy("_source", "_bucket").agg(F.sum("size").alias("_part_size")), "mix_parts")
    targets = source_targets(parts.groupBy("_source").agg(F.sum("_part_size").alias("source_size")), plan)
    known = units.join(parts.select("_source", "_bucket").join(targets, "_source"), ["_source", "_bucket"])
    # Documents above the coarse share come first: at most 1 / coarse of a source.
    ordered = known.withColumn(
        "_bucket",
        F.when(F.col("size") > plan.coarse * F.col("source_size"), -1).otherwise(F.col("_bucket")),
    )
    placed = running_totals(ordered, ["_source"], "_bucket", ["_k1", "_k2", "doc_id"], ["size"])
    full = F.floor(F.col("target") / F.col("source_size"))
    rest = F.col("target") - full * F.col("source_size")
    middle = F.col("size_before") + F.col("size") / 2
    copies = F.when(F.col("source_size") > 0, full + F.when(middle < rest, 1).otherwise(0)).otherwise(0)
    timed = placed.withColumn("copies", copies.cast("int")).withColumn(
        "_shares",
        F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(plan.repeats)), lambda e: e < F.col("copies")),
            lambda e: (middle + e * F.col("source_size")) / F.col("target"),
        ),
    )
    timed = timed.withColumn("positions", F.transform("_shares", lambda s: _position(plan, F.least(s, F.lit(1.0)), "_class")))
    return timed.select(
        "_k1",
        "_k2",
        "doc_id",
        "_rows",
        F.col("_words").alias("size"),
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("_words")).alias("taken"),
        F.get("positions", F.lit(0)).alias("position"),
        "positions",
    )


def mix_report(docs: DataFrame, plan: Curriculum = Curriculum()) -> DataFrame:
    """Every document with what the mix takes of it, range-sorted by its first position."""
    rows = mix(docs, plan).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))))
    return (
        rows.select("doc_id", "size", "source_size", "target", "taken", "copies", "position")
        .repartitionByRange("position", "doc_id")
        .sortWithinPartitions("position", "doc_id")
    )


def mixed_documents(docs: DataFrame, plan: Curriculum = Curriculum()) -> DataFrame:
    """The documents that the mix takes, a row per copy, range-sorted by training position."""
    taken = mix(docs, plan).where("copies > 0").select("_k1", "_k2", "positions")
    keyed = docs.select(*key_columns("doc_id", "text", "source"), F.struct(*docs.columns).alias("_doc"))
    return (
        keyed.join(taken, ["_k1", "_k2"])
        .select("_doc", F.explode("positions").alias("_position"), "_k1")
        .repartitionByRange("_position", "_k1")
        .sortWithinPartitions("_position", "_k1")
        .select("_doc.*")
    )
