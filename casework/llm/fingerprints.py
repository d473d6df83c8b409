"""Document fingerprints: a Merkle tree over clauses, paragraphs and sections.

A paragraph is a line, its leaves are clauses (up to punctuation; a clause of more
than ``CLAUSE`` characters is cut by its content), and a section ends after a
paragraph whose digest is divisible by ``SECTION``, so cuts depend on nearby text
only and an edit changes few branches. A node's digest is the hash of its
children's; the root tests equality. The fingerprint is the tree itself: the root,
then every section, paragraph and leaf with its digest, shortened.

Two trees are compared from the root down. Equal roots end it. Of differing ones
the children are matched by digest, equal branches count whole and are not looked
into, and only the rest is opened: sections, then paragraphs, then leaves. The
paragraphs opened are where the texts differ.

Defined results: null is the empty text; two empty texts have likeness 1; a
document is followed by the one with the next lower id, the last by the first;
rows of one id are ordered by a hash of the text and null ids come last; an
empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import ship

#: Characters from which a clause is cut, least characters of a piece, and one of how many places is a cut.
CLAUSE, PIECE, PLACES = 96, 16, 48
SECTION = 4
_CLAUSES = re.compile(r"[^.,;:!?]+[.,;:!?]*|[.,;:!?]+")
#: Hex digits of a leaf's, a paragraph's and a section's digest.
LEAF, NODE, BRANCH = 8, 16, 16
#: Odd multipliers of the four characters before a cut.
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def pieces(clause: str) -> list[str]:
    """A long clause cut where the four characters before say so, whatever stands further off."""
    if len(clause) <= CLAUSE:
        return [clause]
    codes = np.frombuffer(clause.encode("utf-32-le"), dtype=np.uint32)
    mixed = sum(codes[k : len(codes) - 3 + k] * _MIX[k] for k in range(4))
    out, start = [], 0
    for cut in (np.flatnonzero((mixed >> 15) % PLACES == 0) + 4).tolist():
        if cut - start >= PIECE and len(clause) - cut >= PIECE:
            out.append(clause[start:cut])
            start = cut
    return [*out, clause[start:]]


def leaves_of(line: str) -> list[str]:
    return [piece for clause in _CLAUSES.findall(line) for piece in pieces(clause)]


def fingerprint(text: str) -> str:
    """Root, ``:``, sections joined by ``/``. A section is its digest and paragraphs, each after a ``.``;
    a paragraph is its digest and its leaves' digests, of fixed widths."""
    digest = xxhash.xxh3_128_digest
    sections, paragraphs, members, marks = [], [], [], []

    def close() -> None:
        mark = digest(b"".join(members))
        sections.append(".".join([mark.hex()[:BRANCH], *paragraphs]))
        marks.append(mark)
        paragraphs.clear()
        members.clear()

    for line in text.split("\n"):
        leaves = [digest(piece) for piece in leaves_of(line)]
        node = digest(b"".join(leaves))
        paragraphs.append(node.hex()[:NODE] + "".join([leaf[: LEAF // 2].hex() for leaf in leaves]))
        members.append(node)
        if node[-1] % SECTION == 0:
            close()
    if members:
        close()
    return digest(b"".join(marks)).hex() + ":" + "/".join(sections)


def _leaf_count(paragraphs: list[str]) -> int:
    return sum(len(p) - NODE for p in paragraphs) // LEAF


def _unmatched(one: list, other: list, key: Callable) -> tuple[list, list]:
    """What is left of both sides once children of equal digest are taken in pairs, first ones first."""
    have, there = Counter(map(key, one)), Counter(map(key, other))

    def rest(side: list) -> list:
        both, out = have & there, []
        for child in side:
            if both[key(child)]:
                both[key(child)] -= 1
            else:
                out.append(child)
        return out

    return rest(one), rest(other)


def _opened(one: str, other: str) -> tuple[list, list]:
    """The paragraphs of differing branches on either side: numbers in their text and nodes."""
    sides = []
    for tree in (one, other):
        sections, first = [], 0
        for section in tree.split(":", 1)[1].split("/"):
            mark, *paragraphs = section.split(".")
            sections.append((mark, first, paragraphs))
            first += len(paragraphs)
        sides.append(sections)
    sections = _unmatched(*sides, key=lambda s: s[0])
    numbered = [[(n, p) for _, first, ps in side for n, p in enumerate(ps, first)] for side in sections]
    return _unmatched(*numbered, key=lambda p: p[1][:NODE])


def compare(one: str, other: str) -> tuple[float, list[int]]:
    """Likeness, 0 to 1 (twice the leaves in common branches by those of both), and the numbers
    of the first text's paragraphs that differ."""
    if one[:32] == other[:32]:
        return 1.0, []
    totals = [
        _leaf_count([p for s in tree.split(":", 1)[1].split("/") for p in s.split(".")[1:]]) for tree in (one, other)
    ]
    mine, theirs = _opened(one, other)
    changed = [n for n, _ in mine]
    if not sum(totals):
        return 1.0, changed
    cut = lambda side: Counter(p[i : i + LEAF] for _, p in side for i in range(NODE, len(p), LEAF))
    closed = totals[0] - _leaf_count([p for _, p in mine])
    return 2.0 * (closed + sum((cut(mine) & cut(theirs)).values())) / sum(totals), changed


def likeness(one: str, other: str) -> float:
    return compare(one, other)[0]


def differing_paragraphs(one: str, other: str) -> list[int]:
    return compare(one, other)[1]


def spans(numbers: list[int]) -> list[tuple[int, int]]:
    """First and last of each unbroken stretch of ascending numbers."""
    out: list[tuple[int, int]] = []
    for n in numbers:
        if out and n == out[-1][1] + 1:
            out[-1] = (out[-1][0], n)
        else:
            out.append((n, n))
    return out


def _leading(cuts: list[int], holds: Callable[[Column], Column]) -> Column:
    """How many leading cuts the condition holds for, by binary search."""
    if not cuts:
        return F.lit(0)
    known = F.array(*(F.lit(c).cast("long") for c in cuts))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))))
    return F.aggregate(
        steps,
        F.lit(0),
        lambda found, step: F.when(
            F.coalesce(holds(F.get(known, found + step - 1)), F.lit(False)), found + step
        ).otherwise(found),
    )


def _followed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows in runs of falling id, each run closed by the row that follows it.

    Cuts between runs are percentiles of the ids, one per shuffle partition; rows of
    an id that spans several cuts are dealt among them by their hash. The first row
    of a run, at most one per cut, is also sent to the run before it.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("_key"),
        F.shiftrightunsigned(F.xxhash64(F.col(text).cast("string")), 1).alias("_order"),
    )
    shares = F.array(*(F.lit(i / n) for i in range(1, n))) if n > 1 else F.array(F.lit(0.5))
    cuts = keyed.agg(F.percentile_approx("_key", shares, 100_000)).first()[0] or []
    falling = sorted(cuts, reverse=True)
    above = _leading(falling, lambda c: c > F.col("_key"))
    equal = _leading(falling, lambda c: c >= F.col("_key")) - above
    share = F.col("_order") / F.lit(float(1 << 63))
    # Within an id the hash falls as the run number grows, as in the sort below.
    within = F.least(F.floor((F.lit(1.0) - share) * (equal + 1)), equal)
    runs = keyed.withColumn("_run", (above + within).cast("int"))
    firsts = sorted(
        (r["_run"], r["first"]["_key"], r["first"]["_order"])
        for r in runs.groupBy("_run")
        .agg(F.max(F.struct("_key", "_order")).alias("first"))
        .collect()
    )
    before = [(key, order, firsts[i - 1][0]) for i, (_, key, order) in enumerate(firsts)]
    guests = spark.createDataFrame(before, "_key long, _order long, _before int")
    sent = runs.join(F.broadcast(guests), ["_key", "_order"], "left").select(
        "doc_id",
        "text",
        "_key",
        "_order",
        F.explode(
            F.when(
                F.col("_before").isNotNull(),
                F.array(
                    F.struct(F.col("_run").alias("run"), F.lit(0).alias("guest")),
                    F.struct(F.col("_before").alias("run"), F.lit(1).alias("guest")),
                ),
            ).otherwise(F.array(F.struct(F.col("_run").alias("run"), F.lit(0).alias("guest"))))
        ).alias("_at"),
    )
    return (
        sent.select(F.col("_at.run").alias("_run"), F.col("_at.guest").alias("_guest"), "_key", "_order", "doc_id", "text")
        .repartitionById(n, "_run")
        .sortWithinPartitions("_run", "_guest", F.desc("_key"), F.desc("_order"))
        .select("_run", "_guest", "doc_id", "text")
    )


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, edited_lines string"
)


def fingerprints(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """Every document's fingerprint, that of its edited text, and both likenesses.

    ``edited_lines`` are the places the comparison found in the edited text: line numbers
    from 0, as ``first-last`` of each stretch.
    """
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string()]
    ship(docs.sparkSession)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for run, guest, doc, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                content = content or ""
                if held and held[0] == run and not held[1]:
                    print_next = fingerprint(content)
                    out.append(_row(held, content, print_next))
                    held = (run, guest, doc, content, print_next)
                elif not (held and held[0] == run):
                    held = (run, guest, doc, content, fingerprint(content))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names
                )

    return _followed(docs, doc_id, text).mapInArrow(walk, SCHEMA)


def _row(held: tuple, following: str, following_print: str) -> tuple:
    _, _, doc, content, own = held
    half = len(content) // 2
    edited = content[: len(content) - half] + following[:half]
    edited_print = fingerprint(edited)
    near, changed = compare(edited_print, own)
    return (
        doc,
        len(content),
        hashlib.sha256(edited.encode()).hexdigest(),
        own,
        edited_print,
        near,
        likeness(own, following_print),
        " ".join(f"{a}-{b}" for a, b in spans(changed)),
    )
