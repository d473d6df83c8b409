"""Best-fit packing of token pieces into sequences, with several capacities.

A document's ids end with an end id. A document longer than a sequence is cut
into full sequences; the remainder, if any, is its first piece. Every other
document is one piece.

A piece is a vector (tokens, documents, attention cost = tokens squared) and a
sequence has a capacity of each. Pieces are placed from the longest to the
shortest. A piece goes to the open sequence that it fits under every capacity
and that leaves the smallest weighted norm of what remains; if it fits none, a
new sequence is opened.

Pieces of one length are alike, and so are sequences with the same residual
capacities, so the placement needs only the number of pieces per length. That
table has at most ``tokens`` rows, whatever the corpus, and the placement moves
whole ranges of alike sequences at a time. Its result says for each length
which ranks go to which sequences. Residual documents and cost are cut off at
what the residual tokens can use up, so that capacities that cannot bind do not
keep sequences apart.

The rank of a piece among those of its length comes from windows over
(length, bucket), so a length with a third of all pieces is spread.

Defined results: null text is the empty text, which is one end id; repeated
rows are pieces of their own; an empty table gives an empty table. Only the
named columns are read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.llm.common import running_totals, ship, stage
from casework.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """Capacities of a sequence and the weights of their residuals in the norm."""

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    end_id: int = 0
    buckets: int = 512


def piece_bounds(n: int, most: int) -> list[tuple[int, int]]:
    """Start and length of each piece of a document of n ids."""
    first = n % most or most
    return [(0, min(first, n))] + [(s, most) for s in range(first, n, most)]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: Capacity, doc_id="doc_id", text="text") -> DataFrame:
    """Pieces of whole texts; the ids themselves stay in the worker."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text = encoder(vocabulary)
        end = np.array([capacity.end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode_text(content.as_py() or "") + end
                for k, (start, length) in enumerate(piece_bounds(len(ids) // 4, capacity.tokens)):
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                    rows.append((doc, k, start, length, crc))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(list(zip(*rows)) or [[]] * 5, _TYPES, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    ship(docs.sparkSession)
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return read.mapInArrow(encode, PIECES)


_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


class _Open:
    """Open sequences by residual capacities; each entry is a list of ranges of sequence ids."""

    def __init__(self, capacity: Capacity):
        self.capacity = capacity
        self.ranges: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        self.tokens: dict[int, list[tuple[int, int, int]]] = {}
        self.levels: list[int] = []

    def add(self, state: tuple[int, int, int], ids: tuple[int, int]) -> None:
        tokens, documents, cost = state
        state = (tokens, min(documents, tokens), min(cost, tokens * tokens))
        if not state[0] or not state[1] or not state[2]:
            return
        if state not in self.ranges:
            self.ranges[state] = []
            if tokens not in self.tokens:
                self.tokens[tokens] = []
                bisect.insort(self.levels, tokens)
            self.tokens[tokens].append(state)
        self.ranges[state].append(ids)

    def best(self, length: int, most_documents: float) -> tuple[int, int, int] | None:
        """The state with the smallest weighted residual norm after a piece of this length."""
        found, least = None, float("inf")
        token_weight, document_weight, cost_weight = self.capacity.weights
        for tokens in self.levels[bisect.bisect_left(self.levels, length) :]:
            left = (tokens - length) / self.capacity.tokens
            if token_weight * left * left >= least:
                break
            for state in self.tokens[tokens]:
                if state[1] < 1 or state[2] < length * length:
                    continue
                norm = (
                    token_weight * left * left
                    + document_weight * ((state[1] - 1) / self.capacity.documents) ** 2
                    + cost_weight * ((state[2] - length * length) / self.capacity.cost) ** 2
                )
                if norm < least:
                    found, least = state, norm
        return found

    def take(self, state: tuple[int, int, int], n: int) -> tuple[int, int]:
        """At most n sequences of a state, as one range of ids."""
        low, high = self.ranges[state].pop()
        if high - low > n:
            self.ranges[state].append((low + n, high))
            high = low + n
        if not self.ranges[state]:
            del self.ranges[state]
            self.tokens[state[0]].remove(state)
            if not self.tokens[state[0]]:
                del self.tokens[state[0]]
                del self.levels[bisect.bisect_left(self.levels, state[0])]
        return low, high


def place(counts: dict[int, int], capacity: Capacity) -> dict[int, list[tuple[int, int, int]]]:
    """Per length, in rank order: first rank, sequence of that rank, offset in the sequence."""
    fresh = (capacity.tokens, capacity.documents, capacity.cost)
    state_after = lambda s, n: (s[0] - n, s[1] - 1, s[2] - n * n)
    opened, sequences, plan = _Open(capacity), 0, {}
    for length in sorted(counts, reverse=True):
        if length > capacity.tokens or length * length > capacity.cost or capacity.documents < 1:
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        rank, left, plan[length] = 0, counts[length], []
        while left:
            state = opened.best(length, left)
            if state is None:
                # A new sequence takes what it can of this length, so that many open at once.
                fit = min(
                    capacity.tokens // length, capacity.documents, capacity.cost // (length * length)
                )
                n = -(-left // fit)
                opened.add(fresh, (sequences, sequences + n))
                sequences += n
                state = opened.best(length, left)
            low, high = opened.take(state, left)
            plan[length].append((rank, low, capacity.tokens - state[0]))
            opened.add(state_after(state, length), (low, high))
            rank, left = rank + high - low, left - (high - low)
    return plan


def pack(docs: DataFrame, vocabulary: str, capacity: Capacity = Capacity()) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    # Rows are dealt to buckets by their place in the table, so that copies and repeated
    # rows spread too; the staged table fixes the place.
    bucket = F.pmod(F.monotonically_increasing_id(), F.lit(capacity.buckets)).cast("int")
    pieces = stage(token_pieces(docs, vocabulary, capacity).withColumn("_bucket", bucket), "pack_pieces")
    # At most one row per length from 1 to the sequence's tokens.
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = {
        length: tuple(np.array(x, dtype=np.int64) for x in zip(*steps))
        for length, steps in place(counts, capacity).items()
    }
    ranked = running_totals(
        pieces.withColumn("_one", F.lit(1)),
        ["length"],
        "_bucket",
        ["doc_id", "piece", "ids_crc32"],
        ["_one"],
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            length = columns["length"].to_numpy(zero_copy_only=False)
            rank = columns["_one_before"].to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                rows = np.flatnonzero(length == value)
                first, target, at = plan[int(value)]
                step = np.searchsorted(first, rank[rows], side="right") - 1
                sequence[rows], offset[rows] = target[step] + rank[rows] - first[step], at[step]
            kept = [columns[n] for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        assign,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
