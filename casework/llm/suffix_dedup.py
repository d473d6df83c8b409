"""Removal of repeated byte strings, from suffixes sorted a bucket at a time.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.
Two suffixes that agree in ``length`` bytes tie as far as this matters, so suffixes need
no order beyond it and have 64-bit hashes of their first bytes as sort keys.

Positions of a document are sampled by a difference cover: residues modulo ``period`` of
which some pair has every difference. For two equal strings of ``length`` bytes there is
hence an offset below ``period`` at which both have a sample, and the ``core`` of
``length - period + 1`` bytes from there on lies in both. So

1. all samples are ranked by their core: those whose core is met once, the most by far,
   take no further part;
2. the others are ranked by their context too, the bytes from ``period - 1`` before the
   sample to ``length`` behind it. If two samples have one context, the long tie of all
   strings in it is settled by these two ranks: each string occurs twice. Samples of one
   core with a context of their own stay open;
3. the suffixes that begin less than ``period`` before an open sample, and before one
   sample of each settled context that shares its core with another, are dealt to buckets
   by hash and sorted there, one bucket at a time; neighbours that agree are repeats.

Documents are put into blocks of about ``BLOCK`` bytes, written once in Spark buckets by
block. A block sends each different key once, however often it has it, so a passage in a
third of all documents is one row per block, and gets back a bit for each key, in the
order in which it sent them. A core with many contexts in a block sends two of them,
enough to show that it is open. The number of buckets follows the input, so a task's
memory doesn't.

Positions are bytes of the UTF-8 text. Keys are 64-bit hashes (a core's 32 bits within
its bucket, which only decides what is looked at), two independent ones together naming a
context or a string.

Defined results: a null text is empty; a text below ``length`` bytes stays; strings don't
cross documents; rows equal in id and text are documents of their own, so their texts go;
null ids are kept; an empty table gives an empty one. Columns besides ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.llm.common import new_staging, ship, stage

#: Bytes of text that a task works on at a time, and that it hashes at a time.
BLOCK, SEGMENT = 4 << 20, 1 << 20
#: Bytes of text per bucket: of samples and suffixes, and of blocks.
BUCKET = 32 << 20
#: Spark's own bound on a table's buckets; beyond it the blocks' buckets grow, which are streamed.
MOST_BUCKETS = 100_000
#: A perfect difference set: every residue but 0 is a difference of exactly one pair. Fixed values.
PERIOD = 133
COVER = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)
CORES, CONTEXTS, STRINGS = range(3)
#: What a context is: met once with its core open nowhere, settled, open, settled but needed by open ones.
ALONE, SETTLED, OPEN, NEEDED = range(4)


@dataclass(frozen=True)
class SuffixDedup:
    length: int = 400
    period: int = PERIOD
    cover: tuple[int, ...] = COVER

    @property
    def core(self) -> int:
        return self.length - self.period + 1


# Hashes of byte strings.


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTERS = [_mix(np.arange(1, 257, dtype=np.uint64) + np.uint64(1000 * i)) | np.uint64(1) for i in range(2)]
_BASES = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]
_POWERS: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse, kept from call to call."""
    size = 1 << max(n - 1, 1).bit_length()
    if size not in _POWERS:
        _POWERS.clear()
        found = []
        for base in _BASES:
            pair = []
            for x in (base, pow(base, -1, 1 << 64)):
                run = np.full(size, x, dtype=np.uint64)
                run[0] = 1
                pair.append(np.cumprod(run, dtype=np.uint64))
            found.append(tuple(pair))
        _POWERS[size] = found
    return _POWERS[size]


def string_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray, which: tuple[int, ...] = (0, 1)) -> list[np.ndarray]:
    """Hashes of the strings data[first:last]; ``first`` rises, and strings are short against SEGMENT.

    Differences of prefix sums of a polynomial, a segment at a time, each from its own origin.
    """
    out = [np.empty(len(first), dtype=np.uint64) for _ in which]
    cuts = np.searchsorted(first, np.arange(0, len(data) + SEGMENT, SEGMENT))
    for k in range(len(cuts) - 1):
        a, b = cuts[k], cuts[k + 1]
        if a == b:
            continue
        start = k * SEGMENT
        stop = int(last[a:b].max())
        letters = data[start:stop]
        begin, end = first[a:b] - start, last[a:b] - start
        powers = _powers(len(letters) + 1)
        for found, i in zip(out, which, strict=True):
            rising, falling = powers[i]
            sums = np.zeros(len(letters) + 1, dtype=np.uint64)
            np.cumsum(_LETTERS[i][letters] * rising[: len(letters)], dtype=np.uint64, out=sums[1:])
            length = (end - begin).astype(np.uint64)
            found[a:b] = _mix((sums[end] - sums[begin]) * falling[begin] + length * np.uint64(_BASES[1 - i]))
    return out


# What a block knows of itself, and from the answers to what it has sent.


def _split(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Buckets of a sorted array and where each lies."""
    cuts = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1], [True]))) if len(buckets) else [0]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(buckets[a]), slice(a, b)


def _answered(buckets: np.ndarray, answers: dict[int, bytes], bits: bool) -> np.ndarray:
    """Answers in the order of the keys: a bit or a byte for each."""
    out = np.zeros(len(buckets), dtype=np.uint8)
    for bucket, where in _split(buckets):
        if bucket in answers:
            raw = np.frombuffer(answers[bucket], dtype=np.uint8)
            out[where] = np.unpackbits(raw, count=where.stop - where.start) if bits else raw
    return out


def _distinct(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per different combination its first row and number of rows, by rising keys; and per row its combination."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    at = np.cumsum(new) - 1
    row = np.empty(len(order), dtype=np.int64)
    row[order] = at
    return order[new], np.bincount(at, minlength=int(new.sum())), row


class Block:
    """The texts of a block, one behind the other, and the stages' keys of their positions."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, plan: SuffixDedup, buckets: int) -> None:
        self.data, self.plan, self.buckets = data, plan, np.uint64(buckets)
        sizes = np.diff(ends, prepend=0)
        long = sizes >= plan.length
        self.start, self.end = (ends - sizes)[long], ends[long]
        in_cover = np.zeros(plan.period, dtype=bool)
        in_cover[list(plan.cover)] = True
        samples, owners = [], []
        for d, (start, end) in enumerate(zip(self.start.tolist(), self.end.tolist(), strict=True)):
            # The cover repeats every period; the last sample has a whole core behind it.
            rounds = -(-(end - start - plan.core + 1) // plan.period)
            places = (np.arange(rounds)[:, None] * plan.period + np.array(plan.cover)).ravel()
            places = places[places <= end - start - plan.core] + start
            samples.append(places)
            owners.append(np.full(len(places), d))
        blank = np.zeros(0, dtype=np.int64)
        self.sample = np.concatenate(samples) if samples else blank
        self.owner = np.concatenate(owners) if owners else blank
        self._cores()

    def _bucket(self, key: np.ndarray) -> np.ndarray:
        return ((key >> np.uint64(32)) % self.buckets).astype(np.int64)

    def _cores(self) -> None:
        [key] = string_hashes(self.data, self.sample, self.sample + self.plan.core, (0,))
        self.core = (self._bucket(key) << 32) | (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first, count, self.core_row = _distinct(self.core)
        self.cores, self.core_count = self.core[first], count

    def core_keys(self) -> Iterator[tuple[int, bytes]]:
        """Per bucket the different cores, 32 bits each."""
        for bucket, where in _split(self.cores >> 32):
            yield bucket, (self.cores[where] & 0xFFFFFFFF).astype("<u4").tobytes()

    def learn_cores(self, answers: dict[int, bytes]) -> None:
        """Samples whose core occurs again, and the different contexts of each."""
        again = _answered(self.cores >> 32, answers, True).astype(bool) | (self.core_count > 1)
        kept = again[self.core_row]
        self.sample, self.owner, self.core = self.sample[kept], self.owner[kept], self.core[kept]
        begin = np.maximum(self.sample - self.plan.period + 1, self.start[self.owner])
        end = np.minimum(self.sample + self.plan.length, self.end[self.owner])
        [key] = string_hashes(self.data, begin, end, (1,))
        # A context that a document's end cuts differs from one of the same bytes that goes on.
        key = _mix(key + (self.sample - begin).astype(np.uint64) * np.uint64(_BASES[0]))
        self.context = key & ~np.uint64(1)
        first, count, self.context_row = _distinct(self.core, self.context)
        core = self.core[first]
        self.contexts = core, self.context[first]
        self.context_count = count
        new = np.concatenate(([True], core[1:] != core[:-1])) if len(core) else np.zeros(0, dtype=bool)
        place = np.arange(len(core)) - np.maximum.accumulate(np.where(new, np.arange(len(core)), 0))
        # Two contexts show that a core is open; the block knows of the others itself.
        self.sent = place < 2

    def context_keys(self) -> Iterator[tuple[int, bytes]]:
        """Per bucket cores and contexts, with a bit for contexts that the block has more than once."""
        core, context = (x[self.sent] for x in self.contexts)
        context = context | (self.context_count[self.sent] > 1).astype(np.uint64)
        for bucket, where in _split(core >> 32):
            yield bucket, (core[where] & 0xFFFFFFFF).astype("<u4").tobytes() + context[where].astype("<u8").tobytes()

    def learn_contexts(self, answers: dict[int, bytes]) -> None:
        """Suffixes in settled contexts, and those that open samples leave to be sorted."""
        codes = np.where(self.context_count > 1, NEEDED, OPEN).astype(np.uint8)
        codes[self.sent] = _answered(self.contexts[0][self.sent] >> 32, answers, False)
        code = codes[self.context_row]
        begin = np.maximum(self.sample - self.plan.period + 1, self.start[self.owner])
        end = np.minimum(self.sample, self.end[self.owner] - self.plan.length) + 1

        def begun(which: np.ndarray) -> np.ndarray:
            steps = np.zeros(len(self.data) + 1, dtype=np.int32)
            which = which & (end > begin)
            np.add.at(steps, begin[which], 1)
            np.add.at(steps, end[which], -1)
            return np.cumsum(steps[:-1], dtype=np.int32) > 0

        self.repeats = begun((code == SETTLED) | (code == NEEDED))
        self.suffix = np.flatnonzero(begun((code == OPEN) | (code == NEEDED)))
        key, other = string_hashes(self.data, self.suffix, self.suffix + self.plan.length)
        bucket = self._bucket(other)
        first, self.string_count, self.string_row = _distinct(bucket, key)
        self.strings = bucket[first], key[first]

    def string_keys(self) -> Iterator[tuple[int, bytes]]:
        """Per bucket the different strings, 64 bits each."""
        bucket, key = self.strings
        for number, where in _split(bucket):
            yield number, key[where].astype("<u8").tobytes()

    def learn_strings(self, answers: dict[int, bytes]) -> None:
        again = _answered(self.strings[0], answers, True).astype(bool) | (self.string_count > 1)
        self.repeats[self.suffix[again[self.string_row]]] = True

    def removed(self) -> np.ndarray:
        """Bytes covered by a string that starts here and elsewhere; strings stay in their document."""
        begin = np.flatnonzero(self.repeats)
        steps = np.zeros(len(self.data) + 1, dtype=np.int32)
        steps[begin] += 1
        steps[begin + self.plan.length] -= 1
        return np.cumsum(steps[:-1], dtype=np.int32) > 0


# What a bucket answers.


def again_elsewhere(keys: list[np.ndarray]) -> list[np.ndarray]:
    """Per block, a bit for each of its (different) keys: whether another block has it."""
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    same = np.zeros(len(flat) + 1, dtype=bool)
    same[1:-1] = flat[order][1:] == flat[order][:-1]
    met = np.empty(len(flat), dtype=bool)
    met[order] = same[1:] | same[:-1]
    return np.split(met, np.cumsum([len(k) for k in keys])[:-1])


def context_codes(blocks: np.ndarray, cores: list[np.ndarray], contexts: list[np.ndarray]) -> list[np.ndarray]:
    """Per block, what each of its contexts is."""
    core, sent = np.concatenate(cores), np.concatenate(contexts)
    context, twice = sent & ~np.uint64(1), (sent & np.uint64(1)).astype(np.int64)
    block = np.repeat(blocks, [len(c) for c in cores])
    order = np.lexsort((block, context, core))
    core, context, twice = core[order], context[order], twice[order]
    new_core = np.concatenate(([True], core[1:] != core[:-1]))
    new = new_core | np.concatenate(([True], context[1:] != context[:-1]))
    at, core_at = np.cumsum(new) - 1, np.cumsum(new_core) - 1
    settled = (np.bincount(at) + np.bincount(at, weights=twice) > 1)[at]
    shared = (np.bincount(core_at, weights=new) > 1)[core_at]
    found = np.where(settled, np.where(shared & new, NEEDED, SETTLED), np.where(shared, OPEN, ALONE))
    out = np.empty(len(found), dtype=np.uint8)
    out[order] = found
    return np.split(out, np.cumsum([len(c) for c in cores])[:-1])


def _answers_of(question: int, blocks: list[int], payloads: list[bytes]) -> list[bytes]:
    if question == CONTEXTS:
        sizes = [len(p) // 12 for p in payloads]
        cores = [np.frombuffer(p, "<u4", n) for p, n in zip(payloads, sizes, strict=True)]
        contexts = [np.frombuffer(p, "<u8", n, 4 * n) for p, n in zip(payloads, sizes, strict=True)]
        return [c.tobytes() for c in context_codes(np.array(blocks), cores, contexts)]
    kind = "<u4" if question == CORES else "<u8"
    found = again_elsewhere([np.frombuffer(p, kind) for p in payloads])
    return [np.packbits(bits).tobytes() if bits.any() else b"" for bits in found]


# The passes over the blocks.


def _blocks(docs: DataFrame) -> DataFrame:
    """Blocks of whole texts: ``block``, the ids, where each text ends, and the bytes."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, size, types = [], [], 0, None

        def block() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in texts])
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([ids], types[0]), pa.array([ends], types[1]), pa.array([b"".join(texts)], pa.binary())],
                names=["block", "ids", "ends", "data"],
            )

        for batch in batches:
            types = (pa.list_(batch.schema.field(0).type), pa.list_(pa.int64()))
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = raw.as_buffer().to_pybytes() if raw.is_valid else b""
                if texts and size + len(text) > BLOCK:
                    yield block()
                    ids, texts, size, number = [], [], 0, number + 1
                ids.append(i)
                texts.append(text)
                size += len(text)
        if texts:
            yield block()

    kind = dict(docs.dtypes)["doc_id"]
    read = docs.select("doc_id", F.col("text").cast("string").cast("binary"))
    return read.mapInArrow(gather, f"block long, ids array<{kind}>, ends array<long>, data binary")


def _learnt(row: dict, plan: SuffixDedup, buckets: int, known: int) -> Block:
    """A block with the first ``known`` kinds of answers."""
    data = np.frombuffer(row["data"].as_buffer(), dtype=np.uint8) if row["data"].is_valid else np.zeros(0, np.uint8)
    block = Block(data, np.array(row["ends"].as_py(), dtype=np.int64), plan, buckets)
    answers: tuple[dict[int, bytes], ...] = ({}, {}, {})
    for a in row["answers"].as_py() or () if known else ():
        answers[a["question"]][a["bucket"]] = a["payload"]
    for question, learn in zip(range(known), (block.learn_cores, block.learn_contexts, block.learn_strings)):
        learn(answers[question])
    return block


def _asked(blocks: DataFrame, question: int, plan: SuffixDedup, buckets: int) -> DataFrame:
    """The keys that blocks send for a question."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                block = _learnt(row, plan, buckets, question)
                keys = (block.core_keys, block.context_keys, block.string_keys)[question]
                sent = list(keys())
                if sent:
                    number = row["block"].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b for b, _ in sent], pa.int32()), pa.array([number] * len(sent)), pa.array([p for _, p in sent], pa.binary())],
                        names=["bucket", "block", "payload"],
                    )

    return blocks.mapInArrow(ask, "bucket int, block long, payload binary")


def _answered_keys(asked: DataFrame, question: int, buckets: int) -> DataFrame:
    """Answers to the blocks, from one bucket at a time."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blocks, payloads = None, [], []

        def reply() -> Iterator[pa.RecordBatch]:
            found = [(b, a) for b, a in zip(blocks, _answers_of(question, blocks, payloads), strict=True) if a]
            if found:
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in found]), pa.array([question] * n, pa.int32()), pa.array([bucket] * n, pa.int32()), pa.array([a for _, a in found], pa.binary())],
                    names=["block", "question", "bucket", "payload"],
                )

        for batch in batches:
            for mine, block, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if mine != bucket:
                    if blocks:
                        yield from reply()
                    bucket, blocks, payloads = mine, [], []
                blocks.append(block)
                payloads.append(payload)
        if blocks:
            yield from reply()

    dealt = asked.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(answer, "block long, question int, bucket int, payload binary")


def repeated_spans(docs: DataFrame, plan: SuffixDedup = SuffixDedup()) -> DataFrame:
    """Per document: doc_id, n_bytes, ``begin`` and ``end`` of each removed run, and ``kept``, the other bytes."""
    spark = docs.sparkSession
    ship(spark)
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / BUCKET))
    homes = min(buckets, MOST_BUCKETS)
    blocks = new_staging(spark).stage_bucketed(_blocks(docs), "suffix_blocks", homes, "block")

    def told(answers: list[DataFrame]) -> DataFrame:
        """The blocks, each with all answers so far; the blocks themselves don't move."""
        if not answers:
            return blocks
        flat = answers[0]
        for more in answers[1:]:
            flat = flat.union(more)
        per_block = (
            flat.repartition(homes, "block")
            .groupBy("block")
            .agg(F.collect_list(F.struct("question", "bucket", "payload")).alias("answers"))
        )
        return blocks.join(per_block.hint("shuffle_hash"), "block", "left")

    answers: list[DataFrame] = []
    for question, name in enumerate(("cores", "contexts", "strings")):
        asked = _asked(told(answers), question, plan, buckets)
        answers.append(stage(_answered_keys(asked, question, buckets), f"suffix_{name}"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                block = _learnt(row, plan, buckets, 3)
                gone = block.removed()
                ends = row["ends"].as_py()
                sizes, begins, stops, kept = [], [], [], []
                for start, end in zip([0, *ends[:-1]], ends, strict=True):
                    mine = gone[start:end]
                    edge = np.flatnonzero(np.diff(mine, prepend=False, append=False))
                    sizes.append(end - start)
                    begins.append(edge[::2])
                    stops.append(edge[1::2])
                    kept.append(block.data[start:end][~mine].tobytes())
                spans = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [row["ids"].values, pa.array(sizes, pa.int64()), pa.array(begins, spans), pa.array(stops, spans), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "begin", "end", "kept"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_bytes long, begin array<long>, end array<long>, kept binary"
    return told(answers).mapInArrow(cut, schema)


def repeat_report(docs: DataFrame, plan: SuffixDedup = SuffixDedup()) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = repeated_spans(docs, plan)
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("begin").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
