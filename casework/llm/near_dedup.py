"""Near-duplicate documents by Order MinHash and banded alignment.

A text is its sequence of words (runs of ASCII letters, digits and non-ASCII
bytes, in lower case). Its k-mers are ``k`` words long and carry their occurrence
number, so a repeated k-mer counts each time. Each of ``sketches`` hash functions
picks the ``picks`` smallest labelled k-mers; their k-mers, put back into text
order, make one sketch value. Two texts share a value if they share those k-mers
in that order, so the chance of it follows edit similarity.

Texts that share a value are candidates. To join most of them early, texts of a
value's group are compared with leaders. The first leader is the most central
text, whose k-mers the others have most often (the original of a family, as a
rule). Texts not joined to it are compared with the most central ones of
``leaders`` parts of the group. Then the texts of all groups that are not one
component yet are compared by a prefix filter: in the order of their number among
these texts, two texts of similarity ``least`` have one of their rarest k-mers in
common, of about a ninth of the shorter and a fifth of the longer. A k-mer of one
text only meets nobody, so texts that differ in more than that meet nobody at all,
however large their group. The texts of a k-mer are paired one by one if few of them
are open, else compared in tiles of ``tile`` by ``tile``. A pair is left out only if it
is in one component already, if its lengths, its places in the two orders or its number
of shared k-mers cannot reach ``least``, or if the two have a rarer k-mer of their
prefixes in common, where they meet.

Candidates are verified: their labelled k-mers are aligned within a band that no
alignment of similarity ``least`` can leave, and the similarity is the aligned
k-mers over all k-mers of both (one minus it is a metric). Verified pairs are
links, and a class is a connected component of links. Equal word sequences are
one text from the start, so copies are never compared.

Defined results: null and wordless texts are equal to each other and form one
class; a text shorter than ``k`` words is one k-mer; rows of equal id and text
are copies; a null id stands behind all others as a representative; an id with
several texts may name several classes; an empty table gives an empty table. Further columns of the documents are kept.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import key_columns, ship, stage
from casework.llm.components import components
from casework.operators.relational import may_match

KEY = ["_k1", "_k2"]
#: Texts that share a sketch value.
GROUP = ["_i", "_value"]
#: Texts of a k-mer that have a length class and are open, or in its main component.
CELL = ["_band", "_open", "_chunk"]
TILE = ["_value", "_tile"]
#: Open texts of a k-mer up to which each is paired with the others one by one.
FEW = 8
#: Bytes of text hashed at a time, to bound a task's memory.
BLOCK = 1 << 20
#: Blocks of 4 KB in the filter of the texts that may have near ones: 2 % wrong hits at 2.7 million texts.
FILTER_BLOCKS = 1024


@dataclass(frozen=True)
class OrderMinHash:
    k: int = 5
    picks: int = 2
    sketches: int = 12
    least: float = 0.8
    #: Leaders of a group for the texts that its most central one does not join.
    leaders: int = 8
    #: Labelled k-mers by which a text's centrality is judged.
    sample: int = 128
    #: Texts on a side of a tile.
    tile: int = 128


_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE, _BASE_INVERSE = np.uint64(0x100000001B3), np.uint64(pow(0x100000001B3, -1, 1 << 64))
_WORD_BYTE = np.array(
    [b >= 128 or chr(b).isalnum() for b in range(256)], dtype=bool
)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of concatenated texts, and the text it is in.

    Prefix sums of a polynomial over the bytes give any word's hash by a difference.
    """
    inside = _WORD_BYTE[data]
    fresh = np.zeros(len(data), dtype=bool)
    fresh[ends[:-1][ends[:-1] < len(data)]] = True
    starts = np.flatnonzero(inside & (~np.concatenate(([False], inside[:-1])) | fresh))
    stops = np.flatnonzero(inside & (~np.concatenate((inside[1:], [False])) | np.concatenate((fresh[1:], [True])))) + 1
    powers = np.full(len(data), _BASE)
    powers[:1] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)))
    inverse = np.full(len(data) + 1, _BASE_INVERSE)
    inverse[:1] = 1
    inverse = np.cumprod(inverse, dtype=np.uint64)
    hashes = _mix((sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64) * _ODD)
    return hashes, np.searchsorted(ends, starts, side="right")


def kmers(data: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per k-mer: hash, hash with its occurrence number, text; and per text the first k-mer's index."""
    words, text = _word_hashes(data, ends)
    n_texts = len(ends)
    counts = np.bincount(text, minlength=n_texts)
    first = np.concatenate(([0], np.cumsum(counts)))
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    at = np.concatenate(([0], np.cumsum(sizes)))
    owner = np.repeat(np.arange(n_texts), sizes)
    begin = first[owner] + np.arange(at[-1]) - at[owner]
    length = np.minimum(counts[owner], k)
    # Keyed to the place in the k-mer, so that the order of its words counts.
    padded = np.concatenate((words, np.zeros(k, dtype=np.uint64)))
    hashes = length.astype(np.uint64)
    for j in range(k):
        hashes = np.where(j < length, _mix(hashes * _ODD + padded[begin + j]), hashes)
    order = np.lexsort((hashes, owner))
    sorted_hash, sorted_owner = hashes[order], owner[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (sorted_hash[1:] != sorted_hash[:-1]) | (sorted_owner[1:] != sorted_owner[:-1])
    run_start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    occurrence = np.empty(len(order), dtype=np.uint64)
    occurrence[order] = (np.arange(len(order)) - run_start).astype(np.uint64)
    return hashes, _mix(hashes + occurrence * _ODD), owner, at


def sketches(hashes: np.ndarray, labelled: np.ndarray, owner: np.ndarray, at: np.ndarray, plan: OrderMinHash) -> np.ndarray:
    """Sketch values, one row per text that has k-mers."""
    sizes = np.diff(at)
    full = np.flatnonzero(sizes)
    starts = at[:-1][full]
    out = np.zeros((len(full), plan.sketches), dtype=np.uint64)
    for i in range(plan.sketches):
        keyed = _mix(labelled + np.uint64((i + 1) * 0xD1342543DE82EF95 % (1 << 64)))
        places = []
        for pick in range(plan.picks):
            least = np.minimum.reduceat(keyed, starts)
            hit = np.flatnonzero(keyed == np.repeat(least, sizes[full]))
            # The first hit of each text; a text with fewer k-mers repeats its last one.
            where = hit[np.searchsorted(hit, starts)]
            places.append(where)
            keyed[where] = np.uint64(0xFFFFFFFFFFFFFFFF)
        for j in range(1, plan.picks):
            places[j] = np.where(sizes[full] > j, places[j], places[j - 1])
        value = np.full(len(full), np.uint64(i))
        for place in np.sort(np.array(places), axis=0):
            value = _mix(value * _ODD + hashes[place])
        out[:, i] = value
    return out


def _blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Lower-case bytes of consecutive texts, about BLOCK at a time: first row, bytes, ends."""
    lowered = pc.utf8_lower(pc.fill_null(column, ""))
    sizes = np.asarray(pc.binary_length(lowered))
    row, n = 0, len(sizes)
    while row < n:
        stop, total = row, 0
        while stop < n and (stop == row or total + sizes[stop] <= BLOCK):
            total += sizes[stop]
            stop += 1
        joined = "".join(lowered.slice(row, stop - row).to_pylist()).encode()
        yield row, np.frombuffer(joined, dtype=np.uint8), np.cumsum(sizes[row:stop])
        row = stop


def _sketch_table(docs: DataFrame, plan: OrderMinHash) -> DataFrame:
    """Per row: its key, id, the identity of its word sequence, number of k-mers, sketch values."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            identity, sizes, values = [], [], []
            for _, data, ends in _blocks(batch.column(3)):
                hashes, labelled, owner, at = kmers(data, ends, plan.k)
                counts = np.diff(at)
                rows = iter(sketches(hashes, labelled, owner, at, plan).astype(np.int64).tolist())
                raw = labelled.tobytes()
                for t, n in enumerate(counts.tolist()):
                    identity.append(xxhash.xxh3_128_digest(raw[8 * at[t] : 8 * at[t + 1]]))
                    sizes.append(n)
                    values.append(next(rows) if n else [])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)),
                    pa.array(identity, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(values, pa.list_(pa.int64())),
                ],
                names=["_k1", "_k2", "doc_id", "text_key", "n", "sketch"],
            )

    ship(docs.sparkSession)
    read = docs.select(*key_columns("doc_id", "text"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return read.mapInArrow(
        sketch, "_k1 long, _k2 long, doc_id long, text_key binary, n long, sketch array<long>"
    )


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Aligned k-mers over all k-mers of both texts, or 0.0 if it is below ``least``.

    ``a`` and ``b`` are labelled k-mers in text order; each occurs once in its text,
    so an alignment is a chain of shared k-mers that rises in both texts.
    """
    total = len(a) + len(b)
    if not total:
        return 1.0
    by_hash = np.argsort(a, kind="stable")
    place = np.searchsorted(a, b, sorter=by_hash)
    place[place == len(a)] = 0
    in_a = by_hash[place] if len(a) else place
    shared = np.flatnonzero(a[in_a] == b) if len(a) else np.zeros(0, dtype=int)

    def similarity(n: int) -> float:
        return n / (total - n)

    if similarity(len(shared)) < least:
        return 0.0
    # An alignment this similar skips at most this many k-mers, so it stays in the band.
    band = int(total * (1 - least) / (1 + least)) + 1
    first, second = in_a[shared], shared
    near = np.abs(first - second) <= band
    chain = first[near]
    if np.all(chain[1:] > chain[:-1]):
        n = len(chain)
    else:
        tails: list[int] = []
        for x in chain.tolist():
            at = bisect.bisect_left(tails, x)
            tails[at : at + 1] = [x]
        n = len(tails)
    found = similarity(n)
    return found if found >= least else 0.0


def _labelled_kmers(docs: DataFrame, wanted: DataFrame, plan: OrderMinHash) -> DataFrame:
    """Labelled k-mers of the wanted texts, as 32-bit numbers in text order."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, data, ends in _blocks(batch.column(1)):
                _, labelled, _, at = kmers(data, ends, plan.k)
                short = (labelled >> np.uint64(32)).astype("<u4")
                out += [short[at[t] : at[t + 1]].tobytes() for t in range(len(ends))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["text_key", "kmers"])

    ship(docs.sparkSession)
    keyed = docs.select(*key_columns("doc_id", "text"), F.col("text").cast("string").alias("text"))
    # Only texts that a key filter cannot rule out are moved for the join.
    chosen = may_match(keyed, wanted, KEY, FILTER_BLOCKS)
    # Rows of equal id and text have the same key; one of them is enough.
    return (
        chosen.join(wanted, KEY)
        .select("text_key", "text")
        .mapInArrow(label, "text_key binary, kmers binary")
        .dropDuplicates(["text_key"])
    )


def _verified(pairs: DataFrame, texts: DataFrame, plan: OrderMinHash) -> DataFrame:
    """The pairs (a, b) whose alignment is similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                aligned_similarity(
                    np.frombuffer(x.as_buffer(), dtype="<u4"), np.frombuffer(y.as_buffer(), dtype="<u4"), plan.least
                )
                > 0
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    first = texts.select(F.col("text_key").alias("a"), F.col("kmers").alias("_x"))
    second = texts.select(F.col("text_key").alias("b"), F.col("kmers").alias("_y"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "_x", "_y")
    return joined.mapInArrow(verify, "a binary, b binary")


def _samples(kmers_of: DataFrame, plan: OrderMinHash) -> DataFrame:
    """The smallest labelled k-mers of each text, the same ones in similar texts."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, values = [], [], []
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = np.frombuffer(raw.as_buffer(), dtype="<u4")
                if len(found) > plan.sample:
                    found = np.partition(found, plan.sample)[: plan.sample]
                keys += [key] * len(found)
                sizes += [len(found)] * len(found)
                values.append(found.astype(np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(np.concatenate(values))],
                    names=["text_key", "size", "kmer"],
                )

    return kmers_of.mapInArrow(sample, "text_key binary, size long, kmer long")


def _centrality(members: DataFrame, kmers_of: DataFrame, plan: OrderMinHash) -> DataFrame:
    """Per text how often others have its sampled k-mers, on average; edits lower it.

    Only texts of larger groups need it; in others every member leads.
    """
    crowded = members.where(F.col("_size") > plan.leaders).select("text_key").distinct()
    samples = stage(
        _samples(kmers_of.join(crowded, "text_key", "left_semi").select("text_key", "kmers"), plan), "near_samples"
    )
    # A k-mer of one text only counts once, without a join.
    common = samples.groupBy("kmer").agg(F.count("*").alias("_df")).where("_df > 1")
    found = samples.join(common, "kmer").groupBy("text_key", "size").agg(F.sum("_df").alias("_sum"), F.count("*").alias("_n"))
    return found.select("text_key", ((F.col("_sum") + F.col("size") - F.col("_n")) / F.col("size")).alias("_central"))


def shared_counts(texts: list[np.ndarray], left: np.ndarray, right: np.ndarray, width: int = 8192) -> np.ndarray:
    """Shared k-mers of each text of ``left`` with each of ``right``, by products of ``width`` k-mers at a time.

    A number that two k-mers of a text have in common counts for both, so a count is never too small.
    """
    out = np.zeros((len(left), len(right)))
    numbers = np.concatenate(texts)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    order = np.argsort(numbers, kind="stable")
    numbers, owner = numbers[order], owner[order]
    new = np.ones(len(numbers), dtype=bool)
    new[1:] = numbers[1:] != numbers[:-1]
    column = np.cumsum(new) - 1
    common = np.bincount(column)[column] > 1
    owner, column = owner[common], column[common]
    if not len(column):
        return out
    column = np.unique(column, return_inverse=True)[1]
    cuts = np.searchsorted(column, np.arange(0, column[-1] + width + 1, width))
    for k in range(len(cuts) - 1):
        a, b = cuts[k], cuts[k + 1]
        if a == b:
            continue
        w = int(column[b - 1]) - k * width + 1
        flat = np.bincount(owner[a:b] * w + column[a:b] - k * width, minlength=len(texts) * w)
        block = flat.reshape(len(texts), w).astype(np.float32)
        out += block[left] @ block[right].T
    return out


def prefix_sizes(n: Column, least: float) -> tuple[Column, Column]:
    """Of how many of its rarest k-mers a text shares one with any longer, and with any shorter, near text.

    Of the shorter of two texts of similarity ``least`` and the longer one, such prefixes in one common
    order have a k-mer in common: with ``s`` shared k-mers needed, two prefixes of n - s + 1 do.
    """
    shorter = n - F.ceil(n * (2 * least / (1 + least)) - 1e-9) + 1
    longer = n - F.ceil(n * least - 1e-9) + 1
    return shorter.cast("int"), longer.cast("int")


def _numbers(kmers_of: DataFrame) -> DataFrame:
    """The different k-mer numbers of each text, named by ``_id``, and how many they are."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(np.frombuffer(raw.as_buffer(), dtype="<u4")).astype(np.int64) for raw in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["_id", "numbers"]
            )

    flat = kmers_of.select("_id", "kmers").mapInArrow(number, "_id long, numbers array<long>")
    return flat.select("_id", F.size("numbers").alias("_different"), F.explode("numbers").alias("_value"))


def _prefixes(texts: DataFrame, kmers_of: DataFrame, plan: OrderMinHash) -> DataFrame:
    """Per text the k-mers of its prefix that other texts have too, rarest first, as ``prefix``.

    ``texts`` has text_key, a shorter name ``_id``, n and component. The first ``_short`` of them meet longer texts, all of them
    shorter ones. K-mers of one text only stand first in the order and meet nobody, so they just count.
    """
    each = stage(_numbers(kmers_of.join(texts.select("text_key", "_id"), "text_key")), "near_numbers")
    often = each.groupBy("_value").agg(F.count("*").alias("_df")).where("_df > 1")
    shared = (
        each.join(often, "_value")
        .groupBy("_id", "_different")
        .agg(F.sort_array(F.collect_list(F.struct("_df", "_value"))).alias("_order"))
    )
    alone = F.col("_different") - F.size("_order")
    short, long = (F.greatest(size - alone, F.lit(0)) for size in prefix_sizes(F.col("n"), plan.least))
    return (
        texts.join(shared, "_id")
        .select(
            "text_key", "n", "component", alone.alias("_alone"), short.alias("_short"),
            F.slice("_order", F.lit(1), long)["_value"].alias("prefix"),
        )
        .where(F.size("prefix") > 0)
    )


def tile_links(
    keys: list[bytes],
    texts: list[np.ndarray],
    side: np.ndarray,
    component: list,
    prefixes: list[tuple[int, list[int]]],
    value: int,
    least: float,
) -> list[tuple[int, int]]:
    """Links that join the components of a tile's texts, among the pairs that meet in k-mer ``value`` first.

    Side 0 has the shorter text of a pair, side 1 the longer; of equally long ones the lesser key is on side 0.
    """
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return []
    sizes = np.array([len(t) for t in texts])
    rank = np.empty(len(keys), dtype=np.int64)
    rank[sorted(range(len(keys)), key=keys.__getitem__)] = np.arange(len(keys))
    shared = shared_counts(texts, left, right)
    total = sizes[left][:, None] + sizes[right][None, :]
    likely = shared * (1 + least) >= least * total - 1e-6
    names = np.unique(np.array(component, dtype=object), return_inverse=True)[1]
    likely &= names[left][:, None] != names[right][None, :]
    same = sizes[left][:, None] == sizes[right][None, :]
    likely &= (sizes[left][:, None] < sizes[right][None, :]) | (same & (rank[left][:, None] < rank[right][None, :]))
    r, c = np.nonzero(likely)
    # The surest first, so that the others are mostly joined by then.
    order = np.argsort(-(shared[r, c] / total[r, c]), kind="stable")
    sets = {int(j): set(prefixes[j][1]) for j in np.unique(right[c])}
    root = list(range(int(names.max()) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for x, y in zip(left[r[order]].tolist(), right[c[order]].tolist(), strict=True):
        a, b = find(names[x]), find(names[y])
        if a == b:
            continue
        short, prefix = prefixes[x]
        if next((k for k in prefix[:short] if k in sets[y]), None) == value and aligned_similarity(texts[x], texts[y], least) > 0:
            root[a] = b
            found.append((x, y))
    return found


def _lists(prefixes: DataFrame, plan: OrderMinHash) -> DataFrame:
    """The texts of each k-mer ``_value`` of the prefixes, on the sides where they may stand.

    Side 0 is the shorter text of a pair. ``_pos`` is the k-mer's place in the text's order and ``_prev`` the
    k-mer before it: two texts with the same one have met there. ``_open`` are the texts that may still have to
    meet the others: all but those of the largest component, or all but those of the commonest ``_prev``. K-mers
    without open texts are left out.
    """
    flat = prefixes.select(
        "text_key", "n", "component", "_alone", "_short", "prefix", F.posexplode("prefix").alias("_at", "_value")
    ).select(
        "text_key",
        "n",
        "component",
        "_value",
        (F.col("_alone") + F.col("_at") + 1).alias("_pos"),
        F.when(F.col("_at") > 0, F.get("prefix", F.col("_at") - 1)).alias("_prev"),
        (F.col("_at") < F.col("_short")).alias("_in_short"),
    )
    joined = flat.groupBy("_value", "component").agg(F.count("*").alias("_n"))
    mains = joined.groupBy("_value").agg(F.max(F.struct("_n", "component")).alias("_main"), F.sum("_n").alias("_size"))
    met = (
        flat.where("_prev is not null")
        .groupBy("_value", "_prev")
        .agg(F.count("*").alias("_n"))
        .groupBy("_value")
        .agg(F.max(F.struct("_n", "_prev")).alias("_before"))
    )
    by_component = F.col("_main._n") >= F.coalesce("_before._n", F.lit(0))
    closed = F.when(by_component, F.col("_main._n")).otherwise(F.col("_before._n"))
    kept = stage(
        mains.join(met, "_value", "left")
        .select(
            "_value",
            "_size",
            (F.col("_size") - closed).alias("_opens"),
            F.when(by_component, F.col("_main.component")).alias("_main"),
            F.when(~by_component, F.col("_before._prev")).alias("_before"),
        )
        .where("_opens > 0"),
        "near_mains",
    )
    shut = F.coalesce(F.col("component") == F.col("_main"), F.lit(False)) | F.coalesce(
        F.col("_prev") == F.col("_before"), F.lit(False)
    )
    sides = F.when(F.col("_in_short"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    few = (F.col("_opens") <= FEW) | (F.col("_size") <= 4 * FEW)
    return flat.join(kept, "_value").select(
        "text_key", "n", "component", "_value", "_pos", "_prev", F.explode(sides).alias("_side"), (~shut).alias("_open"), few.alias("_few")
    )


def _few_pairs(lists: DataFrame, plan: OrderMinHash) -> DataFrame:
    """Pairs (a, b) of the k-mers with few open texts, each open one with all others, that may be similar.

    A pair that is similar passes in the first k-mer it has in common: behind it, enough k-mers are left.
    """
    columns = ["text_key", "n", "component", "_pos", "_prev", "_open"]
    shorter, longer = (
        lists.where(F.col("_few") & (F.col("_side") == k)).select("_value", *(F.col(c).alias(f"{c}{k}") for c in columns))
        for k in (0, 1)
    )
    needed = plan.least / (1 + plan.least) * (F.col("n0") + F.col("n1")) - 1e-6
    may = (
        (F.col("component0") != F.col("component1"))
        & ~F.coalesce(F.col("_prev0") == F.col("_prev1"), F.lit(False))
        & (F.struct("n0", "text_key0") < F.struct("n1", "text_key1"))
        & (F.least(F.col("n0") - F.col("_pos0"), F.col("n1") - F.col("_pos1")) + 1 >= needed)
        & (F.col("n0") >= needed)
    )
    sides = ((shorter.where("_open0"), longer), (shorter.where("not _open0"), longer.where("_open1")))
    pairs = [
        x.join(y, (x["_value"] == y["_value"]) & may).select(F.col("text_key0").alias("a"), F.col("text_key1").alias("b"))
        for x, y in sides
    ]
    return pairs[0].union(pairs[1]).distinct()


def _tiles(lists: DataFrame, plan: OrderMinHash) -> DataFrame:
    """Texts of the k-mers with many open texts, once for each tile they are in.

    Two texts that are not open need no tile; neither do lengths that are more than one class apart.
    """
    # Slightly wider classes than the bound, so that rounding cannot part a pair by two.
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(1.01 / plan.least)).cast("int")
    sided = stage(
        lists.where("not _few").select("text_key", "component", "_value", "_side", band.alias("_band"), "_open"), "near_sided"
    )
    cells = stage(
        sided.groupBy("_value", "_side", "_band", "_open").agg(F.ceil(F.count("*") / plan.tile).cast("int").alias("_chunks")),
        "near_cells",
    )
    each = cells.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    shorter, longer = (
        each.where(F.col("_side") == k).select("_value", *(F.col(c).alias(f"{c}{k}") for c in CELL)) for k in (0, 1)
    )
    pairs = stage(
        shorter.join(longer, "_value")
        .where((F.col("_band1") - F.col("_band0")).isin(0, 1) & (F.col("_open0") | F.col("_open1")))
        .select("*", F.concat_ws(",", *(F.col(f"{c}{k}").cast("string") for k in (0, 1) for c in CELL)).alias("_tile")),
        "near_tile_pairs",
    )
    ends = [
        pairs.select("_value", "_tile", F.lit(k).alias("_side"), *(F.col(f"{c}{k}").alias(c) for c in CELL)) for k in (0, 1)
    ]
    placed = sided.join(cells, ["_value", "_side", "_band", "_open"]).withColumn(
        "_chunk", F.pmod(F.xxhash64("text_key"), F.col("_chunks")).cast("int")
    )
    return placed.join(ends[0].union(ends[1]), ["_value", "_side", *CELL]).select(*TILE, "_side", "text_key", "component")


def _tile_links(tiles: DataFrame, plan: OrderMinHash) -> DataFrame:
    """Links (a, b) found in the tiles."""

    def links_of(table: pa.Table) -> tuple[list, list]:
        names, parts = table.column("text_key").to_pylist(), table.column("component").to_pylist()
        texts = [np.frombuffer(x.as_buffer(), dtype="<u4") for x in table.column("kmers")]
        side, value = table.column("_side").to_numpy(), table.column("_value").to_numpy()
        prefixes = list(zip(table.column("_short").to_pylist(), table.column("prefix").to_pylist(), strict=True))
        marks = list(zip(*(table.column(c).to_pylist() for c in TILE), strict=True))
        bounds = [0, *(k for k in range(1, len(marks)) if marks[k] != marks[k - 1]), len(marks)]
        a, b = [], []
        for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
            run = slice(start, stop)
            for x, y in tile_links(names[run], texts[run], side[run], parts[run], prefixes[run], int(value[start]), plan.least):
                a.append(names[start + x])
                b.append(names[start + y])
        return a, b

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def batch_of(table: pa.Table) -> pa.RecordBatch:
            a, b = links_of(table)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            # The last tile may go on in the next batch.
            same = np.logical_and.reduce([pc.equal(held.column(c), held.column(c)[-1]).to_numpy() for c in TILE])
            cut = int(np.argmax(same))
            if cut:
                yield batch_of(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None:
            yield batch_of(held)

    ship(tiles.sparkSession)
    ordered = tiles.select(*TILE, "_side", "text_key", "component", "_short", "prefix", "kmers")
    return ordered.repartition(*TILE).sortWithinPartitions(*TILE).mapInArrow(compare, "a binary, b binary")


def _unjoined(members: DataFrame) -> DataFrame:
    """Texts of the groups that are not one component: text_key, n, component, and a number as ``_id``."""
    ends = members.groupBy(*GROUP).agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    mixed = ends.where("_low != _high").select(*GROUP)
    texts = members.join(mixed, GROUP).select("text_key", "n", "component").distinct()
    return stage(texts.withColumn("_id", F.monotonically_increasing_id()), "near_unjoined")


def text_links(docs: DataFrame, rows: DataFrame, plan: OrderMinHash) -> DataFrame:
    """Component of each linked text: ``id`` (a text key) and ``component``."""
    texts = stage(
        rows.where("n > 0")
        .groupBy("text_key")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *KEY, "n", "sketch")).alias("_one"),
        )
        .select("text_key", "_one._k1", "_one._k2", "_one.n", "_one.sketch"),
        "near_texts",
    )
    values = texts.select("text_key", F.posexplode("sketch").alias("_i", "_value"))
    shared = stage(
        values.groupBy(*GROUP).agg(F.count("*").alias("_size")).where("_size > 1"), "near_shared"
    )
    members = stage(values.join(shared, GROUP), "near_values")
    wanted = stage(
        texts.join(members.select("text_key").distinct(), "text_key", "left_semi").select("text_key", *KEY), "near_wanted"
    )
    kmers_of = stage(_labelled_kmers(docs, wanted, plan), "near_kmers")
    members = stage(
        members.select("text_key", *GROUP)
        .join(_centrality(members, kmers_of, plan), "text_key", "left")
        .select("text_key", *GROUP, F.coalesce("_central", F.lit(0.0)).alias("_central")),
        "near_members",
    )

    def lead(candidates: DataFrame, name: str, *part: str) -> DataFrame:
        best = F.max(F.struct("_central", "text_key"))["text_key"]
        return stage(candidates.groupBy(*GROUP, *part).agg(best.alias("leader")).select(*GROUP, "leader"), name)

    def compare(open_rows: DataFrame, leaders: DataFrame, done: DataFrame | None, name: str):
        pairs = (
            open_rows.join(leaders, GROUP)
            .where("text_key != leader")
            .select(F.col("text_key").alias("a"), F.col("leader").alias("b"))
            .distinct()
        )
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = stage(pairs, f"near_pairs_{name}")
        return pairs, stage(_verified(pairs, kmers_of, plan), f"near_links_{name}")

    # First every text against the most central one of its groups.
    main = lead(members, "near_main")
    done, links = compare(members, main, None, "main")
    # Then those without a link to it against several, one from each part of the group.
    linked = links.select(F.col("a").alias("text_key"), F.col("b").alias("leader"))
    open_rows = stage(
        members.join(main, GROUP)
        .where("text_key != leader")
        .join(linked, ["text_key", "leader"], "left_anti")
        .select("text_key", *GROUP, "_central"),
        "near_open",
    )
    part = F.pmod(F.xxhash64("text_key"), F.lit(plan.leaders))
    several = lead(members.withColumn("_part", part), "near_several", "_part")
    _, found = compare(open_rows, several, done, "several")
    links = links.union(found)
    # Then every pair of a group that is not in one component yet.
    labels = components(links, "near_second").withColumnRenamed("id", "text_key")
    placed = (
        members.select("text_key", *GROUP)
        .join(texts.select("text_key", "n"), "text_key")
        .join(labels, "text_key", "left")
        .withColumn("component", F.coalesce("component", "text_key"))
    )
    prefixes = stage(_prefixes(_unjoined(stage(placed, "near_placed")), kmers_of, plan), "near_prefixes")
    lists = stage(_lists(prefixes, plan), "near_lists")
    pairs = stage(_few_pairs(lists, plan), "near_pairs_few")
    links = links.union(stage(_verified(pairs, kmers_of, plan), "near_links_few"))
    tiles = stage(_tiles(lists, plan), "near_tiles")
    full = tiles.join(prefixes.select("text_key", "_short", "prefix"), "text_key").join(kmers_of, "text_key")
    return components(links.union(stage(_tile_links(full, plan), "near_links_tiles")), "near_final")


def classes(docs: DataFrame, plan: OrderMinHash = OrderMinHash()) -> DataFrame:
    """Per row its key, ``doc_id``, ``class_id`` (smallest id of its class), and ``kept``.

    One row of each class is kept: the one with the smallest id and key.
    """
    rows = stage(_sketch_table(docs, plan), "near_rows")
    linked = text_links(docs, rows, plan)
    # Linked texts share their component; others are a class of their own.
    placed = rows.select(*KEY, "doc_id", "text_key").join(
        linked.withColumnRenamed("id", "text_key"), "text_key", "left"
    )
    classed = stage(
        placed.select(*KEY, "doc_id", F.coalesce("component", "text_key").alias("_class")), "near_classed"
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *KEY)
    first = stage(
        classed.groupBy("_class").agg(F.min(order).alias("_first"), F.count("*").alias("class_size")), "near_first"
    )
    return classed.join(first, "_class").select(
        *KEY,
        "doc_id",
        F.col("_first.doc_id").alias("class_id"),
        "class_size",
        ((F.col("_k1") == F.col("_first._k1")) & (F.col("_k2") == F.col("_first._k2"))).alias("kept"),
    )


def class_report(docs: DataFrame, plan: OrderMinHash = OrderMinHash()) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept."""
    return classes(docs, plan).select("doc_id", "class_id", "class_size", "kept")


def one_per_class(docs: DataFrame, plan: OrderMinHash = OrderMinHash()) -> DataFrame:
    """The first document of each class, with the columns of documents."""
    kept = stage(classes(docs, plan).where("kept").select(*KEY).distinct(), "near_kept")
    keyed = docs.select(*key_columns("doc_id", "text"), F.struct(*docs.columns).alias("_doc"))
    # Rows of equal id and text are copies of each other, so one stays.
    return keyed.join(kept, KEY).dropDuplicates(KEY).select("_doc.*")
