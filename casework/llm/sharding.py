"""Sharding along a Hilbert curve over document metadata.

Language, source and length are quantised to ``bits`` bits each and turned into
an index on the Hilbert curve. Groups of equal texts are sorted by that index
and the sorted run is cut into shards of nearly equal bytes (law ``bytes``), so
every shard covers a small range of each dimension and files can be pruned by
any of them. A slot is a row's place in its shard, along the curve.

Equal texts stay together. A group takes the smallest language and source of
its rows, so it has one place on the curve, and a cut never falls within a
group unless the group is larger than a shard. Groups above ``large`` of a shard
(at most shards / large of them, so they fit the driver) are given to shards
first, near their place on the curve; the other groups fill what remains. Only
a group above a whole shard (at most as many as there are shards) is spread by row.

The quantisers cover every value. Length is logarithmic. Language and source
count how many of the ``2**bits - 1`` commonest values are not above the value;
rarer values fall between them.

Defined results: null text has size 16 and the checksum of the empty text, but
forms a group apart from it; null language or source is quantised first;
repeated rows are rows of their own in one group; an empty table gives an empty
table. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import range_totals, stage

DIMENSIONS = 3


@dataclass(frozen=True)
class Layout:
    shards: int = 40
    bits: int = 6
    large: float = 0.05
    row_bytes: int = 16


def curve_table(n: int) -> tuple[list[int], list[int]]:
    """Hilbert curve of n dimensions as an automaton: digit and next state by state and corner.

    A state is the entry corner and the direction of a cell; Gray code gives the
    order of corners, and the entry and direction of each sub-cell follow from it.
    """
    mask = (1 << n) - 1

    def turn_right(x: int, k: int) -> int:
        k %= n
        return ((x >> k) | (x << (n - k))) & mask

    def turn_left(x: int, k: int) -> int:
        return turn_right(x, n - k % n)

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def trailing_ones(i: int) -> int:
        count = 0
        while i & 1:
            i, count = i >> 1, count + 1
        return count

    place = {gray(i): i for i in range(1 << n)}
    digits, states = [], []
    for state in range(n << n):
        entry, direction = divmod(state, n)
        for corner in range(1 << n):
            w = place[turn_right(corner ^ entry, direction + 1)]
            sub_entry = 0 if w == 0 else gray(2 * ((w - 1) // 2))
            sub_direction = (
                0 if w == 0 else trailing_ones(w - 1) % n if w % 2 == 0 else trailing_ones(w) % n
            )
            digits.append(w)
            states.append(
                (entry ^ turn_left(sub_entry, direction + 1)) * n
                + (direction + sub_direction + 1) % n
            )
    return digits, states


def hilbert_index(coordinates: list[Column], bits: int) -> Column:
    """Index on the curve of columns with values below ``2**bits``, from the top bit down."""
    n = len(coordinates)
    digits, states = curve_table(n)
    digit_of = F.array(*(F.lit(d) for d in digits))
    state_of = F.array(*(F.lit(s) for s in states))

    def step(walked: Column, level: Column) -> Column:
        corner = F.lit(0)
        for i, c in enumerate(coordinates):
            bit = (c / F.pow(F.lit(2.0), level)).cast("int") % 2
            corner = corner + bit * (1 << i)
        at = walked["state"] * (1 << n) + corner.cast("int")
        return F.struct(
            (walked["index"] * (1 << n) + F.get(digit_of, at)).cast("long").alias("index"),
            F.get(state_of, at).cast("int").alias("state"),
        )

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    levels = F.array(*(F.lit(k) for k in reversed(range(bits))))
    return F.aggregate(levels, start, step, lambda walked: walked["index"])


def _common_values(groups: DataFrame, column: str, n: int) -> list[str]:
    """The n commonest values in order; a bounded dictionary for the quantiser."""
    top = (
        groups.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.sum("_rows").alias("_rows"))
        .orderBy(F.desc("_rows"), column)
        .limit(n)
    )
    return sorted((r[column] for r in top.collect()), key=lambda v: v.encode())


def _rank(column: str, values: list[str]) -> Column:
    known = F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")
    return F.coalesce(F.size(F.filter(known, lambda v: v <= F.col(column))), F.lit(0))


def assign_large(groups: list[tuple[int, float]], total: int, shards: int) -> tuple[list[int], list[float]]:
    """Shard of each large group, and the ends of the shards' shares of the other bytes.

    ``groups`` has bytes and place on the curve (0 to 1) of each. A group goes to the
    shard nearest its place that has room for it, or else to the emptiest.
    """
    share, filled = total / shards, [0.0] * shards
    chosen = [0] * len(groups)
    for i in sorted(range(len(groups)), key=lambda i: (-groups[i][0], groups[i][1])):
        size, place = groups[i]
        room = [s for s in range(shards) if filled[s] + size <= share]
        home = place * shards
        chosen[i] = (
            min(room, key=lambda s: (abs(s + 0.5 - home), s))
            if room
            else min(range(shards), key=lambda s: (filled[s], s))
        )
        filled[chosen[i]] += size
    left = [max(share - f, 0.0) for f in filled]
    scale = (total - sum(filled)) / sum(left) if sum(left) else 0.0
    ends, at = [], 0.0
    for part in left[:-1]:
        at += part * scale
        ends.append(at)
    return chosen, ends


def shard(docs: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard and the curve index."""
    binary = F.encode(F.col("text"), "UTF-8")
    rows = stage(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + layout.row_bytes).cast("long").alias("size"),
            F.crc32(F.coalesce(binary, F.lit(b""))).alias("text_crc32"),
            F.xxhash64(F.col("text").isNull(), "text").alias("_g1"),
            F.xxhash64(F.lit("second"), F.col("text").isNull(), "text").alias("_g2"),
            F.coalesce(F.length("text"), F.lit(0)).alias("_chars"),
            F.col("lang").alias("_lang"),
            F.col("source").alias("_source"),
        ),
        "shard_rows",
    )
    groups = stage(
        rows.groupBy("_g1", "_g2").agg(
            F.min("_lang").alias("_lang"),
            F.min("_source").alias("_source"),
            F.min("_chars").alias("_chars"),
            F.sum("size").alias("_bytes"),
            F.count("*").alias("_rows"),
        ),
        "shard_groups",
    )
    most = (1 << layout.bits) - 1
    langs, sources = (_common_values(groups, c, most) for c in ("_lang", "_source"))
    quantised = groups.withColumns(
        {
            "_q0": _rank("_lang", langs),
            "_q1": _rank("_source", sources),
            "_q2": F.least(F.floor(F.log2(F.col("_chars") + 1) * 4).cast("int"), F.lit(most)),
        }
    )
    indexed = quantised.select(
        "_g1",
        "_g2",
        "_bytes",
        "_rows",
        hilbert_index([F.col(f"_q{i}") for i in range(DIMENSIONS)], layout.bits).alias("hilbert"),
    )
    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    share = total / layout.shards
    is_large = (F.col("_bytes") > layout.large * share) & (F.col("_bytes") <= share)
    # Two running totals along the curve: of all bytes, and of those not in large groups.
    placed = stage(
        range_totals(
            indexed.withColumn("_small", F.when(is_large, 0).otherwise(F.col("_bytes"))),
            ["hilbert", "_g1", "_g2"],
            ["_bytes", "_small"],
            "shard_curve",
        ),
        "shard_placed",
    )
    large = placed.where(is_large).select("_g1", "_g2", "_bytes", "_bytes_before").collect()
    chosen, ends = assign_large(
        [(r["_bytes"], (r["_bytes_before"] + r["_bytes"] / 2) / total) for r in large], total, layout.shards
    )
    wide = F.col("_bytes") > share
    cut = _count_below(ends, F.col("_small_before") + F.col("_bytes") / 2)
    given = docs.sparkSession.createDataFrame(
        [(r["_g1"], r["_g2"], s) for r, s in zip(large, chosen, strict=True)], "_g1 long, _g2 long, _given int"
    )
    whole = placed.join(given, ["_g1", "_g2"], "left").select(
        "_g1",
        "_g2",
        "hilbert",
        F.when(wide, F.col("_small_before")).alias("_wide_before"),
        F.when(~wide, F.coalesce("_given", cut)).alias("_shard"),
    )
    joined = rows.select("doc_id", "size", "text_crc32", "_g1", "_g2").join(
        stage(whole, "shard_whole"), ["_g1", "_g2"]
    )
    if placed.where(wide).limit(1).count():
        joined = _spread(stage(joined, "shard_joined"), ends)
    ranked = range_totals(
        joined.withColumn("_one", F.lit(1).cast("long")),
        ["_shard", "hilbert", "_g1", "_g2", "doc_id"],
        ["_one"],
        "shard_ranked",
    )
    ranked = stage(ranked, "shard_numbered")
    # One row per shard.
    starts = ranked.groupBy("_shard").agg(F.min("_one_before").alias("_start"))
    return ranked.join(F.broadcast(starts), "_shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_one_before") - F.col("_start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )


def _count_below(ends: list[float], value: Column) -> Column:
    """How many of the ends are at or below a value."""
    known = F.array(*(F.lit(float(e)) for e in ends)) if ends else F.array().cast("array<double>")
    return F.size(F.filter(known, lambda e: e <= value))


def _spread(joined: DataFrame, ends: list[float]) -> DataFrame:
    """Cut the groups that are larger than a shard by row; equal texts have equal sizes."""
    single = joined.where("_wide_before is null")
    many = joined.where("_wide_before is not null")
    ranked = stage(
        range_totals(many, ["_g1", "_g2", "doc_id"], ["size"], "shard_wide"), "shard_wide_ranked"
    )
    # At most as many groups as shards.
    first = ranked.groupBy("_g1", "_g2").agg(F.min("size_before").alias("_first"))
    middle = F.col("_wide_before") + F.col("size_before") - F.col("_first") + F.col("size") / 2
    cut = ranked.join(F.broadcast(first), ["_g1", "_g2"]).withColumn("_shard", _count_below(ends, middle))
    return single.unionByName(cut.select(*single.columns))
