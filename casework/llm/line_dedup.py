"""Removal of repeated runs of lines, by a suffix array over sequences of line ids.

Every document is a sequence of line ids. Lines that occur once cut it into stretches and
end every repeated run, so the suffix array holds the suffixes that begin with a repeated
line, each up to the end of its stretch. Prefix doubling sorts them: the rank by the first
2**(k+1) lines comes from the rank by the first 2**k and that of the suffix 2**k lines on.
Only the different pairs of ranks are sorted, by range, and a rank is the number of
suffixes with smaller ones. Documents all of whose suffixes are settled leave.

Neighbours in the array share a longest common prefix. Suffixes with h lines in common
form an interval of it, and the longest run of a suffix that occurs earlier in the corpus
(by document id and line) is that of the deepest interval in which it is not the first.
One scan over the array in either direction finds it with a stack of open intervals; blocks
of the array are scanned apart, and the intervals open at their edges are carried over.
Such runs of ``words`` words or more are deleted: what they cover together are the maximal
repeated runs, and their first copy stays. Text of scripts without spaces counts by its
characters.

Defined results: null text stays null; a text without a repeated run stays as it
is, and one whose lines all go becomes empty; rows equal in id and text are one
document for the search and get the same text; null ids come last; lines must be
equal to the character; an empty table gives an empty table. Further columns of
the documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.llm.common import key_columns, range_totals, ship, stage
from casework.llm.mixing import WORD

#: Words from which a repeated run counts.
WORDS = 8
#: Characters of scripts without spaces that count as one more word: about a word's length.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]{2}|[\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]{4}"
#: Suffixes in a block of the array, which one task scans at a time.
BLOCK = 1 << 14
#: All characters of these scripts lie here, few of others do.
UNSPACED_RANGE = r"[\u0E00-\u1FFF\u2E80-\x{10FFFF}]"
KEY = ["_k1", "_k2"]
ID = ["_r1", "_r2"]


def _line_table(docs: DataFrame) -> DataFrame:
    lines = docs.select(
        *key_columns("doc_id", "text"), "doc_id", F.posexplode(F.split("text", "\n")).alias("_pos", "_line")
    )
    line = F.col("_line")
    # Two Han or four Thai characters take at least four bytes more than characters, so most lines have none.
    may = (F.octet_length(line) - F.length(line) >= 4) & line.rlike(UNSPACED_RANGE)
    unspaced = F.when(may, F.regexp_count(line, F.lit(UNSPACED))).otherwise(0)
    # Words parted by single spaces only are counted by the spaces.
    other = line.startswith(" ") | line.endswith(" ") | line.contains("  ") | (line == "")
    for blank in "\t\x0b\x0c\r":
        other = other | line.contains(blank)
    by_spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    spaced = F.when(other, F.regexp_count(line, F.lit(WORD))).otherwise(by_spaces)
    return lines.select(
        *KEY,
        "doc_id",
        "_pos",
        (spaced + unspaced).alias("_words"),
        F.xxhash64("_line").alias("_r1"),
        F.xxhash64(F.lit("second"), "_line").alias("_r2"),
    )


def _repeated_lines(docs: DataFrame) -> DataFrame:
    """Lines that occur more than once, numbered in the order of the corpus, with the lines left in their stretch."""
    lines = stage(_line_table(docs), "line_ids")
    often = stage(lines.groupBy(*ID).agg(F.count("*").alias("_n")).where("_n > 1").select(*ID), "line_often")
    rows = lines.join(often, ID).dropDuplicates([*KEY, "_pos"])
    inside = Window.partitionBy(*KEY).orderBy("_pos")
    rows = rows.withColumn("_stretch", F.col("_pos") - F.row_number().over(inside))
    last = F.max("_pos").over(Window.partitionBy(*KEY, "_stretch"))
    rows = rows.select(
        *KEY, "_pos", "_words", *ID, (last - F.col("_pos") + 1).alias("_left"),
        F.col("doc_id").isNull().alias("_no_id"), "doc_id", F.lit(1).alias("_one"),
    )
    placed = range_totals(rows, ["_no_id", "doc_id", *KEY, "_pos"], ["_one"], "line_repeated")
    return stage(
        placed.select(F.col("_one_before").alias("_place"), *KEY, "_pos", "_words", *ID, "_left"), "line_places"
    )


def _ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``_rank``: the number of rows with smaller keys; ``_n``: that of rows with the same ones.

    Only the different keys are sorted, so a frequent one is a single row there.
    """
    counted = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    order = range_totals(counted, keys, ["_n"], f"{name}_order").withColumnRenamed("_n_before", "_rank")
    return rows.join(order, keys)


def suffix_ranks(lines: DataFrame) -> DataFrame:
    """Every suffix with its ranks by its first 1, 2, 4, ... lines in ``_path``.

    The order of the paths is that of the suffixes, and equal suffixes have equal ranks as
    far as both have any.
    """
    columns = ["_place", *KEY, "_pos", "_left"]
    table = stage(
        _ranked(lines, ID, "line_level0").select(*columns, "_rank", "_n", F.array("_rank").alias("_path")),
        "line_level0",
    )
    settled, half = [], 1
    while not table.where((F.col("_n") > 1) & (F.col("_left") > half)).isEmpty():
        doc = Window.partitionBy(*KEY)
        there = F.first("_rank").over(doc.orderBy("_pos").rangeBetween(half, half))
        ahead = stage(
            table.select(
                *columns,
                F.col("_rank").alias("_here"),
                F.when(F.col("_left") > half, there).otherwise(-1).alias("_next"),
                F.max((F.col("_n") > 1) & (F.col("_left") >= half)).over(doc).alias("_open"),
                "_path",
            ),
            f"line_ahead{half}",
        )
        settled.append(ahead.where("not _open").select("_place", "_left", "_path"))
        table = stage(
            _ranked(ahead.where("_open"), ["_here", "_next"], f"line_level{half}").select(
                *columns, "_rank", "_n", F.array_append("_path", F.col("_rank")).alias("_path")
            ),
            f"line_level{half}",
        )
        half *= 2
    out = table.select("_place", "_left", "_path")
    for part in settled:
        out = out.unionByName(part)
    return out


def _compared(pairs: DataFrame) -> DataFrame:
    """Pairs with ``_lcp`` raised by what their ranks tell, and in ``_jump`` how far on to go on (0: done).

    With k equal ranks and then a different one they share 2**(k-1) lines at least; with
    equal ranks throughout they are equal.
    """
    levels = F.least(F.size("_path"), F.size("_path2"))
    equal = F.zip_with(F.slice("_path", 1, levels), F.slice("_path2", 1, levels), lambda a, b: a == b)
    differs = F.array_position(equal, False)
    shared = (
        F.when(differs == 0, F.least("_left", "_left2"))
        .when(differs == 1, 0)
        .otherwise(F.pow(F.lit(2), differs - 2))
        .cast("int")
    )
    goes_on = (differs > 2) & (F.least("_left", "_left2") > shared)
    return pairs.withColumns({"_lcp": F.col("_lcp") + shared, "_jump": F.when(goes_on, shared).otherwise(0)})


def suffix_array(lines: DataFrame) -> DataFrame:
    """The suffixes in order: ``_sa`` from 0, and ``_lcp``, the lines shared with the one before.

    Equal suffixes stand together, in any order. What neighbours share behind the lines of
    their highest equal rank is looked up in the ranks of the two suffixes that far on.
    """
    ranks = stage(suffix_ranks(lines), "line_ranks")
    array = stage(
        range_totals(ranks.withColumn("_one", F.lit(1)), ["_path", "_place"], ["_one"], "line_sorted").select(
            "_place", "_left", "_path", F.col("_one_before").alias("_sa")
        ),
        "line_array",
    )
    before = array.select((F.col("_sa") + 1).alias("_sa"), *(F.col(c).alias(f"{c}2") for c in ("_place", "_left", "_path")))
    pairs = stage(_compared(array.join(before, "_sa").withColumn("_lcp", F.lit(0))), "line_pairs0")
    known, step = [pairs], 0
    ahead = ranks.select("_place", "_left", "_path")
    ahead2 = ranks.select(*(F.col(c).alias(f"{c}2") for c in ahead.columns))
    while not (more := pairs.where("_jump > 0")).isEmpty():
        step += 1
        moved = more.select(
            "_sa", "_lcp", (F.col("_place") + F.col("_jump")).alias("_place"), (F.col("_place2") + F.col("_jump")).alias("_place2")
        )
        pairs = stage(_compared(moved.join(ahead, "_place").join(ahead2, "_place2")), f"line_pairs{step}")
        known.append(pairs)
    lcp = known[0].where("_jump = 0").select("_sa", "_lcp")
    for part in known[1:]:
        lcp = lcp.unionByName(part.where("_jump = 0").select("_sa", "_lcp"))
    return stage(
        array.select("_sa", "_place", "_left").join(lcp, "_sa", "left").fillna(0, ["_lcp"]), "line_suffixes"
    )


def scan(places: list[int], shared: list[int], stack: list[tuple[int, int]]) -> list[int]:
    """Lines that each suffix shares with the nearest one earlier in the corpus that was scanned before it.

    ``shared`` has the lines shared with the suffix scanned just before. ``stack`` holds the
    open intervals and is updated: their first places, in rising order, each with the lines
    shared with the one below it.
    """
    out = []
    for place, least in zip(places, shared, strict=True):
        while stack and stack[-1][0] > place:
            least = min(least, stack.pop()[1])
        if least == 0:
            stack.clear()
        out.append(least if stack else 0)
        stack.append((place, least))
    return out


def frontier(stack: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The open intervals that later suffixes can tell apart: the first place of each depth."""
    kept, depth = [], None
    for place, shared in reversed(stack):
        if kept and kept[-1][2] == depth:
            kept.pop()
        kept.append((place, shared, depth))
        depth = shared if depth is None else min(depth, shared)
    # Kept from the top down; what one shares with the next below is the depth of that one.
    out = [(p, kept[i + 1][2] if i + 1 < len(kept) else s) for i, (p, s, _) in enumerate(kept)]
    return out[::-1]


def carried(stack: list[tuple[int, int]], block: list[tuple[int, int]], edge: int) -> list[tuple[int, int]]:
    """Open intervals after a block, from those before it and those that the block alone leaves open.

    ``edge`` has the lines that the block's first suffix shares with the one scanned before.
    """
    place, least = block[0]
    least, stack = min(least, edge), list(stack)
    while stack and stack[-1][0] > place:
        least = min(least, stack.pop()[1])
    if least == 0:
        stack = []
    return frontier([*stack, (place, least), *block[1:]])


NO_EDGE = 2**31 - 1
STACK = "array<long>"


def _block_rows(table: pa.Table) -> tuple[list[int], list[int], list[int]]:
    table = table.sort_by("_sa")
    return tuple(table[c].to_pylist() for c in ("_sa", "_place", "_lcp"))


def _summary(table: pa.Table) -> pa.Table:
    """What a block leaves open at its end, and at its start when scanned backwards."""
    _, places, lcp = _block_rows(table)
    up, down = [], []
    scan(places, lcp, up)
    scan(places[::-1], [NO_EDGE, *lcp[:0:-1]], down)
    flat = [[[x for e in frontier(stack) for x in e]] for stack in (up, down)]
    return pa.table(
        [table["_block"][:1].combine_chunks(), pa.array(lcp[:1], pa.int32()), *(pa.array(f, pa.list_(pa.int64())) for f in flat)],
        names=["_block", "_edge", "_up", "_down"],
    )


def _pairs(flat: list[int]) -> list[tuple[int, int]]:
    return list(zip(flat[::2], flat[1::2], strict=True))


def _longest(table: pa.Table, carry: pa.Table) -> pa.Table:
    """Per suffix the lines of its longest run that occurs earlier, if any."""
    _, places, lcp = _block_rows(table)
    given = carry.to_pylist()[0]
    up = scan(places, lcp, _pairs(given["_up"]))
    down = scan(places[::-1], [given["_edge"], *lcp[:0:-1]], _pairs(given["_down"]))[::-1]
    best = [(p, max(a, b)) for p, a, b in zip(places, up, down, strict=True) if a or b]
    return pa.table(
        [pa.array([p for p, _ in best], pa.int64()), pa.array([n for _, n in best], pa.int32())], names=["_place", "_length"]
    )


def _carries(summaries: list) -> list[tuple[int, int, list[int], list[int]]]:
    """What each block starts from in either direction, from the summaries in the order of blocks."""
    flat = lambda stack: [x for e in stack for x in e]
    ups, stack = [], []
    for s in summaries:
        ups.append(flat(stack))
        stack = carried(stack, _pairs(s["_up"]), s["_edge"])
    downs, stack, edge = [], [], 0
    for s in reversed(summaries):
        downs.append((edge, flat(stack)))
        stack = carried(stack, _pairs(s["_down"]), edge)
        edge = s["_edge"]
    return [(s["_block"], e, up, down) for s, up, (e, down) in zip(summaries, ups, reversed(downs), strict=True)]


def earlier_runs(array: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per suffix with a run that occurs earlier: its place and the lines of the longest one.

    The driver holds one row per block of the array: the intervals open at its edges, at
    most one for each number of shared lines.
    """
    spark = array.sparkSession
    ship(spark)
    blocks = array.withColumn("_block", F.floor(F.col("_sa") / block)).select("_block", "_sa", "_place", "_lcp")
    found = blocks.groupBy("_block").applyInArrow(_summary, f"_block long, _edge int, _up {STACK}, _down {STACK}")
    carries = spark.createDataFrame(
        _carries(stage(found, "line_blocks").orderBy("_block").collect()),
        f"_block long, _edge int, _up {STACK}, _down {STACK}",
    )
    return (
        blocks.groupBy("_block").cogroup(carries.groupBy("_block")).applyInArrow(_longest, "_place long, _length int")
    )


def spans(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs joined where they touch: first and last line of each."""
    out: list[tuple[int, int]] = []
    for start, length in sorted(runs):
        if out and start <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], start + length - 1))
        else:
            out.append((start, start + length - 1))
    return out


def covered(positions: list[int], words: list[int], lengths: list[int], least: int) -> list[tuple[int, int]]:
    """First and last line of the stretches covered by the runs of ``least`` words or more.

    ``positions`` are a document's repeated lines in order and ``lengths`` the runs that begin there.
    """
    before = [0, *accumulate(words)]
    return spans([(p, n) for i, (p, n) in enumerate(zip(positions, lengths, strict=True)) if n and before[i + n] - before[i] >= least])


def deleted_spans(docs: DataFrame, words: int = WORDS, block: int = BLOCK) -> DataFrame:
    """Per document that loses lines: its key, and first and last line of each deleted stretch."""
    lines = _repeated_lines(docs)
    runs = stage(earlier_runs(suffix_array(lines), block), "line_runs")
    per_doc = (
        lines.join(runs, "_place", "left")
        .groupBy(*KEY)
        .agg(
            F.sort_array(F.collect_list(F.struct("_pos", "_words", F.coalesce("_length", F.lit(0)).alias("_length")))).alias("_lines"),
            F.count("_length").alias("_runs"),
        )
        .where("_runs > 0")
    )
    schema = "_k1 long, _k2 long, _from array<int>, _to array<int>"

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, *columns = batch.columns
            joined = [covered(*doc, words) for doc in zip(*(c.to_pylist() for c in columns), strict=True)]
            out = pa.RecordBatch.from_arrays(
                [
                    k1,
                    k2,
                    pa.array([[a for a, _ in j] for j in joined], pa.list_(pa.int32())),
                    pa.array([[b for _, b in j] for j in joined], pa.list_(pa.int32())),
                ],
                names=["_k1", "_k2", "_from", "_to"],
            )
            yield out.filter(pa.array([bool(j) for j in joined], pa.bool_()))

    ship(docs.sparkSession)
    return per_doc.select(*KEY, "_lines._pos", "_lines._words", "_lines._length").mapInArrow(join_up, schema)


def _without(text: Column) -> Column:
    """The text without the lines of the spans: what lies between one span and the next."""
    lines, n = F.split(text, "\n"), F.size("_from")
    pieces = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.slice(
            lines,
            F.when(i > 0, F.get("_to", i - 1) + 2).otherwise(1),
            F.greatest(
                F.when(i < n, F.get("_from", i)).otherwise(F.size(lines))
                - F.when(i > 0, F.get("_to", i - 1) + 1).otherwise(0),
                F.lit(0),
            ),
        ),
    )
    return F.array_join(F.flatten(pieces), "\n")


def deduped(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The documents without later copies, with their columns; ``n_chars`` follows the text."""
    found = stage(deleted_spans(docs, words), "line_spans")
    keyed = docs.select(*key_columns("doc_id", "text"), F.struct(*docs.columns).alias("_doc"))
    joined = keyed.join(found, KEY, "left")
    text = F.when(F.col("_from").isNull(), F.col("_doc.text")).otherwise(_without(F.col("_doc.text")))
    out = joined.select(*(F.col("_doc")[c].alias(c) for c in docs.columns if c != "text"), text.alias("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def line_report(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, lines, deleted lines, deleted stretches, the text that stays."""
    found = stage(deleted_spans(docs, words), "line_spans")
    joined = docs.select(*key_columns("doc_id", "text"), "doc_id", "text").join(found, KEY, "left")
    lengths = F.transform(F.arrays_zip("_from", "_to"), lambda s: s["_to"] - s["_from"] + 1)
    return joined.select(
        "doc_id",
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"),
        F.coalesce(F.aggregate(lengths, F.lit(0), lambda a, x: a + x), F.lit(0)).alias("n_deleted"),
        F.coalesce(
            F.array_join(
                F.transform(F.arrays_zip("_from", "_to"), lambda s: F.concat_ws("-", s["_from"], s["_to"])), " "
            ),
            F.lit(""),
        ).alias("deleted_spans"),
        F.when(F.col("_from").isNull(), F.col("text")).otherwise(_without(F.col("text"))).alias("text"),
    )
