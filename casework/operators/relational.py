"""Relational building blocks whose null and tie rules differ from a plain join.

None of them puts a whole group into one task: extremes are grouped
aggregates (combined before the shuffle) joined back to the rows, so a hot key
reaches the join only, where adaptive execution splits it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.functions import null_ranked


def not_in(df: DataFrame, key: str, excluded: DataFrame, ignore_null_keys: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` is ``NOT IN`` the one-column frame ``excluded``.

    SQL's three-valued rule: a null among the excluded values rejects every
    row; a null key is rejected unless the excluded set is empty.
    ``ignore_null_keys`` drops nulls from the excluded set first.

    Written as an ordinary anti join plus one scalar aggregate, so neither
    side has to fit a broadcast. Both read the set's distinct values, null
    among them, so its one shuffle serves both.
    """
    name = excluded.columns[0]
    values = excluded.select(F.col(name).alias("__excluded"))
    if ignore_null_keys:
        values = values.filter(F.col("__excluded").isNotNull())
    values = values.distinct()
    return without_values(df, key, values).filter(passes_nulls(key, set_facts(values)))


def without_values(df: DataFrame, key: str, excluded: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is none of the distinct values of a one-column frame; null equals null.

    Null-safe, so that no null filter is pushed below the part shared with ``set_facts``; a
    row it drops for its null key is rejected by ``NOT IN`` anyway.
    """
    values = excluded.select(F.col(excluded.columns[0]).alias("__excluded"))
    return df.join(values, F.col(key).eqNullSafe(F.col("__excluded")), "left_anti")


#: Bits of one block of a key filter: what ``bitmap_construct_agg`` gathers into one binary of 4 KB.
BLOCK_BITS = 32_768
#: Words of 64 bits in a line of a block. A key sets a bit in each word of one line, so its test reads one line.
LINE_WORDS = 4
LINES = BLOCK_BITS // (64 * LINE_WORDS)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks))


def _bits(key: Column) -> tuple[Column, list[Column]]:
    """A key's line in its block, and its bit in each word of the line."""
    mixed = F.xxhash64(F.lit("bits"), key)
    bits = [F.shiftrightunsigned(mixed, 7 + 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(LINE_WORDS)]
    return mixed.bitwiseAND(F.lit(LINES - 1)), bits


def _places(key: Column) -> list[Column]:
    """A key's bits as places in the block, whose bytes make words from their upper end."""
    line, bits = _bits(key)
    return [line * 64 * LINE_WORDS + 64 * k + bit.bitwiseXOR(F.lit(56)) for k, bit in enumerate(bits)]


def key_filter(values: DataFrame, key: str, blocks: int = 2048) -> DataFrame:
    """A Bloom filter of a column as a frame of ``blocks`` rows at most: block number and 4 KB of bits.

    Each key sets its bits in one block. The bits are combined before the shuffle. Nulls are left out.
    """
    bits = values.filter(F.col(key).isNotNull()).select(
        _block(F.col(key), blocks).alias("__block"), F.explode(F.array(*_places(F.col(key)))).alias("__place")
    )
    return bits.groupBy("__block").agg(F.bitmap_construct_agg("__place").alias("__bits"))


def _lines(bits: DataFrame) -> DataFrame:
    """The lines of a key filter that have bits: number and words. A row's join to them copies 32 bytes, not a block."""
    half = "cast(conv(hex(substr(__bits, {}, 4)), 16, 10) as bigint)"
    at = f"i * {8 * LINE_WORDS}"
    words = [
        f"shiftleft({half.format(f'{at} + {8 * k + 1}')}, 32) | {half.format(f'{at} + {8 * k + 5}')} as __w{k}"
        for k in range(LINE_WORDS)
    ]
    line = f"struct(__block * {LINES} + i as __line, {', '.join(words)})"
    lines = bits.select(F.expr(f"inline(transform(sequence(0, {LINES - 1}), i -> {line}))"))
    return lines.filter("__w0 != 0")


def with_filter_hit(df: DataFrame, key: str, bits: DataFrame, blocks: int = 2048, hit: str = "__hit") -> DataFrame:
    """Adds whether a key may be among those of ``bits``; false is certain, and so is a null key's false.

    ``bits`` has 4 KB a block whatever the number of keys, so its broadcast as lines has a bound, too.
    """
    line, places = _bits(F.col(key))
    number = F.when(F.col(key).isNotNull(), _block(F.col(key), blocks) * LINES + line)
    joined = df.withColumn("__key_line", number).join(
        F.broadcast(_lines(bits)), F.col("__key_line") == F.col("__line"), "left"
    )
    set_bits = [
        F.call_function("shiftright", F.col(f"__w{k}"), place).bitwiseAND(F.lit(1)) == 1
        for k, place in enumerate(places)
    ]
    may = reduce(lambda a, b: a & b, set_bits)
    words = [f"__w{k}" for k in range(LINE_WORDS)]
    return joined.withColumn(hit, F.coalesce(may, F.lit(False))).drop("__key_line", "__line", *words)


#: Words of 64 bits in a block of the key filter of ``may_match``.
BLOCK_WORDS = BLOCK_BITS // 64


def _match_place(name: Column, words: int) -> tuple[Column, Column]:
    """The word that a hash lies in, and its two bits there."""
    bits = [F.shiftrightunsigned(name, at).bitwiseAND(F.lit(63)).cast("int") for at in (52, 58)]
    one = F.lit(1).cast("long")
    masks = [F.call_function("shiftleft", one, bit) for bit in bits]
    return F.pmod(name, F.lit(words)).cast("int"), masks[0].bitwiseOR(masks[1])


def _match_words(names: DataFrame, words: int) -> Column:
    """The words of a key filter of the one-column frame of hashes, as one array that is looked up once.

    Bits are combined before the shuffle, and each word comes once, so the array has ``words`` elements.
    """
    word, mask = _match_place(F.col(names.columns[0]), words)
    empty = names.sparkSession.range(words).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("m"))
    bits = names.select(word.alias("w"), mask.alias("m")).unionByName(empty).groupBy("w").agg(F.bit_or("m").alias("m"))
    in_order = F.sort_array(F.collect_list(F.struct("w", "m")))
    return bits.agg(F.transform(in_order, lambda x: x.getField("m")).alias("words")).scalar()


def may_match(df: DataFrame, values: DataFrame, on: Sequence[str], blocks: int = 2048) -> DataFrame:
    """Rows of ``df`` that may have their columns ``on`` among ``values``; those left out surely have not.

    For wide rows of which few match: an exact join after it moves only what is kept here. It is a
    plain condition on the columns ``on``, which the optimizer takes below the projections and
    joins that ``df`` is made of, so wide rows are made of the kept ones only.
    Its filter has 4 KB a block whatever the number of keys. The columns are hashed, so they must be
    of one type on both sides and not floating.
    """
    for c in on:
        kinds = {df.schema[c].dataType.simpleString(), values.schema[c].dataType.simpleString()}
        if len(kinds) > 1 or kinds & {"float", "double"}:
            raise TypeError(f"{c} cannot be hashed alike: {sorted(kinds)}")
    return df.filter(_matches(values, on, blocks))


def _matches(values: DataFrame, on: Sequence[str], blocks: int) -> Column:
    """Whether columns ``on`` may be among those of ``values``; false is certain."""
    words = blocks * BLOCK_WORDS
    name = F.xxhash64(*on)
    word, mask = _match_place(name, words)
    listed = _match_words(values.select(name.alias("__name")), words)
    return F.bitwise_not(F.get(listed, word)).bitwiseAND(mask) == 0


def not_in_filtered(
    df: DataFrame, key: str, excluded: DataFrame, ignore_null_keys: bool = False, blocks: int = 2048
) -> DataFrame:
    """``not_in`` for few excluded rows among many: only rows that a Bloom filter cannot rule out are shuffled.

    Same rows and null rules. It reads ``df`` twice, once for either part, so it pays where
    ``df`` is a scan and its rows are wide; ``blocks`` of 4 KB hold about 3,000 keys each at one
    wrong hit in a hundred. More keys give more wrong hits, which the anti join sorts out.
    Both key columns must be of one type, which may not be a floating one: hashes tell -0.0 and 0.0 apart.
    """
    name = excluded.columns[0]
    kinds = {df.schema[key].dataType.simpleString(), excluded.schema[name].dataType.simpleString()}
    if len(kinds) > 1 or kinds & {"float", "double"}:
        raise TypeError(f"keys of {key} and {name} cannot be hashed alike: {sorted(kinds)}")
    values = excluded.select(F.col(name).alias("__excluded"))
    if ignore_null_keys:
        values = values.filter(F.col("__excluded").isNotNull())
    values = values.distinct()
    probed = with_filter_hit(df, key, key_filter(values, "__excluded", blocks), blocks)
    open_rows = probed.filter("__hit").drop("__hit")
    ruled_out = probed.filter("not __hit").drop("__hit")
    facts = set_facts(values)
    kept = open_rows.join(values, F.col(key).eqNullSafe(F.col("__excluded")), "left_anti").unionByName(ruled_out)
    return kept.filter(passes_nulls(key, facts))


def hashed_alike(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> bool:
    """Whether equal values of the paired columns have equal hashes: one type on both sides, not floating."""
    kinds = [{left.schema[a].dataType.simpleString(), right.schema[b].dataType.simpleString()} for a, b in pairs]
    return all(len(k) == 1 and not k & {"float", "double"} for k in kinds)


def may_be_listed(
    df: DataFrame, lists: Sequence[tuple[Sequence[str], DataFrame]], hit: str, blocks: int = 2048
) -> DataFrame:
    """Adds whether a row may have its columns in one of ``lists``; false is certain.

    A list is columns of ``df`` and a frame whose columns are compared with them in turn; a
    null there matches nothing. An exact test has to shuffle the rows with a hit only.
    """
    names = []
    for i, (columns, values) in enumerate(lists):
        if not hashed_alike(df, values, list(zip(columns, values.columns, strict=True))):
            raise TypeError(f"{list(columns)} cannot be hashed alike")
        keys = values.dropna().select(F.xxhash64(*values.columns).alias("__name"))
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        named = df.withColumn("__name", F.when(known, F.xxhash64(*columns)))
        df = with_filter_hit(named, "__name", key_filter(keys, "__name", blocks), blocks, f"__{i}{hit}").drop("__name")
        names.append(f"__{i}{hit}")
    return df.withColumn(hit, reduce(lambda a, b: a | b, [F.col(n) for n in names])).drop(*names)


def set_facts(values: DataFrame) -> Column:
    """Whether a one-column frame is empty, and whether it has a null: what ``NOT IN`` asks of a set beside its values."""
    return values.agg(
        F.struct(
            (F.count(F.lit(1)) == 0).alias("is_empty"),
            F.coalesce(F.bool_or(F.col(values.columns[0]).isNull()), F.lit(False)).alias("has_null"),
        ).alias("facts")
    ).scalar()


def passes_nulls(key: str, facts: Column) -> Column:
    """``NOT IN``'s rule for a row whose key equals no excluded value."""
    return facts.getField("is_empty") | (F.col(key).isNotNull() & ~facts.getField("has_null"))


def without_keys(df: DataFrame, key: str, taken: DataFrame) -> DataFrame:
    """Rows whose key is not among ``taken``; rows with a null key are dropped.

    Equal to joining with the set difference of the keys: duplicates of a kept
    row stay.
    """
    name = taken.columns[0]
    keys = taken.select(F.col(name).alias("__taken")).filter(F.col("__taken").isNotNull()).distinct()
    return df.filter(F.col(key).isNotNull()).join(keys, F.col(key) == F.col("__taken"), "left_anti")


def without_few_keys(df: DataFrame, key: str, taken: DataFrame, blocks: int = 2048) -> DataFrame:
    """``without_keys`` for few taken keys among many rows: only rows that a key filter cannot rule out are moved.

    It reads ``df`` twice, once for either part. Keys that cannot be hashed alike are all tested exactly.
    """
    name = taken.columns[0]
    if not hashed_alike(df, taken, [(key, name)]):
        return without_keys(df, key, taken)
    listed = taken.select(F.col(name).alias(key)).filter(F.col(key).isNotNull())
    may = _matches(listed, [key], blocks)
    ruled_out = df.filter(F.col(key).isNotNull() & ~may)
    return without_keys(df.filter(may), key, taken).unionByName(ruled_out)


def null_safe_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", strict: Sequence[str] = ()
) -> DataFrame:
    """Equi-join where null matches null; the right side's keys are dropped.

    ``strict`` keys are compared by plain equality (null matches nothing).
    """
    renamed = right.select(
        *[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns]
    )
    condition: Column | None = None
    for c in on:
        other = F.col(f"__r_{c}")
        term = F.col(c) == other if c in strict else F.col(c).eqNullSafe(other)
        condition = term if condition is None else condition & term
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in on])


def _extreme_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    parts = [p for c in order for p in null_ranked(c)]
    best = (
        df.groupBy(*keys)
        .agg(pick(F.struct(*parts)).alias("__best"))
        .select(*keys, *[F.col(f"__best.{c}").alias(c) for c in order])
    )
    return null_safe_join(df, best, [*keys, *order])


def latest_rows(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Rows ranking first per key by descending ``day``: ties kept, null day first."""
    return _extreme_rows(df, keys, [day], F.max)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows ranking first per key by ascending ``order``: ties kept, nulls last."""
    return _extreme_rows(df, keys, order, F.min)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ascending ``order``, nulls last.

    Same as ``first_rows(...).distinct()`` when ``keys + order`` are all the
    columns, but without the join back.
    """
    parts = [p for c in order for p in null_ranked(c)]
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*parts)).alias("__best"))
        .select(*keys, *[F.col(f"__best.{c}").alias(c) for c in order])
    )


def numbered_top(df: DataFrame, measure: str, n: int, tie_break: Sequence[str], number: str) -> DataFrame:
    """The ``n`` largest rows by ``measure``, numbered 1..n in that order.

    ``tie_break`` columns make the choice deterministic. The numbering window
    runs after the limit, so its single partition holds at most ``n`` rows;
    ``n`` is a number of cases to work on, not of data.
    """
    order = [F.col(measure).desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    top = df.orderBy(*order).limit(n)
    return top.withColumn(number, F.row_number().over(Window.orderBy(*order)).cast("long"))
