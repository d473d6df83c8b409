"""Product codes of vectors: small codebooks per part, found by Orchard search.

Components become integers floor(``scale`` * x), so that every sum and distance is
exact. A vector is cut into ``parts`` equal consecutive parts, and each part position
has a codebook of ``entries`` entries, which begins as that part of the vectors with
the smallest ids. Each of ``rounds`` rounds gives every part its nearest entry and
replaces an entry by the componentwise floor of the mean of its parts; an unused entry
stays. At the end all parts are assigned once more.

The nearest entry is found by Orchard's search. Every entry has a list of the others
by distance from it. A search walks the list of its current entry, jumps to the list
of an entry that is nearer to the point, marks the entries it has met, and stops at
the first one further than twice the point's distance from the current entry: by the
triangle inequality no later one is nearer. Entries at exactly that distance are still
met, since one as near as the current entry, but of lower index, wins.

A round reads the table once. A task returns the sums and counts of its own parts, a
fixed number of rows whatever it has read, so neither a task nor the driver gets more
than ``entries`` sums per component.

Defined results: rows whose vector is null or holds a null or non-finite component are
dropped; equal ids are ordered by their vectors, and a null id stands behind all
others; with fewer vectors than entries the codebooks are shorter; rows of equal id and
vector have the same code; null labels are one label; an empty table gives an empty
one; vectors of different dimension, a dimension that ``parts`` doesn't divide, and
components too large for 64-bit distances raise a ValueError that names the cause.
Columns besides ``vec_id``, ``embedding`` and ``label`` are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import ship, stage

#: Vectors whose parts are searched together, to bound a task's memory.
BLOCK = 4096


@dataclass(frozen=True)
class ProductCodes:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


def _usable(vector: Column) -> Column:
    lost = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return vector.isNotNull() & ~lost


def integer_vectors(embeddings: DataFrame, plan: ProductCodes) -> DataFrame:
    """``vec_id``, ``label`` and the integer components ``ints`` of the usable rows."""
    vector = F.col("embedding").cast("array<double>")
    # floor of a double beyond 64 bits is cut to the largest long, which _width refuses.
    return (
        embeddings.select("vec_id", "label", vector.alias("_vector"))
        .where(_usable(F.col("_vector")))
        .select("vec_id", "label", F.transform("_vector", lambda x: F.floor(x * plan.scale)).alias("ints"))
    )


def _width(vectors: DataFrame, plan: ProductCodes) -> int | None:
    """Components of a part, or None for an empty table; refuses what has no defined codes."""
    size = F.size("ints")
    low, high, least, most = vectors.agg(
        F.min(size), F.max(size), F.min(F.array_min("ints")), F.max(F.array_max("ints"))
    ).first()
    if low is None:
        return None
    if low != high:
        raise ValueError(f"vectors of {low} and of {high} components have no common codebook")
    if high % plan.parts:
        raise ValueError(f"{high} components cannot be cut into {plan.parts} equal parts")
    width = high // plan.parts
    limit = math.isqrt((1 << 63) // (16 * max(width, 1)))
    if width and max(-least, most) >= limit:
        raise ValueError(f"components of {limit} / {plan.scale} or more overflow 64-bit distances")
    return width


def neighbour_lists(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances between entries, and per entry the others by distance from it."""
    gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    k = len(entries)
    order = np.argsort(gaps, axis=1, kind="stable")
    return gaps, order[order != np.arange(k)[:, None]].reshape(k, k - 1)


def orchard(
    points: np.ndarray, entries: np.ndarray, gaps: np.ndarray, lists: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each point, the lowest of equally near ones, and its squared distance.

    All points take a step of their own search at a time; those that have stopped leave.
    """
    n, k = len(points), len(entries)
    current = np.zeros(n, dtype=np.int64)
    best = ((points - entries[0]) ** 2).sum(axis=1)
    met = np.zeros((n, k), dtype=bool)
    met[:, 0] = True
    step = np.zeros(n, dtype=np.int64)
    going = np.arange(n if k > 1 else 0)
    while len(going):
        entry = lists[current[going], step[going]]
        within = gaps[current[going], entry] <= 4 * best[going]
        going, entry = going[within], entry[within]
        step[going] += 1
        fresh = ~met[going, entry]
        rows, entry = going[fresh], entry[fresh]
        met[rows, entry] = True
        found = ((points[rows] - entries[entry]) ** 2).sum(axis=1)
        nearer = (found < best[rows]) | ((found == best[rows]) & (entry < current[rows]))
        moved = rows[nearer]
        best[moved], current[moved], step[moved] = found[nearer], entry[nearer], 0
        going = going[step[going] < k - 1]
    return current, best


def assign(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (vector, part) and the squared distances of the vectors' parts, summed.

    ``books`` is (part, entry, component).
    """
    parts, _, width = books.shape
    codes = np.zeros((len(vectors), parts), dtype=np.int64)
    error = np.zeros(len(vectors), dtype=np.int64)
    for p in range(parts):
        gaps, lists = neighbour_lists(books[p])
        codes[:, p], distance = orchard(vectors[:, p * width : (p + 1) * width], books[p], gaps, lists)
        error += distance
    return codes, error


def _matrices(column: pa.Array, dim: int) -> Iterator[np.ndarray]:
    """The integer vectors of a batch, BLOCK at a time."""
    for at in range(0, len(column), BLOCK):
        part = column.slice(at, BLOCK)
        yield part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(part), dim)


def _sums(vectors: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Componentwise sums and counts of the parts nearest to each entry."""
    parts, entries, width = books.shape
    dim = parts * width

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), dtype=np.int64)
        read = 0
        for batch in batches:
            for block in _matrices(batch.column(0), dim):
                read += len(block)
                codes, _ = assign(block, books)
                for p in range(parts):
                    np.add.at(total[p, :, :width], codes[:, p], block[:, p * width : (p + 1) * width])
                    total[p, :, width] += np.bincount(codes[:, p], minlength=entries)
        if read:
            slot = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total.ravel()[slot])], names=["slot", "value"])

    partial = vectors.select("ints").mapInArrow(add, "slot long, value long")
    found = partial.groupBy("slot").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(parts * entries * (width + 1), dtype=np.int64)
    for slot, value in found:
        total[slot] = value
    total = total.reshape(parts, entries, width + 1)
    return total[:, :, :width], total[:, :, width]


def codebooks(vectors: DataFrame, plan: ProductCodes = ProductCodes()) -> np.ndarray | None:
    """The codebooks (part, entry, component) after all rounds, or None for no vectors."""
    width = _width(vectors, plan)
    if width is None:
        return None
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(plan.entries).select("ints").collect()
    start = np.array([r.ints for r in first], dtype=np.int64).reshape(len(first), plan.parts, width)
    books = start.transpose(1, 0, 2).copy()
    ship(vectors.sparkSession)
    for _ in range(plan.rounds):
        sums, counts = _sums(vectors, books)
        used = counts > 0
        books[used] = sums[used] // counts[used][:, None]
    return books


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, decimal and comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encoded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits a part) and ``error``."""
    dim = books.shape[0] * books.shape[2]
    digits = np.array([f"{e:02x}" for e in range(256)])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], []
            for block in _matrices(batch.column(2), dim):
                found, error = assign(block, books)
                codes += ["".join(row) for row in digits[found].tolist()]
                errors.append(error)
            if codes:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(np.concatenate(errors))],
                    names=["vec_id", "label", "code", "error"],
                )

    kinds = dict(vectors.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    ship(vectors.sparkSession)
    return vectors.select("vec_id", "label", "ints").mapInArrow(encode, schema)


def vector_codes(embeddings: DataFrame, plan: ProductCodes = ProductCodes()) -> DataFrame:
    """Per usable vector its code, its error, the error summed over its label, and the codebooks' digest."""
    vectors = stage(integer_vectors(embeddings, plan), "code_vectors")
    books = codebooks(vectors, plan)
    if books is None:
        blank = vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        books = np.zeros((plan.parts, 0, 0), dtype=np.int64)
    else:
        blank = encoded(vectors, books)
    codes = stage(blank, "codes")
    # Summed per label before the join, so a label with very many vectors is one row per task.
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256")
    )


def vector_codes_sql(plan: ProductCodes = ProductCodes()) -> str:
    """The same codes in SQL, by plain search over all entries."""
    steps = [
        f"""vectors AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS row_id, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({plan.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""pieces AS MATERIALIZED (
  SELECT row_id, part, ints[part * len(ints) // {plan.parts} + 1 : (part + 1) * len(ints) // {plan.parts}] AS piece
  FROM vectors, range({plan.parts}) AS parts(part))""",
        f"""book0 AS MATERIALIZED (
  SELECT part, row_id - 1 AS entry, piece AS point FROM pieces WHERE row_id <= {plan.entries})""",
    ]
    nearest = """SELECT row_id, part, min(struct_pack(d := list_sum(list_transform(list_zip(piece, point), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := entry)) AS best
  FROM pieces JOIN book{0} USING (part) GROUP BY row_id, part"""
    for r in range(plan.rounds):
        steps.append(f"near{r} AS MATERIALIZED ({nearest.format(r)})")
        steps.append(
            f"""means{r} AS MATERIALIZED (
  SELECT part, entry, list(mean ORDER BY place) AS point FROM (
    SELECT part, best.e AS entry, place, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS mean
    FROM (SELECT part, best, unnest(piece) AS x, generate_subscripts(piece, 1) AS place FROM near{r} JOIN pieces USING (row_id, part))
    GROUP BY part, best.e, place) GROUP BY part, entry)"""
        )
        steps.append(
            f"""book{r + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(means{r}.point, book{r}.point) AS point FROM book{r} LEFT JOIN means{r} USING (part, entry))"""
        )
    last = plan.rounds
    steps.append(f"final AS MATERIALIZED ({nearest.format(last)})")
    steps.append(
        """codes AS MATERIALIZED (
  SELECT row_id, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM final GROUP BY row_id)"""
    )
    steps.append(
        f"""digest AS (
  SELECT sha256(string_agg(array_to_string(point, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{last})"""
    )
    return (
        "WITH " + ",\n".join(steps) + "\n"
        "SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256\n"
        "FROM vectors JOIN codes USING (row_id), digest"
    )
