"""Near-duplicate vectors by a pivot-permutation index.

``pivots`` reference points are chosen from a bounded sample by farthest-first
traversal. A vector is described by its ``nearest`` nearest pivots in order.
Close vectors have nearly the same order, so they share many pivots. The inverted
lists are kept per combination of ``shared`` pivots within a label, a cell: two
vectors meet in a cell exactly if they share at least that many pivots.
Candidates are verified by cosine in double precision.

Equal vectors of a label are one vector with a count. Two vectors may share many
cells; a pair counts only in the cell of its smallest common pivots. A cell in
which all members share a smaller pivot holds no such pair and is left out before
any vector is moved, which leaves a dense group in one cell of all it is in.
Cells are compared in tiles of ``tile`` by ``tile`` vectors, spread over tasks;
a tile emits a count per vector and a spanning forest of its links, not pairs.

Defined results: rows with a null label, and vectors that are null, empty, zero
or hold null or non-finite components link with nothing and are kept; vectors of
different length link with nothing; rows of equal id and vector are rows of their
own; a null id stands behind all others as a component's id; an empty table gives
an empty table. Only the named columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.llm.common import ship, stage
from casework.llm.components import components

CELL = ["label", "_dim", "_cell"]


@dataclass(frozen=True)
class PivotIndex:
    pivots: int = 256
    nearest: int = 8
    shared: int = 3
    sample: int = 4096
    least: float = 0.98
    tile: int = 128


def farthest_first(vectors: np.ndarray, n: int) -> np.ndarray:
    """n rows, each the farthest in angle from those chosen before it."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def reference_points(sample: list[list[float]], index: PivotIndex) -> dict[int, np.ndarray]:
    """Pivots per vector length that the sample has often enough to choose from."""
    by_length: dict[int, list[list[float]]] = {}
    for vector in sample:
        by_length.setdefault(len(vector), []).append(vector)
    return {
        n: farthest_first(np.array(rows, dtype=np.float64), index.pivots)
        for n, rows in by_length.items()
        if len(rows) >= index.pivots
    }


def pivots_of(dim: int, chosen: dict[int, np.ndarray], index: PivotIndex) -> np.ndarray:
    """The chosen pivots of a length, or fixed pseudo-random directions."""
    if dim in chosen:
        return chosen[dim]
    return np.random.default_rng(dim).standard_normal((index.pivots, dim))


def _words(index: PivotIndex) -> int:
    return -(-index.pivots // 64)


def _cells(vectors: DataFrame, chosen: dict[int, np.ndarray], index: PivotIndex) -> DataFrame:
    """A row per vector and cell, with a bit mask of the vector's pivots that make the cell not its first."""
    words = _words(index)
    picks = np.array(list(itertools.combinations(range(index.nearest), index.shared)))
    masks = [f"_m{i}" for i in range(words)]
    schema = "_vector string, label long, _dim int, _cell long, " + ", ".join(f"{m} long" for m in masks)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            keys, labels = batch.column(0), batch.column(1)
            rows = batch.column(2)
            sizes = np.asarray(rows.value_lengths())
            for dim in np.unique(sizes).tolist():
                where = np.flatnonzero(sizes == dim)
                if dim not in known:
                    points = pivots_of(dim, chosen, index)
                    known[dim] = points / np.linalg.norm(points, axis=1)[:, None]
                for at in range(0, len(where), 2048):
                    part = pa.array(where[at : at + 2048])
                    x = np.asarray(rows.take(part).flatten(), dtype=np.float64).reshape(len(part), dim)
                    order = np.argsort(-(x @ known[dim].T), axis=1, kind="stable")[:, : index.nearest]
                    near = np.sort(order, axis=1)
                    combos = near[:, picks]
                    cell = np.zeros(combos.shape[:2], dtype=np.int64)
                    for j in range(index.shared):
                        cell = cell * index.pivots + combos[:, :, j]
                    # Pivots of the vector below the cell's largest that are not in the cell.
                    bits = np.zeros((*combos.shape[:2], words), dtype=np.uint64)
                    for j in range(index.nearest):
                        pivot = near[:, j]
                        below = (pivot[:, None] < combos[:, :, -1]) & ~(combos == pivot[:, None, None]).any(axis=2)
                        value = np.left_shift(np.uint64(1), (pivot % 64).astype(np.uint64))
                        for w in range(words):
                            bits[:, :, w] |= np.where(below & (pivot // 64 == w)[:, None], value[:, None], np.uint64(0))
                    n = combos.shape[1]
                    again = pa.array(np.repeat(np.arange(len(part)), n))
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys.take(part).take(again),
                            labels.take(part).take(again),
                            pa.array(np.full(len(part) * n, dim, dtype=np.int32)),
                            pa.array(cell.ravel()),
                            *(pa.array(bits[:, :, w].ravel().view(np.int64)) for w in range(words)),
                        ],
                        names=["_vector", "label", "_dim", "_cell", *masks],
                    )

    return vectors.select("_vector", F.col("label").cast("long"), "embedding").mapInArrow(describe, schema)


def _forest(n: int, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Smallest reachable row of each of n rows under the links."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, one, label[other])
        np.minimum.at(label, other, label[one])
        label = label[label]
        if np.array_equal(label, before):
            return label


def _compare(run: dict[str, np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a tile that have links, with how many vectors they link to and a root."""
    x, side, mask, copies = run["x"], run["side"], run["mask"], run["copies"]
    norm = np.sqrt((x * x).sum(axis=1))
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    if not len(right) and run["same"]:
        right = left
    if not len(left) or not len(right):
        return (np.zeros(0, dtype=int),) * 3
    close = (x[left] @ x[right].T) / (norm[left][:, None] * norm[right][None, :]) >= least
    if run["same"]:
        close = np.triu(close, 1)
    r, s = np.nonzero(close)
    r, s = left[r], right[s]
    first = ((mask[r] & mask[s]) == 0).all(axis=1)
    r, s = r[first], s[first]
    links = np.zeros(len(x), dtype=np.int64)
    np.add.at(links, r, copies[s])
    np.add.at(links, s, copies[r])
    rows = np.flatnonzero(links)
    return rows, links[rows], _forest(len(x), r, s)[rows]


def _tile_links(tiles: DataFrame, index: PivotIndex) -> DataFrame:
    """Per vector and tile with links: number of vectors linked to, and the tile's root vector."""
    words = _words(index)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def finish(table: pa.Table) -> tuple[list, list, list]:
            ids = np.column_stack([table.column(c).to_numpy() for c in (*CELL, "_i", "_j")])
            new = np.flatnonzero(np.any(ids[1:] != ids[:-1], axis=1)) + 1
            bounds = [0, *new.tolist(), len(ids)]
            embeddings = table.column("embedding").combine_chunks()
            offsets = np.asarray(embeddings.offsets)
            flat = np.asarray(embeddings.values, dtype=np.float64)
            names = table.column("_vector").to_pylist()
            side, copies = table.column("_side").to_numpy(), table.column("_copies").to_numpy()
            mask = np.column_stack([table.column(f"_m{w}").to_numpy() for w in range(words)])
            out: tuple[list, list, list] = ([], [], [])
            for a, b in itertools.pairwise(bounds):
                if b - a < 2:
                    continue
                run = {
                    "x": flat[offsets[a] : offsets[b]].reshape(b - a, -1),
                    "side": side[a:b],
                    "mask": mask[a:b],
                    "copies": copies[a:b],
                    "same": ids[a, -2] == ids[a, -1],
                }
                for row, n, root in zip(*(v.tolist() for v in _compare(run, index.least)), strict=True):
                    out[0].append(names[a + row])
                    out[1].append(n)
                    out[2].append(names[a + root])
            return out

        def batch_of(out: tuple[list, list, list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
                names=["a", "links", "b"],
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            # The last tile may go on in the next batch.
            last = [table.column(c)[-1].as_py() for c in (*CELL, "_i", "_j")]
            cut = table.num_rows
            values = [table.column(c).to_numpy() for c in (*CELL, "_i", "_j")]
            same = np.logical_and.reduce([v == x for v, x in zip(values, last, strict=True)])
            cut = int(np.argmax(same))
            if cut:
                yield batch_of(finish(table.slice(0, cut).combine_chunks()))
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield batch_of(finish(held.combine_chunks()))

    return tiles.mapInArrow(compare, "a string, links long, b string")


def vector_classes(rows: DataFrame, index: PivotIndex = PivotIndex()) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = rows.sparkSession
    ship(spark)
    value = F.col("embedding")
    sound = (
        F.col("label").isNotNull()
        & value.isNotNull()
        & F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(value, lambda v: v != 0)
    )
    name = F.concat_ws("-", F.hex(F.xxhash64("label", "embedding")), F.hex(F.xxhash64(F.lit("second"), "label", "embedding")))
    keyed = stage(
        rows.select(
            "vec_id",
            F.col("label").cast("long").alias("label"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        ).select("vec_id", "label", "embedding", F.when(F.coalesce(sound, F.lit(False)), name).alias("_vector")),
        "vector_rows",
    )
    vectors = stage(
        keyed.where("_vector is not null")
        .groupBy("_vector", "label")
        .agg(F.first("embedding").alias("embedding"), F.count("*").alias("_copies")),
        "vectors",
    )
    sample = vectors.select("_vector", "embedding").orderBy("_vector").limit(index.sample).collect()
    chosen = reference_points([r["embedding"] for r in sample], index)
    cells = stage(_cells(vectors, chosen, index), "vector_cells")
    masks = [f"_m{w}" for w in range(_words(index))]
    useful = stage(
        cells.groupBy(*CELL)
        .agg(F.count("*").alias("_n"), *(F.bit_and(m).alias(m) for m in masks))
        .where("_n > 1 and " + " and ".join(f"{m} = 0" for m in masks))
        .select(*CELL, F.ceil(F.col("_n") / index.tile).cast("int").alias("_chunks")),
        "vector_useful",
    )
    members = stage(cells.join(useful, CELL), "vector_members")
    chunk = F.pmod(F.xxhash64("_vector"), F.col("_chunks")).cast("int")
    placed = members.withColumn("_chunk", chunk).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    )
    tiles = (
        placed.join(vectors.drop("label"), "_vector")
        .select(
            *CELL,
            F.least("_chunk", "_other").alias("_i"),
            F.greatest("_chunk", "_other").alias("_j"),
            (F.col("_chunk") > F.col("_other")).cast("int").alias("_side"),
            "_vector",
            "_copies",
            *masks,
            "embedding",
        )
        .repartition(*CELL, "_i", "_j")
        .sortWithinPartitions(*CELL, "_i", "_j")
    )
    linked = stage(_tile_links(tiles, index), "vector_links")
    counts = stage(linked.groupBy("a").agg(F.sum("links").alias("_linked")).withColumnRenamed("a", "_vector"), "vector_counts")
    labels = stage(components(linked.select("a", "b"), "vector_components"), "vector_labels")
    facts = stage(
        vectors.select("_vector", "_copies")
        .join(counts, "_vector", "left")
        .join(labels.withColumnRenamed("id", "_vector"), "_vector", "left")
        .select(
            "_vector",
            (F.coalesce("_linked", F.lit(0)) + F.col("_copies") - 1).alias("n_links"),
            F.coalesce("component", "_vector").alias("_component"),
        ),
        "vector_facts",
    )
    known = stage(keyed.select("vec_id", "_vector").join(facts, "_vector", "left"), "vector_known")
    smallest = stage(
        known.where("_component is not null").groupBy("_component").agg(F.min("vec_id").alias("_smallest")),
        "vector_smallest",
    )
    out = known.join(smallest, "_component", "left")
    component = F.when(F.col("_component").isNull(), F.col("vec_id")).otherwise(F.col("_smallest"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
