"""Near duplicates among embeddings: PCA-ordered tiles, with suffix-norm bounds that stop a comparison early.

Vectors of one label and length are laid out by their two leading principal coordinates: a cosine of 0.98 means a
distance of at most 0.2, so only neighbouring cells of that width can hold links. Cells are cut into tiles of bounded
size, and every pair of neighbouring tiles is one unit of work. Inside it, products accumulate over the leading
dimensions first; once the partial product plus the product of the remaining norms is below the threshold, the pair is
done. Survivors are decided on the vectors as given, in double precision.

The rotation only orders the dimensions: any orthonormal one gives the same links, so it is fitted on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.session import materialize

THRESHOLD = 0.98
TILE = 1024
ROWS_AT_ONCE = 128
SAMPLE = 4096  # vectors per fit of the rotation
STEP = 8


def usable(vector: str = "embedding"):
    """Vectors that can link: no null or non-finite component, not zero."""
    values = F.transform(vector, lambda x: x.cast("double"))
    return F.coalesce(
        F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0), F.lit(False)
    )


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes, leading first, for each vector length in the sample (rows of the least hash values)."""
    rows = vectors.select("embedding").orderBy(F.xxhash64("key1", "key2")).limit(SAMPLE).collect()
    by_length: dict[int, list] = {}
    for r in rows:
        by_length.setdefault(len(r.embedding), []).append(r.embedding)
    out = {}
    for d, found in by_length.items():
        unit = _unit(np.array(found, np.float64))
        out[d] = np.linalg.eigh(unit.T @ unit)[1][:, ::-1].copy()
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(array), -1)


def _cells(shared, width: float):
    """Adds the two leading coordinates' cells, -1 where a vector has fewer dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            lengths = np.array([len(v) for v in batch.column("embedding")])
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                unit = _unit(_matrix(batch.column("embedding").take(pa.array(at))))
                axes = shared.value.get(int(d), np.eye(int(d)))[:, :2]
                found = np.floor(unit @ axes / width).astype(np.int64)
                first[at] = found[:, 0]
                second[at] = found[:, 1] if found.shape[1] > 1 else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first), pa.array(second)], [*batch.schema.names, "c1", "c2"])

    return run


def linked_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in a, in b) of vectors with a cosine of at least ``threshold``, a few rows of ``a`` at a time."""
    ua, ub = _unit(a) @ axes, _unit(b) @ axes
    d = axes.shape[0]
    sa, sb = (np.sqrt(np.maximum(np.cumsum((u * u)[:, ::-1], axis=1)[:, ::-1], 0)) for u in (ua, ub))
    sa, sb = np.pad(sa, ((0, 0), (0, 1))), np.pad(sb, ((0, 0), (0, 1)))
    least = threshold - 1e-9
    for at in range(0, len(a), ROWS_AT_ONCE):
        own = slice(at, at + ROWS_AT_ONCE)
        step = min(STEP, d)
        partial = ua[own, :step] @ ub[:, :step].T
        i, j = np.nonzero(partial + np.outer(sa[own, step], sb[:, step]) >= least)
        sums = partial[i, j]
        while step < d and len(i):
            following = min(2 * step, d)
            sums = sums + np.einsum("ij,ij->i", ua[at + i, step:following], ub[j, step:following])
            step = following
            alive = sums + sa[at + i, step] * sb[j, step] >= least
            i, j, sums = i[alive], j[alive], sums[alive]
        i = i + at
        x, y = a[i], b[j]
        norms = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
        sure = np.abs(sums - threshold) > 1e-9  # far from the bound, or decided on the vectors as given
        with np.errstate(all="ignore"):
            exact = np.einsum("ij,ij->i", x, y) / norms >= threshold
        ok = np.where(sure | ~np.isfinite(norms) | (norms == 0), sums >= threshold, exact)
        yield i[ok], j[ok]


def _tile_links(shared, threshold: float):
    """One pair of tiles: how many rows each vector links with, and a spanning forest of the links."""

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        same = bool(table.column("same")[0].as_py())
        ids, weights = table.column("rep").to_numpy(), table.column("weight").to_numpy()
        vectors = _matrix(table.column("embedding"))
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        axes = shared.value.get(vectors.shape[1], np.eye(vectors.shape[1]))
        counts, parent = np.zeros(len(ids), np.int64), np.arange(len(ids))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = int(parent[x])
            return x

        edges: list[tuple[int, int]] = []
        if len(left) and len(right):
            for i, j in linked_pairs(vectors[left], vectors[right], axes, threshold):
                x, y = left[i], right[j]
                other = x != y
                x, y = x[other], y[other]
                np.add.at(counts, x, weights[y])
                if not same:
                    np.add.at(counts, y, weights[x])
                for p, q in zip(x.tolist(), y.tolist(), strict=True):
                    rp, rq = root(p), root(q)
                    if rp != rq:
                        parent[max(rp, rq)] = min(rp, rq)
                        edges.append((int(ids[p]), int(ids[q])))
        held = np.flatnonzero(counts)
        a = [*ids[held].tolist(), *(e[0] for e in edges)]
        b = [*[None] * len(held), *(e[1] for e in edges)]
        n = [*counts[held].tolist(), *[0] * len(edges)]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def near_duplicates(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Compared are vectors of equal, non-null labels and equal length. Equal vectors are one node that counts as many
    rows as it has. A row without an id, a label or a usable vector links with nothing: its component is its own id, and
    without an id it isn't kept. Rows that share an id count as rows. An empty table gives no rows.
    """
    spark = table.sparkSession
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"), F.col(label_col).alias("label"))
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable()
    keyed = rows.withColumn("fit", fit).withColumns(
        {"key1": F.when(F.col("fit"), F.xxhash64("label", "embedding")), "key2": F.when(F.col("fit"), F.xxhash64(F.lit(1), "embedding", "label"))}
    )
    distinct = keyed.filter("fit").groupBy("label", "key1", "key2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("embedding").alias("embedding")
    )
    distinct = materialize(distinct.withColumn("dims", F.size("embedding")), "vectors")
    shared = spark.sparkContext.broadcast(rotations(distinct))
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema)
    placed = materialize(distinct.mapInArrow(_cells(shared, width), f"{columns}, c1 long, c2 long"), "cells")
    cell = ["label", "dims", "c1", "c2"]
    sizes = placed.groupBy(*cell).agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    tiled = placed.join(sizes, cell).withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles"))).drop("tiles")
    tiles = materialize(tiled.select(*cell, "tile").distinct(), "tiles")
    # Each tile meets itself, the later tiles of its cell, and the tiles of the four following neighbour cells.
    shifts = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    ahead = tiles.withColumn("shift", F.explode(shifts)).select(
        "label", "dims", F.col("c1").alias("l1"), F.col("c2").alias("l2"), F.col("tile").alias("lt"),
        (F.col("c1") + F.col("shift.x")).alias("c1"), (F.col("c2") + F.col("shift.y")).alias("c2"),
    )
    pairs = ahead.join(tiles, cell).filter("c1 <> l1 OR c2 <> l2 OR tile >= lt")
    unit = F.struct("l1", "l2", "lt", F.col("c1").alias("r1"), F.col("c2").alias("r2"), F.col("tile").alias("rt"))
    units = pairs.select("label", "dims", unit.alias("unit"), ((F.col("c1") == F.col("l1")) & (F.col("c2") == F.col("l2")) & (F.col("tile") == F.col("lt"))).alias("same"))
    sides = units.select("label", "dims", F.col("unit.l1").alias("c1"), F.col("unit.l2").alias("c2"), F.col("unit.lt").alias("tile"), "unit", "same", F.lit(0).alias("side")).unionByName(
        units.filter("NOT same").select("label", "dims", F.col("unit.r1").alias("c1"), F.col("unit.r2").alias("c2"), F.col("unit.rt").alias("tile"), "unit", "same", F.lit(1).alias("side"))
    )
    work = tiled.join(sides, [*cell, "tile"]).select("label", "dims", "unit", "same", "side", "rep", "weight", "embedding")
    found = materialize(work.groupBy("label", "dims", "unit").applyInArrow(_tile_links(shared, threshold), "a long, b long, n long"), "links")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("linked"))
    comp = components(found.filter("b IS NOT NULL").select("a", "b"))
    nodes = distinct.select("key1", "key2", "rep", "weight").join(counts, "rep", "left").join(comp, F.col("rep") == F.col("node"), "left")
    nodes = nodes.select("key1", "key2", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "rep").alias("least"))
    out = keyed.select("vec_id", "key1", "key2").join(nodes, ["key1", "key2"], "left")
    component = F.coalesce("least", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")
    )
