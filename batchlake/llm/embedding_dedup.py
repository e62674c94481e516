"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside them.

Vectors are compared only under equal labels. Equal vectors are taken together first.
The k-means cells are those of a bounded sample; every vector goes to its nearest centre
and, with the same test for each later cell, to those where a vector similar enough could
be at home. Cells are cut into blocks of bounded size, and each pair of blocks is one
matrix product whose links are counted in place: it gives one row for each vector it
held, not one for each link.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlake.llm.base import landed, small_batches
from batchlake.llm.components import components

#: Vectors that the centres are fitted on, at most: the first by a hash.
SAMPLE_ROWS = 16_384
#: Vectors of a label for each cell, and vectors in a block.
CELL_ROWS = 2048
BLOCK_ROWS = 2048
#: Cells of a label that would fit into one, unless that leaves each with fewer than FEW_ROWS vectors.
LEAST_CELLS, FEW_ROWS = 4, 16
ROUNDS = 8


def usable(vector: Column, label: Column) -> Column:
    numbers = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(label.isNotNull() & numbers & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def spherical_kmeans(units: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of length one. Starts from k rows spread evenly; a centre left alone stays."""
    centres = units[np.linspace(0, len(units) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        length = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        some = length > 1e-12
        centres[some] = sums[some] / length[some, None]
    return centres


def cells_of(units: np.ndarray, centres: np.ndarray, least: float, reach: np.ndarray | None = None) -> list[np.ndarray]:
    """For each vector its own cell and then the later ones to look into.

    x is at home in cell h. A y with cosine >= least is x turned by at most that angle, so it is
    at home in c only if x leads to h over c by no more than the sine of the angle times the
    distance of the centres. With ``reach``, the least cosine of c's vectors to its centre, x
    must also be within that angle and the one of the link. Both bounds hold for any vectors.
    """
    dots = units @ centres.T
    home = np.argmax(dots, axis=1)
    gap = np.sqrt(np.maximum(2 - 2 * (centres[home] @ centres.T), 0))
    lead = dots[np.arange(len(units)), home][:, None] - dots
    near = (lead <= gap * math.sqrt(max(1 - least * least, 0)) + 1e-7) & (np.arange(len(centres)) > home[:, None])
    if reach is not None:
        wide = np.arccos(np.clip(reach, -1, 1)) + math.acos(min(least, 1))
        near &= (np.arccos(np.clip(dots, -1, 1)) <= wide + 1e-6) & (reach <= 1)
    return [np.append(h, np.flatnonzero(row)).astype(np.int32) for h, row in zip(home, near)]


def reach_of(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The least cosine to each centre of the vectors at home there, or 2; near ties count for both."""
    dots = units @ centres.T
    return np.where(dots >= dots.max(axis=1, keepdims=True) - 1e-9, np.minimum(dots, 1), 2.0).min(axis=0, initial=2.0)


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _fit(distinct: DataFrame) -> dict[int, np.ndarray]:
    """Centres for each dimension, from one bounded sample; few dimensions are expected."""
    largest = distinct.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    k = max(-(-largest // CELL_ROWS), min(LEAST_CELLS, largest // FEW_ROWS))
    if k <= 1:
        return {}
    rows = distinct.select("size", "vector", "key").orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS).collect()
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(r["size"], []).append(r["vector"])
    return {
        size: spherical_kmeans(unit(np.array(v)), min(k, max(len(v) // 16, 1))) for size, v in by_size.items()
    }


def _reaches(distinct: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """``reach_of`` all vectors, for each dimension: as many numbers as there are centres."""
    shipped = distinct.sparkSession.sparkContext.broadcast(centres)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = {size: np.full(len(own), 2.0) for size, own in shipped.value.items()}
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            for size, own in shipped.value.items():
                at = np.flatnonzero(sizes == size)
                if len(at):
                    least[size] = np.minimum(least[size], reach_of(unit(_vectors(batch.column(1).take(pa.array(at)))), own))
        rows = [(size, c, x) for size, of in least.items() for c, x in enumerate(of) if x <= 1]
        columns = [pa.array(v, k) for v, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.float64()))]
        if rows:
            yield pa.RecordBatch.from_arrays(columns, names=["size", "cell", "reach"])

    reaches = {size: np.full(len(own), 2.0) for size, own in centres.items()}
    each = distinct.select("size", "vector").mapInArrow(work, "size int, cell int, reach double")
    for r in each.groupBy("size", "cell").agg(F.min("reach").alias("reach")).collect():
        reaches[r["size"]][r["cell"]] = r["reach"]
    return reaches


def _placed(distinct: DataFrame, centres: dict[int, np.ndarray], least: float) -> DataFrame:
    """``distinct`` with ``cells``: the own one first. The centres are at most SAMPLE_ROWS / 16 rows."""
    reaches = _reaches(distinct, centres) if centres else {}
    shipped = distinct.sparkSession.sparkContext.broadcast({size: (own, reaches[size]) for size, own in centres.items()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells: list = [[0]] * batch.num_rows
            sizes = batch.column(names.index("size")).to_numpy()
            for size, (own, reach) in shipped.value.items():
                at = np.flatnonzero(sizes == size)
                if len(at):
                    units = unit(_vectors(batch.column(names.index("vector")).take(pa.array(at))))
                    for i, c in zip(at, cells_of(units, own, least, reach)):
                        cells[i] = c
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*names, "cells"])

    names = distinct.columns
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema.fields)
    return distinct.mapInArrow(work, f"{kinds}, cells array<int>")


def _block_pairs(placed: DataFrame) -> DataFrame:
    """Every row once for each pair of blocks it takes part in.

    ``kind`` 0 pairs blocks at home in a cell (left <= right), 1 a block of visitors with one at
    home. ``side`` says where in the pair the row stands.
    """
    cell = ["label", "size", "cell"]
    visits = placed.select("label", "size", "key", "copies", "vector", F.posexplode("cells").alias("at", "cell"))
    visits = visits.withColumn("guest", (F.col("at") > 0).cast("int")).drop("at")
    count = visits.groupBy(*cell).agg(F.sum(1 - F.col("guest")).alias("n_home"), F.sum("guest").alias("n_guest"))
    blocks = count.select(
        *cell,
        F.ceil(F.col("n_home") / BLOCK_ROWS).cast("int").alias("homes"),
        F.ceil(F.col("n_guest") / BLOCK_ROWS).cast("int").alias("guests"),
    ).filter("homes > 0")
    own = F.pmod(F.xxhash64("key"), F.when(F.col("guest") == 1, F.col("guests")).otherwise(F.col("homes"))).cast("int")
    numbered = visits.join(blocks, cell).withColumn("own", own)

    def parts(n: str) -> Column:
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))

    def part(kind: int, left: Column, right: Column, side: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), left.alias("left"), right.alias("right"), side.alias("side"))

    at_home = F.concat(
        F.transform(parts("homes"), lambda j: part(0, F.least(j, F.col("own")), F.greatest(j, F.col("own")), (j < F.col("own")).cast("int"))),
        F.transform(parts("guests"), lambda g: part(1, g, F.col("own"), F.lit(1))),
    )
    visiting = F.transform(parts("homes"), lambda j: part(1, F.col("own"), j, F.lit(0)))
    return numbered.select(
        *cell, "key", "copies", "vector", F.explode(F.when(F.col("guest") == 1, visiting).otherwise(at_home)).alias("part")
    ).select(*cell, "part.*", "key", "copies", "vector")


def linked(left: np.ndarray, right: np.ndarray, least: float, itself: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the links between two blocks of unit rows; each pair once."""
    found = [np.empty((2, 0), np.int64)]
    for a in range(0, len(left), 1024):
        close = left[a : a + 1024] @ right.T >= least
        if itself:
            close &= np.arange(len(right)) > np.arange(a, a + len(close))[:, None]
        i, j = np.nonzero(close)
        found.append(np.stack((i + a, j)))
    pairs = np.concatenate(found, axis=1)
    return pairs[0], pairs[1]


def local_roots(i: np.ndarray, j: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each place the least key that it reaches by links i-j."""
    root = keys.copy()
    while len(i):
        low = np.minimum(root[i], root[j])
        if (root[i] == low).all() and (root[j] == low).all():
            break
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
    return root


def _counted(pairs: DataFrame, least: float) -> DataFrame:
    """(key, links, root): links counted in one pair of blocks, copies included."""

    def work(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        keys, copies = group.column("key").to_numpy(), group.column("copies").to_numpy()
        units = unit(_vectors(group.column("vector")))
        itself = group.column("kind")[0].as_py() == 0 and group.column("left")[0].as_py() == group.column("right")[0].as_py()
        left = np.arange(len(keys)) if itself else np.flatnonzero(side == 0)
        right = left if itself else np.flatnonzero(side == 1)
        i, j = linked(units[left], units[right], least, itself) if len(left) and len(right) else (left[:0], left[:0])
        i, j = left[i], right[j]
        links = np.bincount(i, copies[j], len(keys)) + np.bincount(j, copies[i], len(keys))
        root = local_roots(i, j, keys)
        some = links > 0
        return pa.table({"key": keys[some], "links": links[some].astype(np.int64), "root": root[some]})

    groups = pairs.groupBy("label", "size", "cell", "kind", "left", "right")
    return groups.applyInArrow(work, "key long, links long, root long")


def near_duplicates(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding, label).

    Links are pairs with equal labels and a cosine >= ``least`` in double precision. A vector
    that is null, empty, zero or holds a null or a number that is not finite links with nothing,
    nor does one without a label or an id; vectors of different lengths never link. Equal
    vectors are links of one another. A component is named by its smallest vec_id, which
    is the one kept; a row without an id is not kept.
    """
    small_batches(vectors.sparkSession)
    vector = F.col("embedding").cast("array<double>")
    good = usable(vector, F.col("label")) & F.col("vec_id").isNotNull()
    rows = vectors.select(
        "vec_id", F.when(good, F.xxhash64("label", vector)).alias("key"), F.col("label"), vector.alias("vector")
    )
    distinct = landed(
        rows.filter("key is not null")
        .groupBy("key", "label", "vector")
        .agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
        .select("key", "label", F.size("vector").alias("size"), "vector", "least_id", "copies"),
        "vectors",
    )
    placed = landed(_placed(distinct, _fit(distinct), least), "vector-cells")
    counted = landed(_counted(_block_pairs(placed), least), "vector-links")
    links = counted.groupBy("key").agg(F.sum("links").alias("links"))
    roots = landed(components(counted.select(F.col("key").alias("a"), F.col("root").alias("b"))), "vector-roots")
    known = (
        distinct.select("key", "least_id", "copies")
        .join(links, "key", "left")
        .join(roots, F.col("key") == F.col("node"), "left")
        .select("key", "least_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "key").alias("root"))
    )
    names = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = known.join(names, "root").select("key", "n_links", "component_id")
    linked_rows = rows.filter("key is not null").join(named, "key").select("vec_id", "n_links", "component_id")
    alone = rows.filter("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
