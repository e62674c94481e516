"""MLlib's random forest of regression trees, grown where its rows are.

MLlib makes the statistics of every bin of every node of a level in every task and sends them all
to a shuffle, level by level: with hundreds of thousands of nodes of a few rows each that is
most of the work, and grows with the nodes times the tasks. Here only regions of more than
``LOCAL_ROWS`` rows of a tree are cut that way. The rows of a smaller region go to one task,
which grows the whole subtree below.

What is learnt is MLlib's: thresholds at quantiles of (at least) 10,000 rows, up to ``maxBins`` bins,
Poisson bags, a new choice of inputs for each node, the split of greatest gain in variance over all rows
of the node, its limits on depth, rows, weight and gain, equal sibling leaves merged. Without
bags and choices of inputs the tree is the same (tested). The model is MLlib's own class,
loaded from its stored form.

Rows are kept as chunks of binned inputs, a byte each; a bag is drawn from (seed, tree, chunk), so
every pass and every retried task sees the same one.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlake.session import work_path

#: Functions of this module travel to the workers whole, so that the package need not be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a tree's bag up to which one task grows all of a region.
LOCAL_ROWS = 1_000_000
#: Rows of a chunk, and rows from which thresholds are taken (MLlib's number).
CHUNK_ROWS, SPLIT_ROWS = 65_536, 10_000
#: Regions whose statistics a task holds at once.
REGIONS = 8_192
#: Tasks that grow regions.
MOST_TASKS = 2_000
#: MLlib's: an impurity below it is none.
EPSILON = 2.0**-52
#: The cut of a node without a split: no bin lies beyond it.
NO_CUT = 1 << 30

CHUNKS_SCHEMA = "chunk long, rows int, bins binary, labels binary"
REGION_SCHEMA = "tree int, slot int, bins binary, weights binary, labels binary"
SUBTREE_SCHEMA = "tree int, slot int, nodes int, feature binary, cut binary, left binary, gain binary, stats binary"
NODE_SCHEMA = (
    "treeID int, id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
    "leftChild int, rightChild int, featureIndex int, threshold array<double>"
)


@dataclass(frozen=True)
class Rules:
    """What a forest is grown by; numbers as MLlib reads its parameters."""

    trees: int
    depth: int
    seed: int
    bootstrap: bool
    rate: float
    inputs: int
    chosen: int
    least_rows: float
    least_weight: float
    least_gain: float
    bins: int = 1

    def drawn(self, *place: int) -> np.random.Generator:
        return np.random.default_rng([self.seed % 2**64, *place])

    def bag(self, tree: int, chunk: int, rows: int) -> np.ndarray:
        """How often each row of a chunk is in the bag of a tree."""
        if self.bootstrap:
            return self.drawn(0, tree, chunk).poisson(self.rate, rows).astype(np.uint8)
        if self.rate < 1:
            return (self.drawn(0, tree, chunk).random(rows) < self.rate).astype(np.uint8)
        return np.ones(rows, np.uint8)

    def choose(self, rng: np.random.Generator, nodes: int) -> np.ndarray:
        """The inputs that each node may be split on."""
        if self.chosen >= self.inputs:
            return np.broadcast_to(np.arange(self.inputs), (nodes, self.inputs))
        return np.sort(np.argsort(rng.random((nodes, self.inputs)), axis=1)[:, : self.chosen], axis=1)


def inputs_of_node(strategy: str, inputs: int, trees: int) -> int:
    """``featureSubsetStrategy`` of a forest of regression trees."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": inputs, "onethird": math.ceil(inputs / 3), "sqrt": math.ceil(math.sqrt(inputs)), "log2": max(1, math.ceil(math.log2(inputs)))}
    if strategy in named:
        return named[strategy]
    return min(int(strategy), inputs) if strategy.isdigit() else math.ceil(float(strategy) * inputs)


def impurity(count: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.where(count > 0, (squares - total * total / count) / count, 0.0)


def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """MLlib's thresholds of an input: between all its values, or about equally many rows apart."""
    distinct, counts = np.unique(values, return_counts=True)
    middle = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middle) <= most:
        return middle
    cuts, stride, so_far = [], len(values) / (most + 1), counts[0]
    target = stride
    for at in range(1, len(distinct)):
        before, so_far = so_far, so_far + counts[at]
        if abs(before - target) < abs(so_far - target):
            cuts.append(middle[at - 1])
            target += stride
    return np.array(cuts)


def best_split(hist: list[np.ndarray], own: np.ndarray, rules: Rules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greatest gain of one input for each node, its cut, and what is left of it, from statistics by (node, bin)."""
    low = [np.cumsum(h, axis=1) for h in hist]
    high = [c[:, -1:] - c for c in low]
    count = low[0][:, -1:]
    with np.errstate(all="ignore"):
        gain = own[:, None] - low[0] / count * impurity(*low) - high[0] / count * impurity(*high)
    fewest = np.minimum(low[0], high[0])
    gain[(fewest < max(rules.least_rows, rules.least_weight)) | (fewest <= 0) | ~(gain >= rules.least_gain)] = -np.inf
    cut = gain.argmax(axis=1)
    at = np.arange(len(cut)), cut
    return gain[at], cut, np.stack([c[at] for c in low])


def grow(bins: np.ndarray, weights: np.ndarray, labels: np.ndarray, levels: int, rules: Rules, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """The subtree of some rows, at most so many levels deep, a level at a time.

    Nodes by level: ``feature`` (-1 for a leaf), ``cut``, ``left`` (the right child follows it),
    ``gain``, and ``stats`` (3, nodes): weight, sum and sum of squares of the labels.
    """
    w = weights.astype(np.float64)
    parts = [w, w * labels, w * labels * labels]
    width, own_bins = bins.shape[1], rules.bins
    stats = [np.array([[p.sum()] for p in parts])]
    made: dict[str, list[np.ndarray]] = {"feature": [], "cut": [], "left": [], "gain": []}
    slot, flat, total = np.zeros(len(w), np.int64), np.ascontiguousarray(bins).reshape(-1), 1
    active = np.array([0]) if levels > 0 and abs(impurity(*stats[0])[0]) >= EPSILON else np.array([], int)
    for level in range(levels + 1):
        here = stats[level]
        feature, cut = np.full(here.shape[1], -1, np.int32), np.full(here.shape[1], NO_CUT, np.int32)
        left, gain = np.full(here.shape[1], -1, np.int32), np.full(here.shape[1], -1.0)
        for name, values in (("feature", feature), ("cut", cut), ("left", left), ("gain", gain)):
            made[name].append(values)
        nodes = len(active)
        if not nodes:
            break
        chosen, row = rules.choose(rng, nodes), np.arange(len(slot)) * width
        own, best = impurity(*here[:, active]), np.full(nodes, -np.inf)
        best_feature, best_cut, best_low = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64), np.zeros((3, nodes))
        for j in range(chosen.shape[1]):
            key = slot * own_bins + flat[row + chosen[:, j][slot]]
            hist = [np.bincount(key, p, nodes * own_bins).reshape(nodes, own_bins) for p in parts]
            gained, at, low = best_split(hist, own, rules)
            better = gained > best
            best[better], best_feature[better], best_cut[better] = gained[better], chosen[better, j], at[better]
            best_low[:, better] = low[:, better]
        cuts = best > 0
        where = active[cuts]
        feature[where], cut[where], gain[where] = best_feature[cuts], best_cut[cuts], best[cuts]
        left[where] = total + 2 * np.arange(len(where))
        total += 2 * len(where)
        below = np.empty((3, 2 * len(where)))
        below[:, 0::2], below[:, 1::2] = best_low[:, cuts], here[:, where] - best_low[:, cuts]
        stats.append(below)
        open_below = (np.abs(impurity(*below)) >= EPSILON) & (level + 1 < levels)
        active = np.flatnonzero(open_below)
        place = np.full(2 * nodes, -1)
        place[(2 * np.flatnonzero(cuts)[:, None] + [0, 1]).reshape(-1)] = np.where(open_below, np.cumsum(open_below) - 1, -1)
        beyond = flat[row + best_feature[slot]] > best_cut[slot]
        slot = place[2 * slot + beyond]
        stay = slot >= 0
        slot, flat, parts = slot[stay], flat.reshape(-1, width)[stay].reshape(-1), [p[stay] for p in parts]
        if not len(where):
            break
    if len(stats) > len(made["feature"]):  # a level that nothing was found in
        stats = stats[: len(made["feature"])]
    return merged({name: np.concatenate(values) for name, values in made.items()} | {"stats": np.concatenate(stats, axis=1)})


def merged(tree: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """A tree in which sibling leaves with the same forecast are one leaf, as MLlib prunes."""
    feature, left = tree["feature"].copy(), tree["left"].copy()
    forecast, alive = forecasts(tree["stats"]), np.ones(len(feature), bool)
    while True:
        inner = np.flatnonzero((feature >= 0) & alive)
        child = left[inner]
        same = inner[(feature[child] < 0) & (feature[child + 1] < 0) & (forecast[child] == forecast[child + 1])]
        if not len(same):
            break
        alive[left[same]] = alive[left[same] + 1] = False
        feature[same], left[same] = -1, -1
    number = np.cumsum(alive) - 1
    leaf = feature < 0
    out = {
        "feature": feature,
        "cut": np.where(leaf, NO_CUT, tree["cut"]).astype(np.int32),
        "left": np.where(leaf, -1, number[left]).astype(np.int32),
        "gain": np.where(leaf, -1.0, tree["gain"]),
    }
    return {name: values[alive] for name, values in out.items()} | {"stats": tree["stats"][:, alive]}


def forecasts(stats: np.ndarray) -> np.ndarray:
    return np.divide(stats[1], stats[0], out=np.zeros(stats.shape[1]), where=stats[0] > 0)


# -- rows in chunks ------------------------------------------------------------


def chunked(rows: DataFrame, cols: list[str], label: str, cuts: list[np.ndarray], size: int) -> DataFrame:
    """The rows as chunks: bins of the inputs, and labels."""
    kind = np.uint8 if max(map(len, cuts)) < 256 else np.uint16

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, number = TaskContext.get().partitionId(), [], 0

        def chunk(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal number
            table = pa.Table.from_batches(tables).combine_chunks()
            if any(column.null_count for column in table.columns):
                raise ValueError("the forest cannot learn from rows with a null")
            columns = [column.to_numpy() for column in table.columns]
            if any(np.isnan(column).any() for column in columns) or np.isinf(columns[-1]).any():
                raise ValueError("the forest cannot learn from rows with NaN, or with an infinite label")
            bins = np.stack([np.searchsorted(c, x, side="left").astype(kind) for c, x in zip(cuts, columns)], axis=1)
            number += 1
            row = [[(part << 32) + number], [len(bins)], [bins.tobytes()], [columns[-1].astype(np.float64).tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["chunk", "rows", "bins", "labels"])

        for batch in batches:
            while batch.num_rows:
                room = size - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(min(room, batch.num_rows))
                if sum(b.num_rows for b in held) == size:
                    yield chunk(held)
                    held = []
        if held:
            yield chunk(held)

    return rows.select(*[F.col(c).cast("double") for c in (*cols, label)]).mapInArrow(work, CHUNKS_SCHEMA)


def each_chunk(batches: Iterator[pa.RecordBatch], inputs: int, kind: type) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for chunk, rows, bins, labels in zip(*[c.to_pylist() for c in batch.columns]):
            yield chunk, np.frombuffer(bins, kind).reshape(rows, inputs), np.frombuffer(labels, np.float64)


# -- the top of the trees ------------------------------------------------------


class Tops:
    """The trees as far as they were grown over all rows: nodes in lists, children side by side."""

    def __init__(self, rules: Rules):
        self.feature = [[-1] for _ in range(rules.trees)]
        self.cut = [[NO_CUT] for _ in range(rules.trees)]
        self.left = [[-1] for _ in range(rules.trees)]
        self.gain = [[-1.0] for _ in range(rules.trees)]
        self.depth = [[0] for _ in range(rules.trees)]
        self.stats: list[list[tuple[float, float, float] | None]] = [[None] for _ in range(rules.trees)]

    def split(self, tree: int, node: int, feature: int, cut: int, gain: float, low: tuple, high: tuple) -> None:
        self.feature[tree][node], self.cut[tree][node], self.gain[tree][node] = feature, cut, gain
        self.left[tree][node] = len(self.left[tree])
        for side in (low, high):
            self.feature[tree].append(-1)
            self.cut[tree].append(NO_CUT)
            self.left[tree].append(-1)
            self.gain[tree].append(-1.0)
            self.depth[tree].append(self.depth[tree][node] + 1)
            self.stats[tree].append(side)

    def arrays(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """For each tree what ``placed`` needs; a leaf leads to itself."""
        out = []
        for feature, cut, left, depth in zip(self.feature, self.cut, self.left, self.depth):
            leaf = np.array(feature) < 0
            out.append((np.where(leaf, 0, feature), np.array(cut), np.where(leaf, np.arange(len(leaf)), left), max(depth)))
        return out


def placed(top: tuple[np.ndarray, np.ndarray, np.ndarray, int], bins: np.ndarray) -> np.ndarray:
    """The leaf of a top that each row falls in."""
    feature, cut, left, depth = top
    flat, row, node = bins.reshape(-1), np.arange(len(bins)) * bins.shape[1], np.zeros(len(bins), np.int64)
    for _ in range(depth):
        node = left[node] + (flat[row + feature[node]] > cut[node])
    return node


def found_splits(chunks: DataFrame, tops: Tops, nodes: list[tuple[int, int]], rules: Rules, kind: type) -> list[tuple]:
    """The best split of some (tree, node) over all rows: tree, node, input or -1, cut, gain, statistics of the node and its left."""
    by_tree: dict[int, list[int]] = {}
    for tree, node in nodes:
        by_tree.setdefault(tree, []).append(node)
    asked = {
        tree: (np.array(own), np.concatenate([rules.choose(rules.drawn(1, tree, node), 1) for node in own]))
        for tree, own in by_tree.items()
    }
    grown, own_bins = tops.arrays(), rules.bins

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for chunk, bins, labels in each_chunk(batches, rules.inputs, kind):
            for tree, (own, chosen) in asked.items():
                slots = np.full(len(grown[tree][0]), -1)
                slots[own] = np.arange(len(own))
                bag, slot = rules.bag(tree, chunk, len(bins)), slots[placed(grown[tree], bins)]
                rows = np.flatnonzero((bag > 0) & (slot >= 0))
                slot, w, y, flat = slot[rows], bag[rows].astype(np.float64), labels[rows], bins[rows].reshape(-1)
                row, size = np.arange(len(rows)) * rules.inputs, len(own) * own_bins
                held = sums.setdefault(tree, np.zeros((chosen.shape[1], 3, size)))
                for j in range(chosen.shape[1]):
                    key = slot * own_bins + flat[row + chosen[:, j][slot]]
                    for i, part in enumerate((w, w * y, w * y * y)):
                        held[j, i] += np.bincount(key, part, size)
        for tree, held in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([held.tobytes()], pa.binary())], ["tree", "sums"])

    def decided(table: pa.Table) -> pa.Table:
        tree = table["tree"][0].as_py()
        own, chosen = asked[tree]
        held = np.zeros((chosen.shape[1], 3, len(own), own_bins))
        for part in sorted(table["sums"].to_pylist()):  # the same sum in whatever order tasks end
            held += np.frombuffer(part, np.float64).reshape(held.shape)
        whole = held[0].sum(axis=2)
        best, feature, cut, low = np.full(len(own), -np.inf), np.full(len(own), -1), np.zeros(len(own), int), np.zeros((3, len(own)))
        for j in range(chosen.shape[1]):
            gained, at, left = best_split(list(held[j]), impurity(*whole), rules)
            better = gained > best
            best[better], feature[better], cut[better], low[:, better] = gained[better], chosen[better, j], at[better], left[:, better]
        feature[~(best > 0)] = -1
        columns = {"tree": np.full(len(own), tree, np.int32), "node": own.astype(np.int32), "feature": feature.astype(np.int32), "cut": cut.astype(np.int32), "gain": best}
        columns |= {f"{side}{i}": of[i] for side, of in (("all", whole), ("low", low)) for i in range(3)}
        return pa.table(columns)

    counts = ", ".join(f"{side}{i} double" for side in ("all", "low") for i in range(3))
    sums = chunks.mapInArrow(counted, "tree int, sums binary").repartition(max(1, len(asked)), "tree")
    found = sums.groupBy("tree").applyInArrow(decided, f"tree int, node int, feature int, cut int, gain double, {counts}")
    return [tuple(r) for r in found.collect()]


def grown_tops(chunks: DataFrame, rows: int, rules: Rules, kind: type, local_rows: int) -> Tops:
    """Cut regions of more than ``local_rows`` rows over all rows, a level at a time."""
    tops = Tops(rules)
    level = [(tree, 0) for tree in range(rules.trees)] if rows * rules.rate > local_rows else []
    while level:
        below = []
        for start in range(0, len(level), REGIONS):
            for tree, node, feature, cut, gain, *stats in found_splits(chunks, tops, level[start : start + REGIONS], rules, kind):
                whole, low = tuple(stats[:3]), tuple(stats[3:])
                tops.stats[tree][node] = tops.stats[tree][node] or whole
                if feature < 0 or tops.depth[tree][node] >= rules.depth:
                    continue
                tops.split(tree, node, feature, cut, gain, low, tuple(a - b for a, b in zip(whole, low)))
                child = tops.left[tree][node]
                below += [(tree, c) for c in (child, child + 1) if tops.stats[tree][c][0] > local_rows and unfinished(tops, tree, c, rules)]
        level = sorted(below)
    return tops


def unfinished(tops: Tops, tree: int, node: int, rules: Rules) -> bool:
    """Whether a leaf of a top may be split further."""
    return tops.depth[tree][node] < rules.depth and abs(float(impurity(*map(np.float64, tops.stats[tree][node])))) >= EPSILON


# -- the subtrees --------------------------------------------------------------


def subtrees(chunks: DataFrame, tops: Tops, rules: Rules, kind: type, local_rows: int) -> DataFrame:
    """The subtrees below the leaves of the tops that are small enough, each grown by one task."""
    regions = [
        (tree, node)
        for tree in range(rules.trees)
        for node, own in enumerate(tops.stats[tree])
        if tops.feature[tree][node] < 0 and (own is None or own[0] <= local_rows and unfinished(tops, tree, node, rules))
    ]
    grown, depths, wanted = tops.arrays(), tops.depth, {}
    for tree, node in regions:
        wanted.setdefault(tree, []).append(node)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, bins, labels in each_chunk(batches, rules.inputs, kind):
            for tree, own in wanted.items():
                slots = np.zeros(len(grown[tree][0]), bool)
                slots[own] = True
                bag, node = rules.bag(tree, chunk, len(bins)), placed(grown[tree], bins)
                rows = np.flatnonzero((bag > 0) & slots[node])
                rows = rows[np.argsort(node[rows], kind="stable")]
                first = np.flatnonzero(np.diff(node[rows], prepend=-1))
                cut = [rows[a:b] for a, b in zip(first, [*first[1:], len(rows)])]
                columns = [
                    pa.array([tree] * len(cut), pa.int32()),
                    pa.array([int(node[r[0]]) for r in cut], pa.int32()),
                    *[pa.array([of[r].tobytes() for r in cut], pa.binary()) for of in (bins, bag, labels)],
                ]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "slot", "bins", "weights", "labels"])

    def grown_here(table: pa.Table) -> pa.Table:
        tree, slot = table["tree"][0].as_py(), table["slot"][0].as_py()
        # chunks come in any order, and sums of floats and the tree should not depend on it
        parts = sorted(zip(*[table[name].to_pylist() for name in ("bins", "weights", "labels")]))
        bins, weights, labels = (np.frombuffer(b"".join(p), k) for p, k in zip(zip(*parts), (kind, np.uint8, np.float64)))
        made = grow(bins.reshape(-1, rules.inputs), weights, labels, rules.depth - depths[tree][slot], rules, rules.drawn(2, tree, slot))
        blobs = {name: [made[name].tobytes()] for name in ("feature", "cut", "left", "gain", "stats")}
        kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 5]
        values = [[tree], [slot], [len(made["feature"])], *blobs.values()]
        return pa.Table.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["tree", "slot", "nodes", *blobs])

    regions_of = chunks.mapInArrow(dealt, REGION_SCHEMA).repartition(min(MOST_TASKS, max(1, 2 * len(regions))), "tree", "slot")
    return regions_of.groupBy("tree", "slot").applyInArrow(grown_here, SUBTREE_SCHEMA)


def node_rows(below: DataFrame, tops: Tops, rules: Rules, cuts: list[np.ndarray]) -> DataFrame:
    """The nodes of all trees as MLlib stores them: the tops, and behind them the subtrees of each."""
    spark, starts = below.sparkSession, {}
    ends = [len(f) for f in tops.feature]
    roots: dict[int, set[int]] = {}
    for tree, slot, nodes in below.select("tree", "slot", "nodes").orderBy("tree", "slot").collect():
        starts[tree, slot] = ends[tree]
        ends[tree] += nodes - 1
        roots.setdefault(tree, set()).add(slot)

    def rows(tree: int, ids: np.ndarray, left: np.ndarray, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, stats: np.ndarray) -> pa.RecordBatch:
        leaf = feature < 0
        at = [0.0 if l else float(cuts[f][c]) for l, f, c in zip(leaf, feature.tolist(), cut.tolist())]
        every = pa.array(np.arange(0, 3 * len(ids) + 1, 3), pa.int32())
        one = pa.array(np.concatenate([[0], np.cumsum(~leaf)]), pa.int32())
        columns = [
            pa.array(np.full(len(ids), tree), pa.int32()),
            pa.array(ids, pa.int32()),
            pa.array(forecasts(stats)),
            pa.array(impurity(*stats)),
            pa.ListArray.from_arrays(every, pa.array(np.ascontiguousarray(stats.T).reshape(-1))),
            pa.array(stats[0].astype(np.int64)),
            pa.array(gain),
            pa.array(left, pa.int32()),
            pa.array(np.where(leaf, -1, left + 1), pa.int32()),
            pa.array(feature, pa.int32()),
            pa.ListArray.from_arrays(one, pa.array(np.array(at)[~leaf])),
        ]
        return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in NODE_SCHEMA.split(", ")])

    def of_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"feature": np.int32, "cut": np.int32, "left": np.int32, "gain": np.float64, "stats": np.float64}
        for batch in batches:
            for line in batch.to_pylist():
                feature, cut, left, gain, stats = (np.frombuffer(line[name], kind) for name, kind in kinds.items())
                start = starts[line["tree"], line["slot"]]
                ids = np.arange(len(feature)) + start - 1
                ids[0] = line["slot"]
                yield rows(line["tree"], ids, np.where(left < 0, -1, left + start - 1), feature, cut, gain, stats.reshape(3, -1))

    def of_tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                own = np.array([n for n in range(len(tops.feature[tree])) if n not in roots.get(tree, ())], int)
                if len(own):  # a bag without a row has no statistics
                    stats = np.array([tops.stats[tree][n] or (0.0, 0.0, 0.0) for n in own]).T
                    yield rows(tree, own, *[np.array(of[tree])[own] for of in (tops.left, tops.feature, tops.cut, tops.gain)], stats)

    upper = spark.range(0, rules.trees, 1, 1).mapInArrow(of_tops, NODE_SCHEMA)
    return below.mapInArrow(of_subtrees, NODE_SCHEMA).unionByName(upper)


def fit(forest: RandomForestRegressor, rows: DataFrame, cols: list[str], label: str, assembler, local_rows: int = LOCAL_ROWS) -> RandomForestRegressionModel:
    """Fit ``forest`` on rows that are kept; they are read a few times."""
    spark, count = rows.sparkSession, rows.count()
    if not count:
        raise ValueError("the forest has no rows to learn from")
    cols, trees = list(cols), forest.getNumTrees()
    rules = Rules(
        trees=trees,
        depth=forest.getMaxDepth(),
        seed=forest.getSeed(),
        bootstrap=forest.getBootstrap(),
        rate=forest.getSubsamplingRate(),
        inputs=len(cols),
        chosen=inputs_of_node(forest.getFeatureSubsetStrategy(), len(cols), trees),
        least_rows=forest.getMinInstancesPerNode(),
        least_weight=forest.getMinWeightFractionPerNode() * count,
        least_gain=forest.getMinInfoGain(),
    )
    enough = max(forest.getMaxBins() ** 2, SPLIT_ROWS)
    inputs = rows.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    # as MLlib does: thresholds come from a number of rows that is enough for quantiles, splits from all rows
    seen = (inputs.sample(False, enough / count, rules.seed) if count > enough else inputs).toArrow()
    most = min(forest.getMaxBins(), count) - 1
    cuts = [thresholds(c.drop_null().to_numpy(), most) for c in seen.columns]
    rules = Rules(**(rules.__dict__ | {"bins": max(map(len, cuts)) + 1}))
    kind = np.uint8 if rules.bins <= 256 else np.uint16

    tasks = spark.sparkContext.defaultParallelism
    size = min(CHUNK_ROWS, -(-count // (2 * tasks)))
    chunks = _stored(chunked(rows, cols, label, cuts, size).repartition(2 * tasks), "forest-rows")
    tops = grown_tops(chunks, count, rules, kind, local_rows)
    below = _stored(subtrees(chunks, tops, rules, kind, local_rows), "forest-subtrees")

    # MLlib's own form of a model of these parameters, with the nodes put in
    path = work_path(spark, "forest")
    blank = spark.range(0, max(2, min(count, forest.getMaxBins())), 1, 1).select(*[F.lit(0.0).alias(c) for c in (*cols, label)])
    forest.fit(assembler.transform(blank)).write().save(path)
    split = F.struct("featureIndex", F.col("threshold").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    names = ("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild")
    stored = node_rows(below, tops, rules, cuts).select("treeID", F.struct(*names, split.alias("split")).alias("nodeData"))
    stored.write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestRegressionModel.load(path)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
