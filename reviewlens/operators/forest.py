"""Random forest over the non-zero slots of sparse vectors (M-04).

MLlib's forest turns each document into a dense row, one number a slot, whatever the document holds: 262 KB a document at
2^16 slots.  Here a document keeps its own slots and their bins, and a zero is what its slots leave over.  The rules are
MLlib's: the same split candidates from the same number of sampled rows, Poisson bootstrap, a slot subset a node, Gini
gain, pruning of equal sibling leaves, class shares summed over trees.  A level is grown by passes over all documents, each
for as many nodes as ``CELLS`` allows; a pass gives one histogram a node and part, and a node's best split is found by
one task.  The driver sees splits and class counts of the nodes, and the split candidates (at most ``maxBins`` a slot).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators.features import few_parts
from reviewlens.session import drop, ship_package, stage

#: Vectors of at least so many slots are grown here where they are sparse; narrower or dense ones by MLlib.
WIDE = 1024
#: Histogram cells of a pass (8 bytes each, once a task); at least one node is taken.
CELLS = 1 << 23
#: Rows and entries that a task looks at together.
ROWS, ENTRIES = 1024, 1 << 18
#: Rows that split candidates are taken from, as in MLlib.
SAMPLE = 10_000


class Forest:
    """Nodes of all trees: the first ``trees`` nodes are roots; a node without children has ``left`` -1."""

    def __init__(self, trees: int, classes: int):
        self.trees, self.classes = trees, classes
        self.slot, self.bin, self.left, self.stats = ([v] * trees for v in (-1, -1, -1, None))
        self.tree = list(range(trees))

    def split(self, node: int, slot: int, at: int, left, right) -> list[int]:
        self.slot[node], self.bin[node], self.left[node] = slot, at, len(self.slot)
        for s in (left, right):
            for column, v in ((self.slot, -1), (self.bin, -1), (self.left, -1), (self.stats, s), (self.tree, self.tree[node])):
                column.append(v)
        return [self.left[node], self.left[node] + 1]

    def prune(self) -> None:
        """Sibling leaves of the same class become one leaf, from below."""
        for node in reversed(range(len(self.slot))):
            a = self.left[node]
            if a >= 0 and self.left[a] < 0 and self.left[a + 1] < 0 and np.argmax(self.stats[a]) == np.argmax(self.stats[a + 1]):
                self.left[node] = -1

    def arrays(self):
        return tuple(np.array(x, np.int32) for x in (self.slot, self.bin, self.left))


def candidates(values: np.ndarray, counts: np.ndarray, rows: float, splits: int) -> list[float]:
    """Split candidates of a slot from its distinct non-zero values, ascending, and their counts among ``rows`` rows (MLlib's rule)."""
    zeros = rows - counts.sum()
    if zeros > 1e-9 * max(rows, 1):
        at = int(np.searchsorted(values, 0.0))
        values, counts = np.insert(values, at, 0.0), np.insert(counts.astype(float), at, zeros)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= splits:
        return middle.tolist()
    stride = rows / (splits + 1)
    out, current, target = [], float(counts[0]), stride
    for c, m in zip(counts[1:].tolist(), middle.tolist()):
        before, current = current, current + c
        if abs(before - target) < abs(current - target):
            out.append(m)
            target += stride
    return out


def split_candidates(points: DataFrame, rows: int, slots: int, max_bins: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, thresholds): those of slot s are ``thresholds[starts[s]:starts[s + 1]]``; points have ``slots, values``."""
    splits = min(max_bins, rows) - 1
    share = min(1.0, max(max_bins * max_bins, SAMPLE) / rows)
    some = points if share == 1.0 else points.sample(share, seed)
    long = some.select(F.inline(F.arrays_zip(F.col("slots").alias("slot"), F.col("values").alias("v"))))
    kept = long.where("v <> 0").groupBy("slot", "v").agg(F.count(F.lit(1)).alias("c")).groupBy("slot").agg(
        F.sort_array(F.collect_list(F.struct("v", "c"))).alias("vc")).select("slot", "vc.v", "vc.c")

    def run(batches):
        for b in batches:
            v, c = b.column("v"), b.column("c")
            found = [candidates(v[i].values.to_numpy(), c[i].values.to_numpy(), share * rows, splits) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column("slot"), pa.array(found, pa.list_(pa.float64()))], ["slot", "at"])

    t = kept.mapInArrow(run, "slot int, at array<double>").toArrow()
    slot, at = t.column("slot").to_numpy(), t.column("at").combine_chunks()
    n = np.zeros(slots, np.int64)
    if not len(slot):
        return np.zeros(slots + 1, np.int64), np.zeros(0)
    n[slot] = np.diff(at.offsets.to_numpy())
    order = np.argsort(slot)
    flat = at.take(pa.array(order)).flatten().to_numpy()
    return np.concatenate([[0], np.cumsum(n)]), flat


def bins_of(slot: np.ndarray, value: np.ndarray, starts: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Number of the slot's candidates below the value."""
    lo, hi = starts[slot], starts[slot + 1]
    first = lo
    while len(lo) and (lo < hi).any():
        mid = (lo + hi) // 2
        below = (lo < hi) & (thresholds[np.minimum(mid, len(thresholds) - 1)] < value)
        lo, hi = np.where(below, mid + 1, lo), np.where(below, hi, np.minimum(mid, hi))
    return (lo - first).astype(np.uint8)


def pieces(offsets: np.ndarray):
    """(first, last) of row ranges of at most ``ROWS`` rows and ``ENTRIES`` entries, or one row."""
    a = 0
    while a < len(offsets) - 1:
        b = int(np.searchsorted(offsets, offsets[a] + ENTRIES, side="right")) - 1
        b = max(a + 1, min(b, a + ROWS, len(offsets) - 1))
        yield a, b
        a = b


def routed(rows: int, row, slot, at, zero, nodes, trees: int, width: int) -> np.ndarray:
    """(rows x trees) the node each row has come to; ``at`` are the entries' bins, ``zero`` the bin of a zero by slot."""
    split, cut, left = nodes
    here = np.broadcast_to(np.arange(trees, dtype=np.int32), (rows, trees)).copy()
    used = np.unique(split[left >= 0])
    column = np.full(width, -1, np.int32)
    column[used] = np.arange(len(used))
    dense = np.broadcast_to(zero[used], (rows, len(used))).copy()
    known = column[slot] >= 0
    dense[row[known], column[slot[known]]] = at[known]
    lines = np.arange(rows)[:, None]
    while True:
        inner = left[here] >= 0
        if not inner.any():
            return here
        value = dense[lines, np.where(inner, column[split[here]], 0)]
        here = np.where(inner, left[here] + (value > cut[here]), here)


def poisson(keys: np.ndarray, trees: int) -> np.ndarray:
    """(rows x trees) weights of the bootstrap, Poisson with mean 1, from a row's key and the tree."""
    x = keys.view(np.uint64)[:, None] + np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
    x = (x ^ (x >> np.uint64(31))) >> np.uint64(11)
    cdf = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
    return np.searchsorted(cdf, x * 2.0 ** -53, side="right")


def subset(seed: int, node: int, slots: int, some: int) -> np.ndarray:
    if some >= slots:
        return np.arange(slots)
    return np.sort(np.random.default_rng((seed, node)).choice(slots, some, replace=False))


def best_split(hist: np.ndarray, total: np.ndarray, zero: np.ndarray, splits: np.ndarray, least: int, gain_least: float):
    """(place, bin, gain, left) of the split of greatest Gini gain, or None; ``hist`` is slots x bins x classes.

    What a slot's non-zero bins leave of ``total`` is in its zero bin.
    """
    places = np.arange(len(hist))
    hist[places, zero] = 0
    hist[places, zero] = total - hist.sum(axis=1)
    left = hist.cumsum(axis=1)[:, :-1]
    right = total - left
    nl, nr, n = left.sum(axis=2), right.sum(axis=2), total.sum()

    def gini(counts, size):  # in MLlib's order of operations, so that ties fall alike
        out = np.ones(size.shape)
        for c in range(counts.shape[-1]):
            out = out - (counts[..., c] / np.maximum(size, 1)) ** 2
        return out

    gain = gini(total, n) - nl / n * gini(left, nl) - nr / n * gini(right, nr)
    ok = (nl >= least) & (nr >= least) & (np.arange(hist.shape[1] - 1) < splits[:, None]) & (gain >= gain_least) & (gain > 0)
    if not ok.any():
        return None
    p, b = np.unravel_index(np.argmax(np.where(ok, gain, -1)), gain.shape)
    return int(p), int(b), float(gain[p, b]), left[p, b]


def flat_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and values of a list column."""
    ends = column.offsets.to_numpy()
    return ends - ends[0], column.flatten().to_numpy()


def grow(points: DataFrame, rows: int, slots: int, classes: int, trees: int, depth: int, max_bins: int, some: int, least: int,
         gain_least: float, bootstrap: bool, seed: int) -> tuple[Forest, np.ndarray, np.ndarray]:
    """Forest grown on ``points`` (label int, slots, values), with starts and thresholds of the split candidates."""
    spark = points.sparkSession
    ship_package(spark)
    starts, thresholds = split_candidates(points, rows, slots, max_bins, seed)
    every = np.arange(slots)
    zero = bins_of(every, np.zeros(slots), starts, thresholds)
    splits = np.diff(starts)
    shared = spark.sparkContext.broadcast((starts, thresholds, zero, splits))

    def to_bins(batches):
        starts, thresholds, zero, _ = shared.value
        for b in batches:
            ends, slot = flat_of(b.column("slots"))
            at = bins_of(slot, b.column("values").flatten().to_numpy(), starts, thresholds)
            tells = at != zero[slot]
            ends = np.concatenate([[0], np.cumsum(tells)])[ends].astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (slot[tells], at[tells].astype(np.int16))]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("label"), *lists], ["key", "label", "slots", "bins"])

    keyed = points.select(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)).alias("key"), "label", "slots", "values")
    binned = stage(keyed.mapInArrow(to_bins, "key bigint, label int, slots array<int>, bins array<smallint>"), "binned")
    data = few_parts(binned)
    forest = Forest(trees, classes)
    bins = int(splits.max(initial=0)) + 1
    width = some * bins * classes + classes  # cells of a node: its histogram, then its class counts
    active = list(range(trees))
    for _ in range(depth):
        grown = []
        for first in range(0, len(active), max(1, CELLS // width)):
            group = active[first:first + max(1, CELLS // width)]
            for r in sorted(_pass(data, group, forest, shared, slots, bins, some, width, least, gain_least, bootstrap, seed)):
                node, slot, at, total, left = r
                forest.stats[node] = np.array(total)
                if slot >= 0:
                    grown += forest.split(node, slot, at, np.array(left), np.array(total) - np.array(left))
        # A pure node stays a leaf.
        active = [n for n in grown if np.count_nonzero(forest.stats[n]) > 1]
        if not active:
            break
    drop(binned)
    forest.prune()
    return forest, starts, thresholds


def _pass(data, group, forest, shared, slots, bins, some, width, least, gain_least, bootstrap, seed):
    """Best splits of a group of nodes: (node, slot or -1, bin, class counts, class counts on the left)."""
    trees, classes = forest.trees, forest.classes
    chosen = np.concatenate([subset(seed, n, slots, some) for n in group])  # slot of each (node, place)
    order = np.argsort(chosen, kind="stable")
    by_slot = np.searchsorted(chosen[order], np.arange(slots + 1))
    local = np.full(len(forest.slot), -1, np.int32)
    local[group] = np.arange(len(group))
    tree = np.array(forest.tree, np.int32)
    plan = data.sparkSession.sparkContext.broadcast((forest.arrays(), np.array(group, np.int32), order, by_slot, local, tree))

    def count(batches):
        nodes, group, order, by_slot, local, tree = plan.value
        zero = shared.value[2]
        cells = np.zeros(len(group) * width, np.int64)
        for b in batches:
            ends, slots_in = flat_of(b.column("slots"))
            at_in, label_in, keys = b.column("bins").flatten().to_numpy(), b.column("label").to_numpy(), b.column("key").to_numpy()
            for x, y in pieces(ends):
                slot, at, label = slots_in[ends[x]:ends[y]], at_in[ends[x]:ends[y]], label_in[x:y]
                row = np.repeat(np.arange(y - x), np.diff(ends[x:y + 1]))
                here = routed(y - x, row, slot, at, zero, nodes, trees, slots)
                weight = poisson(keys[x:y], trees) if bootstrap else np.ones((y - x, trees), np.int64)
                mine = local[here]
                r, t = np.nonzero((mine >= 0) & (weight > 0))
                np.add.at(cells, (mine[r, t] + 1) * width - classes + label[r], weight[r, t])
                n = by_slot[slot + 1] - by_slot[slot]
                e = np.repeat(np.arange(len(slot)), n)
                place = order[np.arange(len(e)) + np.repeat(by_slot[slot] - (np.cumsum(n) - n), n)]
                node, of = place // some, row[e]
                t = tree[group[node]]
                hit = (here[of, t] == group[node]) & (weight[of, t] > 0)
                e, node, of, t, place = e[hit], node[hit], of[hit], t[hit], place[hit] % some
                np.add.at(cells, node * width + (place * bins + at[e]) * classes + label[of], weight[of, t])
        full = np.flatnonzero(cells)
        ends = np.searchsorted(full, np.arange(len(group) + 1) * width).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for v in ((full % width).astype(np.int32), cells[full])]
        some_cells = pa.array(np.diff(ends) > 0)
        yield pa.RecordBatch.from_arrays([pa.array(group), *lists], ["node", "cell", "n"]).filter(some_cells)

    def best(table: pa.Table) -> pa.Table:
        _, _, zero, splits = shared.value
        node = table.column("node")[0].as_py()
        cells = np.zeros(width)
        for cell, n in zip(table.column("cell"), table.column("n")):
            cells[cell.values.to_numpy()] += n.values.to_numpy()
        total, mine = cells[-classes:], subset(seed, node, slots, some)
        found = best_split(cells[:-classes].reshape(some, bins, classes), total, zero[mine], splits[mine], least, gain_least)
        p, at, _, left = found or (None, -1, 0.0, total)
        return pa.table({"node": pa.array([node], pa.int32()), "slot": pa.array([-1 if p is None else int(mine[p])], pa.int32()),
                         "bin": pa.array([at], pa.int32()), "total": [total.tolist()], "left": [left.tolist()]})

    counted = data.mapInArrow(count, "node int, cell array<int>, n array<bigint>")
    return [tuple(r) for r in counted.groupBy("node").applyInArrow(
        best, "node int, slot int, bin int, total array<double>, left array<double>").collect()]


class SlotForest(RandomForestClassifier):
    """MLlib's estimator with its parameters; wide sparse vectors are grown by ``grow``, other settings and inputs by MLlib."""

    def _fit(self, dataset):
        get = self.getOrDefault
        ways = {"auto": "all" if get(self.numTrees) == 1 else "sqrt"}
        way = ways.get(get(self.featureSubsetStrategy), get(self.featureSubsetStrategy))
        plain = (way in ("all", "sqrt") and get(self.impurity) == "gini" and get(self.subsamplingRate) == 1.0
                 and not self.isSet(self.weightCol) and not self.isSet(self.thresholds) and get(self.maxBins) <= 256
                 and get(self.minWeightFractionPerNode) == 0.0 and get(self.maxDepth) > 0)
        if not plain:
            return super()._fit(dataset)
        v, y = F.unwrap_udt(get(self.featuresCol)), F.col(get(self.labelCol))
        seen = dataset.agg(F.count(F.lit(1)).alias("n"), F.min(v["type"]).alias("lo"), F.max(v["type"]).alias("hi"),
                           F.max(v["size"]).alias("slots"), F.max(y).alias("y"), F.min(y).alias("y0"),
                           F.max(y != F.floor(y)).alias("odd"), F.count(v["type"]).alias("vectors"), F.count(y).alias("labels")).first()
        if (not seen["n"] or seen["lo"] != 0 or seen["hi"] != 0 or seen["slots"] < WIDE or seen["odd"] or seen["y0"] < 0
                or not seen["n"] == seen["vectors"] == seen["labels"]):
            return super()._fit(dataset)
        points = dataset.select(y.cast("int").alias("label"), v["indices"].alias("slots"), v["values"].alias("values"))
        some = seen["slots"] if way == "all" else math.ceil(math.sqrt(seen["slots"]))
        forest, starts, thresholds = grow(
            points, seen["n"], seen["slots"], int(seen["y"]) + 1, get(self.numTrees), get(self.maxDepth), get(self.maxBins), some,
            get(self.minInstancesPerNode), get(self.minInfoGain), get(self.bootstrap), get(self.seed) & (2 ** 63 - 1))
        return self._copyValues(SlotForestModel(forest, seen["slots"], starts, thresholds))


class SlotForestModel(Model, HasFeaturesCol, HasRawPredictionCol, HasProbabilityCol, HasPredictionCol):
    """Class shares of the leaves a row comes to, summed over trees; columns and ties as MLlib's model gives them."""

    def __init__(self, forest: Forest, slots: int, starts: np.ndarray, thresholds: np.ndarray):
        super().__init__()
        stats = np.array(forest.stats)
        self.trees, self.slots, self.starts, self.thresholds = forest.trees, slots, starts, thresholds
        self.nodes, self.shares = forest.arrays(), stats / np.maximum(stats.sum(axis=1, keepdims=True), 1)

    def _transform(self, dataset):
        ship_package(dataset.sparkSession)
        zero = bins_of(np.arange(self.slots), np.zeros(self.slots), self.starts, self.thresholds)
        sent = dataset.sparkSession.sparkContext.broadcast(
            (self.nodes, self.shares, self.starts, self.thresholds, zero, self.trees, self.slots))

        @F.arrow_udf("array<double>")
        def votes(slots: pa.Array, values: pa.Array) -> pa.Array:
            nodes, shares, starts, thresholds, zero, trees, width = sent.value
            ends, slot = flat_of(slots)
            value, out = values.flatten().to_numpy(), []
            for x, y in pieces(ends):
                s = slot[ends[x]:ends[y]]
                row = np.repeat(np.arange(y - x), np.diff(ends[x:y + 1]))
                at = bins_of(s, value[ends[x]:ends[y]], starts, thresholds)
                out.append(shares[routed(y - x, row, s, at, zero, nodes, trees, width)].sum(axis=1))
            flat = np.concatenate([*out, np.zeros((0, shares.shape[1]))]).reshape(-1)
            return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, shares.shape[1], dtype=np.int32)), pa.array(flat))

        v = F.unwrap_udt(self.getFeaturesCol())
        slots = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
        d = dataset.withColumn("_votes", votes(slots, v["values"]))
        total = F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x)
        return d.select(*dataset.columns, array_to_vector("_votes").alias(self.getRawPredictionCol()),
                        array_to_vector(F.transform("_votes", lambda x: x / total)).alias(self.getProbabilityCol()),
                        (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double").alias(self.getPredictionCol()))
