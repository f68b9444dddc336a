"""Forests and boosted trees grown from tallies over packed rows.

The same learners as Spark ML's: candidate bounds of a feature from its distribution (``maxBins``), trees grown level by level
from tallies of the rows in every bin, the split of the greatest gain, leaves of one forest label merged. Only the rows look
otherwise. A feature's bin takes as many bits as it needs and several features share a byte, so that one tally of a byte's 256
values, added up along its bits, is the tally of all its features; most features here have two values. Draws (bootstrap,
subsample, features of a node) are seeded by block, tree and level, not by task. Fitted models are Spark's own classes, loaded
from their stored form.

Unlike Spark ML's, candidate bounds come from all rows (through summaries of at most ``SUMMARY`` values) instead of some 10,000.
"""

from __future__ import annotations

import json
import math
import operator
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.models.together import MOST_TOGETHER, dealt, run_together, slots
from ebbtide.session import scratch_path, ship_package, written

SUMMARY = 4096  # values of a feature that a summary keeps
TASK_BLOCKS = 200  # blocks of a task that tallies for a forest
_EPSILON = 2.0**-52  # Spark's bound for an impurity of zero
_STORED = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
    "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)



# --- bounds and packing -------------------------------------------------------------------------------
def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their weights; beyond ``SUMMARY`` values the weights move up to values at equal steps of weight."""
    values, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    weights = np.bincount(at, np.concatenate([a[1], b[1]]), len(values))
    if len(values) <= SUMMARY:
        return values, weights
    total = weights.cumsum()
    kept = np.unique(np.searchsorted(total, total[-1] * np.arange(1, SUMMARY) / SUMMARY))
    kept = np.unique(np.concatenate([[0], kept, [len(values) - 1]]))
    return values[kept], np.diff(total[kept], prepend=0.0)


def bounds_of(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Spark's candidate bounds: midpoints of all values if they are few, else of values at equal steps of weight."""
    values, weights = values[weights > 0], weights[weights > 0]
    if len(values) - 1 <= most:
        return (values[1:] + values[:-1]) / 2
    found, step = [], weights.sum() / (most + 1)
    total, target = weights.cumsum(), step
    for k in range(1, len(values)):
        if abs(total[k - 1] - target) < abs(total[k] - target):
            found.append((values[k - 1] + values[k]) / 2)
            target += step
    return np.array(found)


@dataclass
class Packing:
    """Where each feature's bin lies: its byte, its lowest bit and its mask; and its cells in a row of tallies."""

    bounds: list[np.ndarray]
    width: int = 0  # bytes of a row
    byte: np.ndarray = field(init=False)
    shift: np.ndarray = field(init=False)
    mask: np.ndarray = field(init=False)

    def __post_init__(self):
        bits = np.array([len(b).bit_length() for b in self.bounds])
        if bits.max(initial=0) > 8:
            raise ValueError("more than 256 bins")
        self.byte, self.shift, free = np.zeros(len(bits), int), np.zeros(len(bits), int), []
        for f in (f for f in np.argsort(-bits, kind="stable") if bits[f]):
            at = next((k for k, left in enumerate(free) if left >= bits[f]), len(free))
            if at == len(free):
                free.append(8)
            self.byte[f], self.shift[f] = at, 8 - free[at]
            free[at] -= bits[f]
        self.width = max(len(free), 1)
        self.mask = ((1 << bits) - 1) << self.shift
        sizes = [len(b) + 1 if len(b) else 0 for b in self.bounds]
        self.cell_feature = np.repeat(np.arange(len(sizes)), sizes)
        self.cell_bin = np.concatenate([np.arange(0), *[np.arange(s) for s in sizes]])
        self.last = self.cell_bin == np.array(sizes)[self.cell_feature] - 1
        self.first = np.arange(len(self.cell_bin)) - self.cell_bin  # the first cell of the cell's feature
        self.sums = []  # for each byte: its cells, and which of the 256 values count for them
        for k in range(self.width):
            cells = np.flatnonzero(self.byte[self.cell_feature] == k)
            f = self.cell_feature[cells]
            of = (np.arange(256)[:, None] & self.mask[f]) >> self.shift[f] == self.cell_bin[cells]
            self.sums.append((cells, of.astype(float)))

    def pack(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((self.width, len(x)), np.uint8)
        for f, bounds in enumerate(self.bounds):
            if len(bounds):
                out[self.byte[f]] |= (np.searchsorted(bounds, x[:, f], "left") << self.shift[f]).astype(np.uint8)
        return out


def tally(packing: Packing, codes: np.ndarray, slot: np.ndarray, n: int, weights: list[np.ndarray | None]) -> np.ndarray:
    """Sums of each weight (rows for None) by slot and cell."""
    out, base = np.zeros((len(weights), n, len(packing.cell_bin))), slot * 256
    for k, (cells, of) in enumerate(packing.sums):
        key = base + codes[k]
        for s, w in enumerate(weights):
            out[s][:, cells] = np.bincount(key, w, n * 256).reshape(n, 256) @ of
    return out


def _lefts(packing: Packing, sums: np.ndarray) -> np.ndarray:
    """What lies left of the split after each cell."""
    upto = sums.cumsum(-1)
    return upto - (upto - sums)[..., packing.first]


def _down(codes: np.ndarray, place: np.ndarray, level: int, byte: np.ndarray, mask: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """The places of rows one level deeper. Nodes are numbered from the root, places from the left of a level."""
    node = place + (2**level - 1)
    value = codes.ravel()[byte[node] * codes.shape[1] + np.arange(codes.shape[1])]
    return 2 * place + ((value & mask[node]) > bound[node])


class Tree:
    """A growing tree: its splits by node, and each node's sums."""

    def __init__(self, depth: int, sums: int):
        inner, self.depth = 2**depth - 1, depth
        self.feature, self.bin, self.gain = np.full(inner, -1), np.zeros(inner, int), np.zeros(inner)
        self.byte, self.mask, self.bound = np.zeros(inner, int), np.zeros(inner, np.uint8), np.zeros(inner, np.uint8)
        self.sums = np.zeros((2 * inner + 1, sums))
        self.open = np.array([0])  # places of the level that may be split

    def split(self, packing: Packing, level: int, cells: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """Split the open places with a gain; the new nodes' places."""
        split = gains > 0
        node, cell = self.open[split] + 2**level - 1, cells[split]
        f = packing.cell_feature[cell]
        self.feature[node], self.bin[node], self.gain[node] = f, packing.cell_bin[cell], gains[split]
        self.byte[node], self.mask[node] = packing.byte[f], packing.mask[f]
        self.bound[node] = packing.cell_bin[cell] << packing.shift[f]
        return (2 * self.open[split][:, None] + [0, 1]).ravel()

    def nodes(self, packing: Packing, boosted: bool, weights: tuple | None) -> list[tuple]:
        """The stored form of the nodes, from the root leftwards. Two leaves of the same prediction are one."""

        def facts(node: int) -> tuple[float, float, list[float], int]:
            s = self.sums[node]
            if boosted:
                mean = s[1] / s[0] if s[0] else 0.0
                return float(mean), float(s[2] / s[0] - mean * mean if s[0] else 0.0), s[:3].tolist(), int(round(s[3]))
            w = s[:2] * weights if weights else s[2:4]
            share = w / max(w.sum(), 1e-300)
            return float(np.argmax(w)), float(1 - (share * share).sum()), w.tolist(), int(round(s[0] + s[1]))

        def walk(node: int, first: int) -> list[tuple]:
            prediction, impurity, stats, count = facts(node)
            if node < len(self.feature) and self.feature[node] >= 0:
                left = walk(2 * node + 1, first + 1)
                right = walk(2 * node + 2, first + 1 + len(left))
                if len(left) > 1 or len(right) > 1 or left[0][1] != right[0][1]:
                    split = (int(self.feature[node]), [float(packing.bounds[self.feature[node]][self.bin[node]])], -1)
                    return [(first, prediction, impurity, stats, count, float(self.gain[node]), first + 1, first + 1 + len(left), split), *left, *right]
                prediction = left[0][1]
            return [(first, prediction, impurity, stats, count, -1.0, -1, -1, (-1, [], -1))]

        return walk(0, 0)


# --- packed rows ----------------------------------------------------------------------------------------
@dataclass
class Packed:
    """Blocks of packed rows (part, block, bytes of the rows, labels, weights), and the weight of each label where it has but one."""

    rows: DataFrame
    packing: Packing
    blocks: int
    label_weights: tuple[float, float] | None

    def dealt(self, tasks: int) -> RDD:
        return dealt(self.rows, tasks)


def packed(rows: DataFrame, features: str, label: str, weight: str | None = None, max_bins: int = 32) -> Packed:
    """Two passes over the vectors: the features' summaries, then the packed rows, which are written once."""
    ship_package(rows.sparkSession)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), w.alias("w"))

    def arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        return x, batch["y"].to_numpy(zero_copy_only=False), batch["w"].to_numpy(zero_copy_only=False)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        labels = np.array([[np.inf, -np.inf], [np.inf, -np.inf]])
        none = (np.zeros(0), np.zeros(0))
        for batch in (b for b in batches if b.num_rows):
            x, y, w = arrays(batch)
            if not np.isin(y, (0, 1)).all():
                raise ValueError("labels other than 0 and 1")
            if not (w >= 0).all():
                raise ValueError("a weight that is missing or below zero")
            for f in range(x.shape[1]):
                found[f] = _merged(found.get(f, none), (x[:, f], w))
            for k in (0, 1):
                of = w[y == k]
                labels[k] = min(labels[k, 0], of.min(initial=np.inf)), max(labels[k, 1], of.max(initial=-np.inf))
        kinds = [*found, -1]
        values = [*[found[f][0].tobytes() for f in found], labels[:, 0].tobytes()]
        weights = [*[found[f][1].tobytes() for f in found], labels[:, 1].tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(values, pa.binary()), pa.array(weights, pa.binary())], ["f", "v", "w"])

    def joined(a: tuple, b: tuple) -> tuple:
        return (np.minimum(a[0], b[0]), np.maximum(a[1], b[1]), True) if a[2] else (*_merged(a[:2], b[:2]), False)

    found = rows.mapInArrow(summaries, "f int, v binary, w binary").rdd.map(
        lambda r: (r[0], (np.frombuffer(r[1]), np.frombuffer(r[2]), r[0] < 0))
    ).reduceByKey(joined).mapValues(lambda s: s[:2] if s[2] else bounds_of(s[0], s[1], max_bins - 1)).collectAsMap()
    if len(found) < 2:
        raise ValueError("no rows to fit on")
    least, most = found.pop(-1)
    packing = Packing([found[f] for f in range(len(found))])
    label_weights = tuple(float(a) if a == b else 1.0 for a, b in zip(least, most, strict=True)) if (least >= most).all() else None

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(b for b in batches if b.num_rows):
            x, y, w = arrays(batch)
            columns = [[part], [k], [packing.pack(x).tobytes()], [y.astype(np.uint8).tobytes()], [w.tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["part", "block", "codes", "y", "w"])

    table = written(rows.mapInArrow(blocks, "part int, block int, codes binary, y binary, w binary"), "packed")
    return Packed(table, packing, table.count(), label_weights)


def _loaded(blocks: Iterable[tuple], width: int) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray, np.ndarray]:
    """The task's blocks in their order: (part, block, rows) of each, and all their bytes, labels and weights."""
    blocks = sorted(blocks, key=lambda b: b[:2])
    which = [(b[0], b[1], len(b[3])) for b in blocks]
    codes = np.concatenate([np.zeros((width, 0), np.uint8), *[np.frombuffer(b[2], np.uint8).reshape(width, -1) for b in blocks]], 1)
    y = np.frombuffer(b"".join(b[3] for b in blocks), np.uint8)
    return which, codes, y, np.frombuffer(b"".join(b[4] for b in blocks))


# --- forest -----------------------------------------------------------------------------------------------
def _chosen(seed: int, tree: int, level: int, features: int, most: int) -> np.ndarray:
    """The features that each place of a level may be split on."""
    drawn = np.random.default_rng([seed, 1, tree, level]).random((2**level, features))
    return drawn <= np.partition(drawn, most - 1, axis=1)[:, most - 1 : most]


def _subset(strategy: str, features: int) -> int:
    return {"auto": math.ceil(math.sqrt(features)), "sqrt": math.ceil(math.sqrt(features)), "all": features}[strategy]


def _times(bootstrap: bool, rate: float) -> np.ndarray:
    """How often a row is taken, by the 16 bits that are drawn for it: Poisson, or once at most."""
    at = (np.arange(65536) + 0.5) / 65536
    if not bootstrap:
        return (at < rate).astype(np.uint8)
    return np.searchsorted(np.cumsum([math.exp(-rate) * rate**k / math.factorial(k) for k in range(20)]), at).astype(np.uint8)


def grow_forest(
    data: Packed, spark: SparkSession, trees: int, depth: int, seed: int, least: int, subset: int, rate: float = 1.0, bootstrap: bool = True
) -> list[Tree]:
    """A job for each level of all trees: tasks tally their rows for the drawn features of every open node, tallies are added up
    and searched for the best split by tree, and the driver gets the splits."""
    packing, weights, features = data.packing, data.label_weights, len(data.packing.bounds)
    kinds = 2 if weights else 4  # rows of either label, and their weights where these vary
    grown = [Tree(depth, kinds) for _ in range(trees)]
    at_once = slots(spark)
    rows = data.dealt(at_once * math.ceil(data.blocks / (at_once * TASK_BLOCKS)))
    drawn = _times(bootstrap, rate)
    for level in range(depth):
        alive = [t for t in range(trees) if len(grown[t].open)]
        if not alive:
            break
        inner = 2**level - 1
        state = {t: (grown[t].byte[:inner], grown[t].mask[:inner], grown[t].bound[:inner], grown[t].open) for t in alive}

        def tallies(blocks: Iterator[tuple], state=state, level=level) -> Iterator[tuple[int, np.ndarray]]:
            which, codes, y, w = _loaded(blocks, packing.width)
            if not which:
                return
            for t, (byte, mask, bound, places) in state.items():
                times = drawn[np.concatenate([np.random.default_rng([seed, 0, t, *b[:2]]).integers(0, 65536, b[2], np.uint16) for b in which])]
                of = np.flatnonzero(times)
                mine, n = codes[:, of], len(places)
                place = np.zeros(len(of), int)
                for k in range(level):
                    place = _down(mine, place, k, byte, mask, bound)
                slot = np.full(2**level, -1)
                slot[places] = np.arange(n)
                slot = slot[place]
                if (slot < 0).any():
                    kept = np.flatnonzero(slot >= 0)
                    slot, mine, of = slot[kept], mine[:, kept], of[kept]
                slot = slot + n * y[of].astype(int)
                count = times[of].astype(float)
                parts = [count] if weights else [count, count * w[of]]
                sums = tally(packing, mine, slot, 2 * n, parts).reshape(kinds, n, -1)
                totals = np.stack([np.bincount(slot, p, 2 * n) for p in parts])
                cells = _chosen(seed, t, level, features, subset)[places][:, packing.cell_feature]
                yield t, np.concatenate([totals.ravel(), sums[:, cells].ravel()])

        def best(found: tuple[int, np.ndarray], state=state, level=level) -> tuple:
            t, values = found
            places = state[t][3]
            n = len(places)
            cells = _chosen(seed, t, level, features, subset)[places][:, packing.cell_feature]
            totals, sums = values[: kinds * n].reshape(kinds, n), np.zeros((kinds, *cells.shape))
            sums[:, cells] = values[kinds * n :].reshape(kinds, -1)
            left = _lefts(packing, sums)
            return t, totals, *_best_gini(packing, left, totals, cells, weights, least)

        for t, totals, cells, gains, left in rows.mapPartitions(tallies).reduceByKey(operator.add, min(len(alive), 2 * at_once)).map(best).collect():
            tree = grown[t]
            tree.sums[tree.open + inner] = totals.T
            split = gains > 0
            children = tree.split(packing, level, cells, gains)
            both = np.stack([left[:, split], totals[:, split] - left[:, split]], -1).reshape(kinds, -1)  # left and right of each split in turn
            tree.sums[children + 2 * inner + 1] = both.T
            of = both[:2] * np.array(weights)[:, None] if weights else both[2:]
            mixed = _gini(of)[1] >= _EPSILON
            tree.open = children[mixed & (both[:2].sum(0) >= 2 * least)] if level + 1 < depth else children[:0]
    return grown


def _gini(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight and impurity of two labels' weights."""
    total = of[0] + of[1]
    share = of[1] / np.where(total > 0, total, 1.0)
    return total, np.where(total > 0, 2 * share * (1 - share), 0.0)


def _best_gini(packing: Packing, left: np.ndarray, totals: np.ndarray, cells: np.ndarray, weights: tuple | None, least: int) -> tuple:
    """For each node its best cell to split after, the gain (0 without one), and what lies left."""
    if not left.shape[2]:
        return np.zeros(left.shape[1], int), np.zeros(left.shape[1]), left[:, :, :0].sum(2)
    right = totals[:, :, None] - left
    scale = lambda a: a[:2] * np.array(weights).reshape(2, *[1] * (a.ndim - 1)) if weights else a[2:]
    (wl, il), (wr, ir), (w, i) = _gini(scale(left)), _gini(scale(right)), _gini(scale(totals))
    gain = i[:, None] - (wl * il + wr * ir) / np.where(w > 0, w, 1.0)[:, None]
    fits = cells & ~packing.last & (left[:2].sum(0) >= least) & (right[:2].sum(0) >= least) & (wl > 0) & (wr > 0)
    gain = np.where(fits, gain, 0.0)
    at = gain.argmax(1)
    found = np.arange(len(at))
    return at, gain[found, at], left[:, found, at]


# --- boosting ---------------------------------------------------------------------------------------------
def grow_boosted(data: Packed, spark: SparkSession, rounds: int, depth: int, seed: int, least: int, rate: float, step: float) -> list[Tree]:
    """All rounds in one stage whose tasks keep their rows and margins. In each level the tasks exchange their tallies, add them
    up in the same order and so find the same splits."""
    packing, flat = data.packing, data.label_weights == (1.0, 1.0)

    def work(blocks: Iterable[tuple], gather: Callable) -> list[Tree]:
        which, codes, y, w = _loaded(blocks, packing.width)
        sign, margin, out = 2.0 * y - 1, np.zeros(len(y)), []
        for m in range(rounds):
            target = 4 * sign / (1 + np.exp(2 * sign * margin)) if m else sign
            drawn = [np.random.default_rng([seed, 2, m, *b[:2]]).random(b[2], np.float32) for b in which]
            of = np.flatnonzero(np.concatenate([np.zeros(0), *drawn]) < rate)
            mine, t, v = codes[:, of], target[of], None if flat else w[of]
            parts = [None, t] if flat else [v, v * t, None]
            tree, place = Tree(depth, 4), np.zeros(len(y), int)
            for level in range(depth):
                if n := len(tree.open):
                    slot = np.full(2**level, -1)
                    slot[tree.open] = np.arange(n)
                    slot, codes_of, parts_of = slot[place[of]], mine, parts
                    if (slot < 0).any():
                        kept = np.flatnonzero(slot >= 0)
                        slot, codes_of, parts_of = slot[kept], mine[:, kept], [p if p is None else p[kept] for p in parts]
                    sums = tally(packing, codes_of, slot, n, parts_of)
                    totals = np.stack([np.bincount(slot, p, n) for p in parts_of])
                    whole = sum(gather(np.concatenate([totals.ravel(), sums.ravel()])))
                    totals, sums = whole[: totals.size].reshape(totals.shape), whole[totals.size :].reshape(sums.shape)
                    tree.open = tree.split(packing, level, *_best_variance(packing, _lefts(packing, sums), totals, least))
                place = _down(codes, place, level, tree.byte, tree.mask, tree.bound)
            # Rows of a leaf higher up have gone left below it, so that every node has the sums of the places under it.
            parts = [v, t if flat else v * t, t * t if flat else v * t * t, None]
            sums = sum(gather(np.stack([np.bincount(place[of], p, 2**depth) for p in parts]).ravel())).reshape(4, -1)
            margin += (step if m else 1.0) * np.divide(sums[1], sums[0], out=np.zeros(2**depth), where=sums[0] > 0)[place]
            for level in range(depth, -1, -1):
                tree.sums[2**level - 1 : 2 ** (level + 1) - 1] = sums.T
                sums = sums[:, ::2] + sums[:, 1::2] if level else sums
            out.append(tree)
        return out

    return run_together(spark, data.dealt(min(slots(spark), MOST_TOGETHER, data.blocks)), work)


def _best_variance(packing: Packing, left: np.ndarray, totals: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each node its best cell to split after, and the gain (0 without one). Sums are weight, weighted target and, where weights
    are not all 1, rows."""
    if not left.shape[2]:
        return np.zeros(left.shape[1], int), np.zeros(left.shape[1])
    whole = totals[:, :, None]
    right = whole - left
    fits = ~packing.last & (left[-1 if len(left) > 2 else 0] >= least) & (right[-1 if len(left) > 2 else 0] >= least) & (left[0] > 0) & (right[0] > 0)
    square = lambda a: a[1] * a[1] / np.where(a[0] > 0, a[0], 1.0)
    gain = np.where(fits, (square(left) + square(right) - square(whole)) / np.where(whole[0] > 0, whole[0], 1.0), 0.0)
    at = gain.argmax(1)
    gain = gain[np.arange(len(at)), at]
    return at, np.where(gain > _EPSILON, gain, 0.0)


# --- Spark's models ---------------------------------------------------------------------------------------
def _metadata(spark: SparkSession, kind: str, uid: str, estimator, names: list[str] | None = None, **facts) -> str:
    """What Spark's writer stores of a model, with the learner's settings."""
    known = [p for p in estimator.params if names is None or p.name in names]
    settings = {p.name: estimator.getOrDefault(p) for p in known if estimator.isSet(p)}
    defaults = {p.name: estimator._defaultParamMap[p] for p in known if estimator.hasDefault(p)}
    return json.dumps(
        {
            "class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
            "paramMap": settings, "defaultParamMap": defaults, **facts,
        }
    )


def _model(spark: SparkSession, estimator, data: Packed, grown: list[Tree], tree_kind: str, weights: list[float]):
    """The trees as Spark's own model, written in its stored form and loaded."""
    boosted = isinstance(estimator, GBTClassifier)
    of = GBTClassificationModel if boosted else RandomForestClassificationModel
    path, packing, label_weights = scratch_path(spark, "model"), data.packing, data.label_weights
    tasks = min(len(grown), 2 * slots(spark))
    nodes = spark.sparkContext.parallelize(list(enumerate(grown)), tasks).flatMap(
        lambda tree: [(tree[0], node) for node in tree[1].nodes(packing, boosted, label_weights)]
    )
    spark.createDataFrame(nodes, _STORED, verifySchema=False).write.parquet(f"{path}/data")
    shared = ["impurity", "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "minWeightFractionPerNode", "seed"]
    single = [
        (t, _metadata(spark, tree_kind, f"{estimator.uid}_{t}", estimator, shared, **({} if boosted else {"numFeatures": len(packing.bounds), "numClasses": 2})), w)
        for t, w in enumerate(weights)
    ]
    spark.createDataFrame(single, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    facts = {"numFeatures": len(packing.bounds), "numTrees": len(grown)} | ({} if boosted else {"numClasses": 2})
    whole = _metadata(spark, f"classification.{of.__name__}", estimator.uid, estimator, **facts)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return of.load(path)


def fit_forest(estimator: RandomForestClassifier, data: Packed) -> RandomForestClassificationModel:
    get, spark = estimator.getOrDefault, data.rows.sparkSession
    grown = grow_forest(
        data, spark, get("numTrees"), get("maxDepth"), get("seed"), get("minInstancesPerNode"),
        _subset(get("featureSubsetStrategy"), len(data.packing.bounds)), get("subsamplingRate"), get("bootstrap"),
    )
    return _model(spark, estimator, data, grown, "classification.DecisionTreeClassificationModel", [1.0] * len(grown))


def fit_boosted(estimator: GBTClassifier, data: Packed) -> GBTClassificationModel:
    get, spark = estimator.getOrDefault, data.rows.sparkSession
    grown = grow_boosted(
        data, spark, get("maxIter"), get("maxDepth"), get("seed"), get("minInstancesPerNode"), get("subsamplingRate"), get("stepSize")
    )
    return _model(spark, estimator, data, grown, "regression.DecisionTreeRegressionModel", [1.0, *[get("stepSize")] * (len(grown) - 1)])
