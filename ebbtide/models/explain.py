"""Exact additive attribution of fitted trees and tree ensembles.

What a tree gives when only some features of a row are known is the mean over its leaves, where splits on unknown features are
passed in the proportions of the training rows. A feature's contribution is its Shapley value in that game. Each leaf is a
game of its own features alone: with ``o`` (the row passes all of the leaf's splits on a feature) and ``z`` (the share of
training rows that do), a set of known features gives the leaf's value times the product of the ``o`` of the known and the ``z``
of the unknown. Which features a row passes is a pattern of few bits, so that a leaf's contributions are a small table which
rows look up; a batch is explained leaf by leaf for all its rows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import JavaMLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import scratch_path

TABLE_BITS = 8  # leaves of more features have no table of all patterns: those of a batch are worked out


@dataclass
class Leaf:
    """A leaf: its weighted value, its features, the splits on each (threshold or categories, and the side), and their shares."""

    value: float
    features: list[int]
    splits: list[list[tuple[float | frozenset, bool]]]
    shares: np.ndarray

    def passed(self, rows: np.ndarray) -> np.ndarray:
        """Each row's pattern: bit ``k`` says whether it passes all splits on the leaf's ``k``-th feature."""
        pattern = np.zeros(len(rows), np.int64)
        for k, (feature, splits) in enumerate(zip(self.features, self.splits, strict=True)):
            x, passes = rows[:, feature], np.ones(len(rows), bool)
            for bound, left in splits:
                passes &= (np.isin(x, list(bound)) if isinstance(bound, frozenset) else x <= bound) == left
            pattern |= passes.astype(np.int64) << k
        return pattern

    def contributions(self, patterns: np.ndarray) -> np.ndarray:
        """Shapley values of the leaf's features for each pattern.

        The sets of known features enter by their sizes only: the coefficients of the product of ``z + o t`` over the others.
        """
        m = len(self.features)
        passes = (patterns[:, None] >> np.arange(m) & 1).astype(float)
        weights = np.array([1 / (m * comb(m - 1, size)) for size in range(m)])
        found = np.zeros((len(patterns), m))
        for k in range(m):
            sizes = np.zeros((len(patterns), m))
            sizes[:, 0] = 1
            for j in (j for j in range(m) if j != k):
                sizes[:, 1:] = sizes[:, 1:] * self.shares[j] + sizes[:, :-1] * passes[:, j : j + 1]
                sizes[:, 0] *= self.shares[j]
            found[:, k] = self.value * (passes[:, k] - self.shares[k]) * (sizes @ weights)
        return found


def _nodes(spark: SparkSession, model: JavaMLWritable) -> list[tuple[float, dict]]:
    """Every tree's weight and nodes by id, as the model's own writer stores them: a row for each node."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    stored = spark.read.parquet(f"{path}/data")
    if "treeID" not in stored.columns:
        return [(1.0, {r["id"]: r for r in stored.collect()})]
    trees: dict[int, dict] = {}
    for r in stored.collect():
        trees.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    weights = list(model.treeWeights) if "GBT" in type(model).__name__ else [1 / len(trees)] * len(trees)
    return [(weights[k], trees[k]) for k in sorted(trees)]


def leaves_of(spark: SparkSession, model: JavaMLWritable) -> list[Leaf]:
    """All leaves of a fitted decision tree, forest or boosted ensemble. Forests and trees give the share of label 1, boosted
    trees half the log odds."""
    boosted = "GBT" in type(model).__name__
    found: list[Leaf] = []

    def walk(weight: float, nodes: dict, node, path: dict) -> None:
        if node["leftChild"] < 0:
            value = node["prediction"] if boosted else node["impurityStats"][1] / max(sum(node["impurityStats"]), 1e-300)
            found.append(Leaf(weight * value, list(path), [s for s, _ in path.values()], np.array([z for _, z in path.values()])))
            return
        split = node["split"]
        bound = split["leftCategoriesOrThreshold"][0] if split["numCategories"] < 0 else frozenset(split["leftCategoriesOrThreshold"])
        for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
            splits, share = path.get(split["featureIndex"], ([], 1.0))
            step = ([*splits, (bound, left)], share * nodes[child]["rawCount"] / node["rawCount"])
            walk(weight, nodes, nodes[child], {**path, split["featureIndex"]: step})

    for weight, nodes in _nodes(spark, model):
        walk(weight, nodes, nodes[0], {})
    return found


def base_of(leaves: list[Leaf]) -> float:
    """What the model gives when nothing is known."""
    return float(sum(leaf.value * np.prod(leaf.shares) for leaf in leaves))


def explain_rows(leaves: list[Leaf], rows: np.ndarray, tables: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """Contributions of all features (columns) to each row's score."""
    found = np.zeros_like(rows)
    for n, leaf in enumerate(leaves):
        if not leaf.features:
            continue
        pattern = leaf.passed(rows)
        if len(leaf.features) <= TABLE_BITS:
            known = None if tables is None else tables.get(n)
            if known is None:
                known = leaf.contributions(np.arange(1 << len(leaf.features)))
                if tables is not None:
                    tables[n] = known
        else:
            seen, pattern = np.unique(pattern, return_inverse=True)
            known = leaf.contributions(seen)
        found[:, leaf.features] += known[pattern]
    return found


def explain_batches(leaves: list[Leaf], width: int, names: list[str], keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = batch["_slots"].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            slots = explain_rows(leaves, rows, tables)
            whole = np.stack([slots[:, [k for k, n in enumerate(names) if n == name]].sum(1) for name in dict.fromkeys(names)], 1)
            kinds = list(dict.fromkeys(names))
            entries = pa.StructArray.from_arrays(
                [pa.array(kinds * len(rows), pa.string()), pa.array(whole.ravel(), pa.float64())], ["feature", "contribution"]
            )
            offsets = pa.array(np.arange(len(rows) + 1) * len(kinds), pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in keys), pa.ListArray.from_arrays(offsets, entries)], [*keys, "contributions"])

    return run


def with_tree_contributions(df: DataFrame, model: JavaMLWritable, names: list[str], keys: list[str], features: str = "features") -> DataFrame:
    """``keys`` of ``df`` with ``base`` and ``contributions``, one entry for each distinct name, like the linear attribution.

    ``names`` has the feature that each slot of the vector belongs to; slots of one name are added up. Base plus the
    contributions is the model's score of the row. The model's leaves are shipped to the tasks; rows are not shuffled.
    """
    leaves = leaves_of(df.sparkSession, model)
    slots = df.select(*keys, vector_to_array(features).alias("_slots"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
    schema = f"{kinds}, contributions array<struct<feature: string, contribution: double>>"
    found = slots.mapInArrow(explain_batches(leaves, len(names), names, keys), schema)
    return found.withColumn("base", F.lit(base_of(leaves)))
