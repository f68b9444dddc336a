"""Quality classifier with hierarchical empirical Bayes over sites (operator 7).

A logistic classifier, fitted on a bounded sample of labelled documents, gives each document's own evidence. Grouped sums of
the evidence give every host, and every path of a host, a posterior that is shrunk towards its parent: paths towards their
host, hosts towards the whole corpus. How strongly is estimated from how much the sites differ beyond chance. A document's
probability is its own log odds, moved by how far its path's posterior (without the document) is from the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.keys import id_keys, packed, row_keys, text_key, unpacked
from ebbtide.llm.labelled import sample
from ebbtide.llm.lines import measure, text_features
from ebbtide.llm.text import blocks
from ebbtide.session import written


def fit(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Logistic weights by Newton steps."""
    weights = np.zeros(features.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (labels - p) - ridge * weights
        curve = (features * (p * (1 - p) + 1e-9)[:, None]).T @ features + ridge * np.eye(len(weights))
        move = np.linalg.solve(curve, slope)
        weights = weights + move
        if np.abs(move).max() < 1e-8:
            break
    return weights


def fit_classifier(docs: DataFrame, labels: DataFrame, *, most_docs: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Weights from up to ``most_docs`` labelled documents; without labels of both kinds every document is good."""
    rows = sample(docs, labels, "quality", most_docs, id_col=id_col, text_col=text_col)
    found = rows.mapInArrow(feature_batches(8 << 20), "label long, features array<double>").orderBy("label", "features").toArrow()
    y = found["label"].to_numpy()
    if not len(y) or y.min() == y.max():
        return np.array([4.0] + [0.0] * 11)
    return fit(np.array(found["features"].to_pylist()), (y == 1).astype(float))


def feature_batches(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", block_bytes):
            rows = text_features(measure(block["text"]))
            yield pa.RecordBatch.from_arrays([block["label"].cast(pa.int64()), pa.array(rows.tolist(), pa.list_(pa.float64()))], ["label", "features"])

    return run


def evidence_batches(weights: np.ndarray, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", block_bytes):
            odds = np.clip(text_features(measure(block["text"])) @ weights, -12, 12)
            yield pa.RecordBatch.from_arrays([*(block[n] for n in ("doc_id", "key", "host", "path")), pa.array(odds)], ["doc_id", "key", "host", "path", "odds"])

    return run


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, parent: str) -> float:
    """Prior weight in documents, by the method of moments: groups' means against their parents' means."""
    chance = F.col(parent) * (1 - F.col(parent))
    found = groups.agg(
        F.sum(F.col("n") * (F.col("s") / F.col("n") - F.col(parent)) ** 2).alias("apart"), F.sum(chance).alias("chance"),
        F.sum(F.col("n") * chance).alias("within"), F.sum("n").alias("n"), F.sum(F.pow("n", F.lit(2))).alias("squares"),
    ).first()
    if not found["n"]:
        return 1.0
    scale = found["n"] - found["squares"] / found["n"]
    between = (found["apart"] - found["chance"]) / scale if scale > 0 else 0.0
    mean_chance = found["within"] / found["n"]
    return float(np.clip(mean_chance / between - 1, 1.0, 1e6)) if between > 0 else 1e6


def site_quality(
    docs: DataFrame, weights: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", host: str | Column = "source",
    path: str | Column = "lang", least: float = 0.5, block_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``evidence`` (own probability), ``site`` (its path's posterior without the
    document), ``probability`` and ``kept`` (``probability >= least``).

    Null hosts and paths are sites of their own, null texts count as empty; rows that repeat an id count as documents each. An
    empty table gives an empty result. Sums over sites are built before the shuffle, so that a site may hold any share of the
    rows; the join with the sites has one row for each site on its other side, which Spark splits or broadcasts by its size.
    """
    judged = _judged(docs, weights, id_col, text_col, host, path, least, block_bytes)
    return judged.select("doc_id", "evidence", "site", "probability", "kept")


def _site_keys(host: str | Column, path: str | Column) -> dict[str, Column]:
    as_column = lambda c: c if isinstance(c, Column) else F.col(c)
    return {n: F.coalesce(as_column(c).cast("string"), F.lit("\0")) for n, c in (("_host", host), ("_path", path))}


def _judged(docs: DataFrame, weights: np.ndarray, id_col: str, text_col: str, host: str | Column, path: str | Column, least: float, block_bytes: int) -> DataFrame:
    site_of = _site_keys(host, path)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("key"), site_of["_host"].alias("host"), site_of["_path"].alias("path"),
        F.col(text_col).alias("text"),
    )
    scored = written(rows.mapInArrow(evidence_batches(weights, block_bytes), "doc_id long, key long, host string, path string, odds double"), "evidence")
    scored = scored.withColumn("evidence", 1 / (1 + F.exp(-F.col("odds"))))
    exact = F.sum(F.col("evidence").cast("decimal(20,12)")).cast("double")
    paths = written(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), exact.alias("s")), "paths")
    overall = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    prior = float(np.clip((overall["s"] or 0) / (overall["n"] or 1), 1e-6, 1 - 1e-6))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    k_host = _strength(hosts.withColumn("parent", F.lit(prior)), "parent")
    sites = paths.join(hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s")), "host")
    k_path = _strength(sites.withColumn("parent", (F.col("host_s") + k_host * prior) / (F.col("host_n") + k_host)), "parent")
    joined = scored.join(sites.withColumnsRenamed({"n": "path_n", "s": "path_s"}), ["host", "path"])
    own = F.col("evidence")
    host_mean = (F.col("host_s") - own + k_host * prior) / (F.col("host_n") - 1 + k_host)
    site = F.least(F.greatest((F.col("path_s") - own + k_path * host_mean) / (F.col("path_n") - 1 + k_path), F.lit(1e-6)), F.lit(1 - 1e-6))
    odds = F.col("odds") + _logit(site) - float(np.log(prior / (1 - prior)))
    found = joined.withColumn("site", site).withColumn("probability", 1 / (1 + F.exp(-odds)))
    return found.select("doc_id", "key", "host", "path", "evidence", "site", "probability", (F.col("probability") >= least).alias("kept"))


def good_documents(
    docs: DataFrame, weights: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", host: str | Column = "source",
    path: str | Column = "lang", least: float = 0.5, block_bytes: int = 4 << 20,
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. A verdict holds for the rows of its id (or without one), text
    and site, which are judged alike, so that neither null nor repeated ids keep a rejected row."""
    keys = {**row_keys(id_col, text_col), **_site_keys(host, path)}
    kept = _judged(docs, weights, id_col, text_col, host, path, least, block_bytes).filter("kept")
    kept = kept.withColumns(id_keys(F.col("doc_id"))).select("_id", "_none", F.col("key").alias("_key"), F.col("host").alias("_host"), F.col("path").alias("_path"))
    return unpacked(packed(docs, keys).join(kept.distinct(), list(keys), "left_semi"))
