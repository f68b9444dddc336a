"""Random search over logistic regressions: all points and folds are fitted together, in the same passes over the rows.

Every pass takes a Newton step of each model that has not converged: tasks sum the gradients and curvatures of all of them over
their rows, one row for each model leaves a task. A search of m models costs as many jobs as its slowest model has steps,
not m times as many.
"""

from __future__ import annotations

import functools
import math
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.models.candidates import candidates, draws, with_folds
from ebbtide.models.prepare import FEATURES, LABEL, fit_preparation, prepared, preparation_stages, with_balance_weight
from ebbtide.operators.features import FEATURED_NUMERIC
from ebbtide.operators.metrics import ranking_metrics
from ebbtide.session import ship_package, written
from ebbtide.vocab import CATEGORICAL, ID

_STEPS, _ENOUGH = 100, 1e-8


@dataclass
class Logit:
    """A model to fit: rows whose fold is not ``fold``, weighted alike or by label, with an L2 penalty on the slopes. The
    objective is the mean weighted loss plus ``penalty / 2 * |slopes|^2``, as Spark's own estimator has it."""

    fold: int
    balanced: bool
    penalty: float
    weights: np.ndarray
    loss: float = math.inf
    step: np.ndarray | None = None
    done: bool = False


def _design(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    x = np.array(pdf["x"].tolist(), float).reshape(len(pdf), -1)
    return np.hstack([x, np.ones((len(x), 1))]), pdf["y"].to_numpy(float)


def sums_of(x: np.ndarray, y: np.ndarray, w: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Loss, weight, gradient and upper curvature of one model over these rows, in one vector that adds up."""
    z = x @ beta
    p = 0.5 * (1 + np.tanh(z / 2))
    loss = (w * (np.logaddexp(0.0, z) - y * z)).sum()
    curvature = (x * (w * p * (1 - p))[:, None]).T @ x
    return np.concatenate([[loss, w.sum()], x.T @ (w * (p - y)), curvature[np.triu_indices(len(beta))]])


def _pass_over(rows: DataFrame, models: list[Logit]) -> dict[int, np.ndarray]:
    """Sums of the open models over all rows: one job, one row of sums for each model."""
    open_models = [(k, m.fold, m.balanced, m.weights) for k, m in enumerate(models) if not m.done]

    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {}
        for pdf in batches:
            for (own, fold), part in pdf.groupby(["prep", "fold"]):  # a row is prepared once for each fold left out
                x, y = _design(part)
                for k, left_out, balanced, beta in open_models:
                    if left_out == own and fold != left_out:
                        w = part["balance_weight"].to_numpy(float) if balanced else np.ones(len(y))
                        total[k] = total.get(k, 0.0) + sums_of(x, y, w, beta)
        if total:
            yield pd.DataFrame({"model": list(total), "sums": [v.tolist() for v in total.values()]})

    parts = rows.mapInPandas(per_task, "model int, sums array<double>")
    summed = parts.select("model", F.posexplode("sums").alias("slot", "value")).groupBy("model", "slot").agg(F.sum("value").alias("value"))
    gathered = summed.groupBy("model").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "value"))), lambda e: e["value"]).alias("sums"))
    return {r["model"]: np.array(r["sums"]) for r in gathered.collect()}


def _advance(model: Logit, sums: np.ndarray) -> None:
    """Keep the last step if it helped, else take half of it; then the next Newton step."""
    n = len(model.weights)
    slopes = np.append(np.ones(n - 1), 0.0)
    total = max(sums[1], 1e-300)
    loss = sums[0] / total + model.penalty / 2 * (slopes * model.weights**2).sum()
    if model.step is not None and not loss <= model.loss + 1e-12:
        model.step = model.step / 2
        model.weights = model.weights - model.step  # back by half
        model.done = np.abs(model.step).max() < _ENOUGH
        return
    gradient = sums[2:2 + n] / total + model.penalty * slopes * model.weights
    curvature = np.zeros((n, n))
    curvature[np.triu_indices(n)] = sums[2 + n:] / total
    curvature = curvature + np.triu(curvature, 1).T + np.diag(model.penalty * slopes + 1e-10)
    model.loss = loss
    model.step = -np.linalg.lstsq(curvature, gradient, rcond=None)[0]
    model.done = bool(np.abs(model.step).max() < _ENOUGH)
    model.weights = model.weights + model.step


def fit_together(rows: DataFrame, models: list[Logit]) -> int:
    """Fit all models; returns the number of passes. ``rows`` has prep, fold, x, y, balance_weight."""
    for k in range(_STEPS):
        if all(m.done for m in models):
            return k
        found = _pass_over(rows, models)
        for i, model in enumerate(models):
            if i in found:
                _advance(model, found[i])
            elif not model.done:
                model.done = True  # no rows to learn from
    return _STEPS


def _scored(rows: DataFrame, models: list[Logit]) -> DataFrame:
    """Every held-out row scored by each of its fold's models: model, y, score."""
    kept = [(k, m.fold, m.weights) for k, m in enumerate(models)]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for fold, part in pdf[pdf["prep"] == pdf["fold"]].groupby("fold"):
                x, y = _design(part)
                for k, left_out, beta in kept:
                    if left_out == fold:
                        yield pd.DataFrame({"model": k, "y": y.astype(int), "score": x @ beta})

    return rows.mapInPandas(score, "model int, y int, score double")


def search_logistic(
    parts: DataFrame, n_iter: int = 15, folds: int = 3, numeric: list[str] = FEATURED_NUMERIC, categorical: list[str] = CATEGORICAL,
    cfg: Settings = DEFAULTS,
) -> tuple[dict, PipelineModel]:
    """Random search by cross-validated ROC-AUC on the train rows, like ``candidates.tune`` but with joint passes. Preparation is
    fitted for each fold without its held-out rows. A fold whose held-out rows have one label counts as 0.5.

    The vectors are written once for each fold. The driver holds one vector of sums for each model, of the square of the
    features' number. The winner is fitted again on all train rows by Spark's estimator, as a whole pipeline.
    """
    begun = time.perf_counter()
    spark = parts.sparkSession
    ship_package(spark)
    train = with_balance_weight(parts.filter("split = 'train'").select(ID, *numeric, *categorical, LABEL))
    train = written(with_folds(train, folds), "search")
    n = train.count()
    sides = []
    for k in range(folds):
        prep = fit_preparation(train.filter(F.col("fold") != k), numeric, categorical)
        sides.append(
            prepared(prep, train).select(
                F.lit(k).alias("prep"), "fold", vector_to_array(FEATURES).alias("x"), F.col(LABEL).cast("int").alias("y"), "balance_weight"
            )
        )
    rows = written(functools.reduce(DataFrame.unionByName, sides), "search-vectors")
    widths = {r["prep"]: r["width"] for r in rows.groupBy("prep").agg(F.max(F.size("x")).alias("width")).collect()}
    points = draws("logistic_regression", n_iter, cfg.seed)
    models = [
        Logit(k, p["class_weight"] == "balanced", 1.0 / (p["C"] * n), np.zeros(widths.get(k, 0) + 1)) for p in points for k in range(folds)
    ]
    passes = fit_together(rows, models)
    measured = ranking_metrics(written(_scored(rows, models), "search-scores"), "score", "y", by=["model"])
    auc = {r["model"]: r["roc_auc"] for r in measured.collect()}  # one row for each model
    means = [float(np.mean([auc.get(i * folds + k) or 0.5 for k in range(folds)])) for i in range(len(points))]
    best = max(range(len(points)), key=means.__getitem__)
    point = points[best]
    estimator = candidates(n, cfg, balanced=point["class_weight"] == "balanced")["logistic_regression"]
    estimator = estimator.copy({estimator.regParam: 1.0 / (point["C"] * n)})
    fitted = Pipeline(stages=[*preparation_stages(numeric, categorical), estimator]).fit(train)
    result = {
        "model": "logistic_regression", "cv_folds": folds, "n_iter": len(points), "cv_best_score": round(means[best], 4), "best_params": point,
        "tune_time_s": round(time.perf_counter() - begun, 2), "passes": passes, "scores": means,
    }
    return result, fitted
