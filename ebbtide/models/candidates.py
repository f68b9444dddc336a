"""Candidate models, their training on one split, and random search."""

from __future__ import annotations

import functools
import itertools
import random
import time
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.models.perceptron import Perceptron
from ebbtide.models.prepare import FEATURES, LABEL, fit_preparation, prepared, preparation_stages, with_balance_weight
from ebbtide.models.trees import fit_boosted, fit_forest, packed
from ebbtide.operators.features import FEATURED_NUMERIC
from ebbtide.operators.metrics import classification_metrics
from ebbtide.session import written
from ebbtide.vocab import CATEGORICAL, ID


def candidates(rows: int, cfg: Settings = DEFAULTS, balanced: bool = False) -> dict:
    """Name to unfitted estimator. One distributed boosted-tree learner stands for the three
    single-node boosting libraries."""
    common = {"featuresCol": FEATURES, "labelCol": LABEL}
    weighted = {**common, "weightCol": "balance_weight"} if balanced else common
    return {
        # regParam 1 / rows is the penalty strength C = 1.
        "logistic_regression": LogisticRegression(maxIter=1000, regParam=1.0 / rows, standardization=False, **weighted),
        "decision_tree": DecisionTreeClassifier(maxDepth=5, minInstancesPerNode=20, seed=cfg.seed, **weighted),
        "random_forest": RandomForestClassifier(
            numTrees=300, maxDepth=10, minInstancesPerNode=5, seed=cfg.seed, **weighted
        ),
        "gradient_boosting": GBTClassifier(maxIter=300, maxDepth=4, stepSize=0.1, subsamplingRate=0.9, seed=cfg.seed, **weighted),
        "neural_network": Perceptron(hidden=[64, 32], maxIter=300, seed=cfg.seed, **weighted),
    }


#: Ensembles of hundreds of trees grow from packed rows, which the first of them makes for both.
ENSEMBLES = {"random_forest": fit_forest, "gradient_boosting": fit_boosted}


def sized(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """The rows of a fit in ``fit_tasks`` partitions at most, or as they are stored without that
    setting: seeded bagging follows the partitions, so they never depend on the number of rows."""
    return df.coalesce(cfg.fit_tasks) if cfg.fit_tasks else df


def with_probability(scored: DataFrame, name: str = "churn_probability") -> DataFrame:
    return scored.withColumn(name, vector_to_array("probability")[1])


def score(model: PipelineModel, featured: DataFrame) -> DataFrame:
    """Batch scoring: the rows with the churn probability."""
    return with_probability(model.transform(featured)).select(*featured.columns, "churn_probability")


@dataclass
class Fitted:
    """Fitted candidates by name: whole pipelines, and the models alone with the vectors they read and their seconds."""

    pipelines: dict[str, PipelineModel]
    models: dict[str, Transformer]
    vectors: DataFrame
    seconds: dict[str, float]


def fit_candidates(
    parts: DataFrame, names: list[str] | None = None, numeric: list[str] = FEATURED_NUMERIC,
    categorical: list[str] = CATEGORICAL, balanced: bool = False, cfg: Settings = DEFAULTS,
) -> Fitted:
    """Fit every candidate on the train rows of ``parts`` (with a ``split`` column). The rows are written once and read by
    every stage of the preparation, the feature vectors once and read by every model."""
    parts = written(parts.select(ID, "split", *numeric, *categorical, LABEL), "parts")
    prep = fit_preparation(parts.filter("split = 'train'"), numeric, categorical)
    vectors = written(prepared(prep, parts).select(ID, "split", LABEL, FEATURES), "vectors")
    fit_rows = vectors.filter("split = 'train'")
    rows = fit_rows.count()
    if balanced:
        fit_rows = with_balance_weight(fit_rows)
    fit_rows = sized(fit_rows, cfg)
    fitted, data = Fitted({}, {}, vectors, {}), None
    for name, estimator in candidates(rows, cfg, balanced).items():
        if names and name not in names:
            continue
        begun = time.perf_counter()
        if name in ENSEMBLES:
            data = data or packed(fit_rows, FEATURES, LABEL, "balance_weight" if balanced else None)
            fitted.models[name] = ENSEMBLES[name](estimator, data)
        else:
            fitted.models[name] = estimator.fit(fit_rows)
        fitted.seconds[name] = round(time.perf_counter() - begun, 3)
        fitted.pipelines[name] = PipelineModel([*prep.stages, fitted.models[name]])
    return fitted


def train_and_evaluate(
    parts: DataFrame, names: list[str] | None = None, numeric: list[str] = FEATURED_NUMERIC,
    categorical: list[str] = CATEGORICAL, balanced: bool = False, cfg: Settings = DEFAULTS,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit every candidate on the train rows of one split; metrics on the validation rows.

    Returns (metrics with train_time_s, fitted pipelines). The metrics of all models come from one pass.
    """
    fitted = fit_candidates(parts, names, numeric, categorical, balanced, cfg)
    val = fitted.vectors.filter("split = 'val'")
    scored = [
        with_probability(model.transform(val)).select(F.lit(name).alias("model"), LABEL, "churn_probability") for name, model in fitted.models.items()
    ]
    spent = parts.sparkSession.createDataFrame(list(fitted.seconds.items()), "model string, train_time_s double")
    metrics = classification_metrics(written(functools.reduce(DataFrame.unionByName, scored), "validation"), "churn_probability", LABEL, by=["model"])
    return metrics.join(spent, "model"), fitted.pipelines


# --- random search ----------------------------------------------------------------------------------
# The search spaces.
SPACES = {
    "logistic_regression": {"C": [0.01, 0.1, 1.0, 10.0], "class_weight": [None, "balanced"]},
    "random_forest": {
        "numTrees": [200, 400], "maxDepth": [6, 10, 30], "minInstancesPerNode": [1, 5, 20],
        "class_weight": [None, "balanced"],
    },
    "gradient_boosting": {"maxIter": [200, 400], "maxDepth": [3, 5, 7], "stepSize": [0.03, 0.1], "subsamplingRate": [0.8, 1.0]},
}


def draws(name: str, n: int, seed: int) -> list[dict]:
    """``n`` different points of a search space, reproducible."""
    space = SPACES[name]
    points = [dict(zip(space, p)) for p in itertools.product(*space.values())]
    return random.Random(seed).sample(points, min(n, len(points)))


def with_folds(df: DataFrame, k: int, key: str = ID, seed: int = DEFAULTS.seed) -> DataFrame:
    """Fold number from a hash of the id: no shuffle, label shares as expected values."""
    digits = F.conv(F.substring(F.md5(F.concat(F.col(key), F.lit(f"fold{seed}"))), 1, 7), 16, 10)
    return df.withColumn("fold", (digits.cast("long") % k).cast("int"))


def tune(
    parts: DataFrame, name: str, n_iter: int = 15, folds: int = 3, parallelism: int = 4,
    numeric: list[str] = FEATURED_NUMERIC, categorical: list[str] = CATEGORICAL, cfg: Settings = DEFAULTS,
) -> tuple[dict, PipelineModel]:
    """Random search by cross-validated ROC-AUC on the train rows; preparation is refitted per fold."""
    train = with_balance_weight(parts.filter("split = 'train'").select(ID, *numeric, *categorical, LABEL))
    train = written(with_folds(train.withColumn("even_weight", F.lit(1.0)), folds), "tuning")
    rows = train.count()
    train = sized(train, cfg)
    estimator = candidates(rows, cfg)[name]
    grid = []
    for point in draws(name, n_iter, cfg.seed):
        settings = {estimator.weightCol: "balance_weight" if point.get("class_weight") == "balanced" else "even_weight"}
        if "C" in point:
            settings[estimator.regParam] = 1.0 / (point["C"] * rows)
        for k, v in point.items():
            if k not in ("class_weight", "C"):
                settings[getattr(estimator, k)] = v
        grid.append((point, settings))
    search = CrossValidator(
        estimator=Pipeline(stages=[*preparation_stages(numeric, categorical), estimator]),
        estimatorParamMaps=[s for _, s in grid],
        evaluator=BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC"),
        foldCol="fold", numFolds=folds, parallelism=parallelism, seed=cfg.seed,
    )
    begun = time.perf_counter()
    fitted = search.fit(train)
    best = max(range(len(grid)), key=lambda i: fitted.avgMetrics[i])
    result = {
        "model": name, "cv_folds": folds, "n_iter": len(grid), "cv_best_score": round(float(fitted.avgMetrics[best]), 4),
        "best_params": grid[best][0], "tune_time_s": round(time.perf_counter() - begun, 2),
    }
    return result, fitted.bestModel
