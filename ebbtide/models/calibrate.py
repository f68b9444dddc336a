"""Probability calibration: none, Platt, isotonic; the choice; production record and run log."""

from __future__ import annotations

import datetime
import uuid
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.functions.numeric import added
from ebbtide.models.candidates import candidates, sized, with_folds, with_probability
from ebbtide.models.prepare import FEATURES, LABEL, fit_preparation, prepared
from ebbtide.operators.features import FEATURED_NUMERIC
from ebbtide.operators.metrics import best_by, classification_metrics, passes_gate
from ebbtide.session import written
from ebbtide.vocab import CATEGORICAL, ID

_P = "churn_probability"


def _logit(c: str) -> Column:
    p = F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-9), F.col(c)))
    return F.ln(p / (1 - p))


def calibration_variants(
    parts: DataFrame, base: str = "logistic_regression", folds: int = 5, cfg: Settings = DEFAULTS, parallelism: int = 3
) -> DataFrame:
    """Validation rows scored by each variant: variant, label, probability.

    Per fold the base model is fitted on the other folds and both calibrators on the fold's own
    scores; a variant's probability is the mean over its folds. ``parallelism`` fits run at a time, as one alone waits
    for its small jobs; each holds its rows in storage.
    """
    parts = written(parts.select(ID, "split", *FEATURED_NUMERIC, *CATEGORICAL, LABEL), "parts")
    prep = fit_preparation(parts.filter("split = 'train'"), FEATURED_NUMERIC, CATEGORICAL)
    vectors = written(with_folds(prepared(prep, parts).select(ID, "split", LABEL, FEATURES), folds), "calibration")
    train, val = vectors.filter("split = 'train'"), vectors.filter("split = 'val'")
    estimator = candidates(train.count(), cfg)[base]
    train = sized(train, cfg)

    def scored(model, df: DataFrame, name: str) -> DataFrame:
        return with_probability(model.transform(df), name).drop("rawPrediction", "probability", "prediction")

    assemble = VectorAssembler(inputCols=["_z"], outputCol="_zv")

    def fitted(k: int | None) -> tuple:
        """The model of all train rows, or a fold's model and its calibrators."""
        if k is None:
            return (estimator.fit(train),)
        model = estimator.fit(train.filter(F.col("fold") != k))
        held = written(scored(model, train.filter(F.col("fold") == k), "_p"), "fold")
        held = assemble.transform(held.withColumn("_z", _logit("_p")))
        platt = LogisticRegression(featuresCol="_zv", labelCol=LABEL).fit(held)
        # The fit gathers its points on the driver: a fixed grid of scores, weighted by their rows, bounds them.
        grid = held.groupBy(F.round("_p", 4).alias("_p")).agg(F.avg(LABEL).alias(LABEL), F.count("*").cast("double").alias("_w"))
        return model, platt, IsotonicRegression(featuresCol="_p", labelCol=LABEL, weightCol="_w").fit(grid)

    with ThreadPool(parallelism) as pool:
        (whole,), *by_fold = pool.map(inheritable_thread_target(train.sparkSession)(fitted), [None, *range(folds)], chunksize=1)
    out = scored(whole, val, "uncalibrated")
    for k, (model, platt, isotonic) in enumerate(by_fold):
        out = assemble.transform(scored(model, out, "_p").withColumn("_z", _logit("_p")))
        out = scored(platt, out, f"_platt_{k}")
        out = isotonic.transform(out).withColumnRenamed("prediction", f"_iso_{k}").drop("_p", "_z", "_zv")
    final = out.select(
        ID, LABEL, "uncalibrated",
        (added(F.col(f"_platt_{k}") for k in range(folds)) / folds).alias("platt_sigmoid"),
        (added(F.col(f"_iso_{k}") for k in range(folds)) / folds).alias("isotonic"),
    )
    pairs = F.array(*[F.struct(F.lit(v).alias("variant"), F.col(v).alias(_P)) for v in ("uncalibrated", "platt_sigmoid", "isotonic")])
    return written(final.select(ID, LABEL, F.inline(pairs)), "variants")


def calibration_report(variants: DataFrame) -> tuple[DataFrame, str]:
    """Metrics per variant and the selected one: lowest Brier score, then lowest log loss."""
    metrics = written(classification_metrics(variants, _P, LABEL, by=["variant"]), "calibration-metrics")
    return metrics, best_by(metrics, "variant", ["brier", "log_loss"]).first()["selected"]


# --- records -----------------------------------------------------------------------------------------
def production_record(
    metrics: DataFrame, base: str, method: str, day: datetime.date | None = None, cfg: Settings = DEFAULTS, run_id: str | None = None
) -> DataFrame:
    """The selected model as a model_runs row with its promotion gate; a new run id unless one is given."""
    day, run_id = day or datetime.date.today(), run_id or f"run-{uuid.uuid4().hex}"
    row = metrics.select(
        F.lit(run_id).alias("run_id"), F.lit(base).alias("model_name"),
        F.lit(f"{base}-{method}-{day.isoformat()}").alias("model_version"), F.lit(method).alias("calibration_method"),
        "roc_auc", "pr_auc", F.col("f1").alias("f1_score"), F.col("precision").alias("precision_score"),
        F.col("recall").alias("recall_score"), "log_loss", "brier", F.current_timestamp().alias("trained_at"),
    )
    gated = passes_gate(row, cfg.gate_min_roc_auc, cfg.gate_max_brier)
    return gated.withColumnsRenamed({"brier": "brier_score", "stage": "deployment_stage"})


def next_version(registry: DataFrame, name: str) -> DataFrame:
    """Version number the next registration of a model gets."""
    return registry.filter(F.col("model_name") == name).agg((F.coalesce(F.max("version"), F.lit(0)) + 1).alias("version"))


def run_log(metrics: DataFrame, prefix: str, name: str, params: dict | None = None, tags: dict | None = None) -> DataFrame:
    """Runs in long form: run, kind (metric, param, tag), key, value."""
    def entry(kind: str, key: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"), value.alias("value"))

    measured = [c for c, t in metrics.dtypes if t in ("double", "bigint", "int") and c != name]
    entries = [entry("metric", c, F.col(c).cast("string")) for c in measured]
    for kind, items in (("param", params), ("tag", tags)):
        entries += [entry(kind, k, F.lit(str(v))) for k, v in (items or {}).items()]
    return metrics.select(F.concat(F.lit(f"{prefix}-"), F.col(name)).alias("run"), F.inline(F.array(*entries)))
