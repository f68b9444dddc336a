"""A registry of model versions and a log of runs, as files that are each created once.

A version is a file of its number below the model's folder: of two registrations at the same time one gets the number and the
other takes the next. A file counts once its last line says that it is complete, so a reader never sees half a version.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.models.calibrate import run_log
from ebbtide.sources.commits import created, jvm_path

_END = '{"complete": true}'
_VERSION = (
    "model_name string, version int, run_id string, stage string, roc_auc double, brier double, gate_passed boolean, "
    "calibration_method string, model_path string, registered_at timestamp"
)


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    place, system = jvm_path(spark, folder)
    if not system.exists(place):
        return []
    return sorted(int(x.getPath().getName()) for x in system.listStatus(place) if x.getPath().getName().isdigit())


def versions(spark: SparkSession, root: str, model_name: str) -> DataFrame:
    """All complete versions of a model."""
    folder = f"{root}/models/{model_name}"
    names = [f"{folder}/{n:08d}" for n in _numbers(spark, folder)]
    if not names:
        return spark.createDataFrame([], _VERSION)
    texts = spark.read.text(names, wholetext=True).filter(F.col("value").endswith(_END))
    return texts.select(F.from_json(F.substring_index("value", "\n", 1), _VERSION).alias("v")).select("v.*")


def register(
    spark: SparkSession, root: str, model_name: str, metrics: dict, calibration_method: str = "none", model_path: str | None = None,
    run_id: str | None = None, cfg: Settings = DEFAULTS,
) -> int:
    """Store a version with its promotion gate and return its number. ``metrics`` holds roc_auc and brier; a missing one fails
    the gate."""
    auc, brier = metrics.get("roc_auc"), metrics.get("brier")
    passed = auc is not None and brier is not None and auc >= cfg.gate_min_roc_auc and brier <= cfg.gate_max_brier
    row = {
        "model_name": model_name, "run_id": run_id or f"run-{uuid.uuid4().hex}", "stage": "production" if passed else "staging",
        "roc_auc": auc, "brier": brier, "gate_passed": passed, "calibration_method": calibration_method, "model_path": model_path,
        "registered_at": datetime.now(timezone.utc).isoformat(),
    }
    folder = f"{root}/models/{model_name}"
    number = max(_numbers(spark, folder), default=0) + 1
    while not created(spark, f"{folder}/{number:08d}", json.dumps({**row, "version": number}) + "\n" + _END):
        number += 1
    return number


def production(spark: SparkSession, root: str, model_name: str) -> DataFrame:
    """The last complete version that passed its gate; no row without one."""
    passed = versions(spark, root, model_name).filter("stage = 'production'")
    return passed.groupBy("model_name").agg(F.max_by(F.struct(*passed.columns), "version").alias("v")).select("v.*")


# --- runs ---------------------------------------------------------------------------------------------
def log_runs(metrics: DataFrame, root: str, phase: str, name: str, params: dict | None = None, tags: dict | None = None) -> str:
    """Append the runs of a phase (comparison, tuning, calibration, gate): one run for each row of ``metrics``. Returns the id
    of the batch of runs, the name of its folder, which no other batch shares."""
    batch = f"{phase}-{uuid.uuid4().hex}"
    rows = run_log(metrics, phase, name, params, {"phase": phase, **(tags or {})})
    rows.write.parquet(f"{root}/runs/batch={batch}")
    return batch


def logged(spark: SparkSession, root: str) -> DataFrame:
    """All logged runs: batch, run, kind, key, value."""
    return spark.read.schema("run string, kind string, key string, value string, batch string").parquet(f"{root}/runs")


def log_search(spark: SparkSession, root: str, found: dict) -> str:
    """A finished search as a run: its best score and time as metrics, the winner's settings as params."""
    row = spark.createDataFrame(
        [(found["model"], float(found["cv_best_score"]), float(found["tune_time_s"]), found["n_iter"], found["cv_folds"])],
        "model string, cv_best_score double, tune_time_s double, n_iter int, cv_folds int",
    )
    return log_runs(row, root, "tuning", "model", found["best_params"])
