"""Model versions and logged runs."""

import threading

from pyspark.sql import functions as F

from ebbtide.models import versions
from ebbtide.session import scratch_path

GOOD, BAD = {"roc_auc": 0.85, "brier": 0.1}, {"roc_auc": 0.7, "brier": 0.1}


def test_concurrent_registrations_get_versions_of_their_own(spark):
    root, got = scratch_path(spark, "registry"), []
    threads = [threading.Thread(target=lambda: got.append(versions.register(spark, root, "churn", GOOD))) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    stored = versions.versions(spark, root, "churn").collect()
    assert sorted(r["version"] for r in stored) == sorted(got) and len({r["run_id"] for r in stored}) == 6
    assert all(r["registered_at"] is not None for r in stored)


def test_production_is_the_last_complete_version_that_passed(spark):
    root = scratch_path(spark, "registry")
    assert versions.production(spark, root, "churn").isEmpty() and versions.versions(spark, root, "churn").isEmpty()
    for metrics in (GOOD, GOOD, BAD, {"brier": 0.1}):
        versions.register(spark, root, "churn", metrics, "isotonic")
    half = versions.created(spark, f"{root}/models/churn/00000005", '{"model_name": "churn", "version": 5, "stage": "production"}\n')
    assert half and versions.production(spark, root, "churn").first()["version"] == 2
    assert versions.register(spark, root, "churn", GOOD) == 6 and versions.production(spark, root, "churn").first()["version"] == 6
    stages = {r["version"]: (r["stage"], r["gate_passed"]) for r in versions.versions(spark, root, "churn").collect()}
    assert stages == {1: ("production", True), 2: ("production", True), 3: ("staging", False), 4: ("staging", False), 6: ("production", True)}
    assert versions.versions(spark, root, "another").isEmpty()


def test_runs_of_all_phases_are_rows_of_one_log(spark):
    root = scratch_path(spark, "registry")
    table = spark.createDataFrame([("a", 0.9, 0.1), ("b", 0.8, None)], "model string, roc_auc double, brier double")
    first = versions.log_runs(table, root, "comparison", "model", {"folds": 3})
    versions.log_runs(table, root, "calibration", "model", tags={"method": "isotonic"})
    found = {"model": "logistic_regression", "cv_best_score": 0.9, "tune_time_s": 1.5, "n_iter": 8, "cv_folds": 3, "best_params": {"C": 0.1, "class_weight": None}}
    versions.log_search(spark, root, found)
    log = versions.logged(spark, root)
    rows = {(r["run"], r["kind"], r["key"]): r["value"] for r in log.collect()}
    assert rows["comparison-a", "metric", "roc_auc"] == "0.9" and rows["comparison-b", "metric", "brier"] is None
    assert rows["calibration-b", "tag", "method"] == "isotonic" and rows["tuning-logistic_regression", "param", "C"] == "0.1"
    assert {r["value"] for r in log.filter("key = 'phase'").select("value").collect()} == {"comparison", "calibration", "tuning"}
    assert log.filter(F.col("batch") == first).select("run").distinct().count() == 2
