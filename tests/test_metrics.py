import math

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import metrics as m
from ebbtide.operators import split as s


def frame(spark, pairs):
    return spark.createDataFrame([(float(p), int(y)) for p, y in pairs], "p double, y int")


def test_perfect_scores(spark):
    row = m.classification_metrics(frame(spark, [(0.9, 1), (0.8, 1), (0.2, 0), (0.1, 0)]), "p", "y").first()
    assert (row["roc_auc"], row["pr_auc"], row["accuracy"], row["f1"], row["tp"], row["tn"]) == (1.0, 1.0, 1.0, 1.0, 2, 2)


def test_confusion_and_empty_denominators(spark):
    row = m.threshold_metrics(frame(spark, [(0.9, 1), (0.6, 0), (0.4, 1), (0.1, 0)]), "p", "y").first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"], row["precision"], row["recall"]) == (1, 1, 1, 1, 0.5, 0.5)
    none = m.threshold_metrics(frame(spark, [(0.1, 0), (0.2, 0)]), "p", "y").first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)


def test_certain_and_wrong_is_finite(spark):
    row = m.threshold_metrics(frame(spark, [(1.0, 0), (0.0, 1)]), "p", "y").first()
    assert math.isfinite(row["log_loss"]) and row["log_loss"] > 30 and row["brier"] == 1.0


def test_auc_and_average_precision_against_brute_force(spark, inputs):
    rows = [(r["churn_probability"], r["Churn"]) for r in inputs.scored.collect()]
    pos, neg = [p for p, y in rows if y == 1], [p for p, y in rows if y == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0
    for t in sorted({p for p, _ in rows}, reverse=True):
        hits, new = [y for p, y in rows if p >= t], [y for p, y in rows if p == t]
        ap += sum(new) / len(pos) * sum(hits) / len(hits)
    got = m.ranking_metrics(inputs.scored, "churn_probability", "Churn").first()
    assert abs(got["roc_auc"] - auc) < 1e-4 and abs(got["pr_auc"] - ap) < 1e-4
    assert got == m.ranking_metrics(inputs.scored, "churn_probability", "Churn").first()


def test_gate(spark):
    rows = [("ok", 0.84, 0.13), ("low", 0.70, 0.13), ("high", 0.84, 0.30), ("none", None, None)]
    out = {r["name"]: r["stage"] for r in m.passes_gate(spark.createDataFrame(rows, "name string, roc_auc double, brier double"), 0.8, 0.2).collect()}
    assert out == {"ok": "production", "low": "staging", "high": "staging", "none": "staging"}


@pytest.mark.parametrize("rows,expected", [
    ([("a", 0.14, 0.43), ("b", 0.13, 0.50)], "b"), ([("a", 0.13, 0.43), ("b", 0.13, 0.42)], "b"), ([("b", 0.13, 0.4), ("a", 0.13, 0.4)], "a"),
])
def test_selection(spark, rows, expected):
    table = spark.createDataFrame(rows, "variant string, brier double, log_loss double")
    assert m.best_by(table, "variant", ["brier", "log_loss"]).first()["selected"] == expected


def test_exact_split_is_stratified_disjoint_and_stable(inputs):
    one, two = (s.split_exact(inputs.clean.select("customerID", "Churn")) for _ in range(2))
    assert one.exceptAll(two).count() == 0 and s.overlapping_ids(one).count() == 0
    summary = {r["split"]: r for r in s.split_summary(one).collect()}
    assert sum(r["n"] for r in summary.values()) == 150
    rates = [r["churn_rate"] for r in summary.values()]
    assert max(rates) - min(rates) < 0.05 and abs(summary["train"]["n"] - 105) <= 2


def test_hash_split_does_not_depend_on_other_rows(inputs):
    whole = s.split_by_hash(inputs.clean).select("customerID", "split")
    part = s.split_by_hash(inputs.clean.filter("tenure > 30")).select("customerID", "split")
    assert part.exceptAll(whole).count() == 0


def test_scaling_uses_train_rows_only(spark):
    rows = [("train", 1.0), ("train", 3.0), ("train", None), ("test", 1000.0)]
    df = spark.createDataFrame(rows, "split string, x double")
    got = s.scaling_statistics(df, ["x"]).first()
    assert (got["median"], got["mean"]) == (2.0, 2.0) and abs(got["stddev"] - (2 / 3) ** 0.5) < 1e-12


def test_constant_column_standardises_to_zero(spark):
    df = s.standardised(spark.range(3).select(F.lit(4.0).alias("x")), ["x"])
    assert {r["x_z"] for r in df.collect()} == {0.0}
