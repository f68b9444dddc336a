"""Tree attributions against the definition over all feature subsets, and their additivity."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbtide.models import explain

NAMES = ["a", "b", "c", "kind", "kind", "kind"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(400).select(
        "id", (F.pmod(F.col("id") * 37, F.lit(101)) / 101.0).alias("a"), (F.pmod(F.col("id") * 53, F.lit(97)) / 97.0).alias("b"),
        (F.pmod(F.col("id") * 11, F.lit(89)) / 89.0).alias("c"), F.pmod("id", F.lit(3)).cast("double").alias("kind"),
    )
    df = df.withColumn("Churn", ((F.col("a") * F.col("b") + 0.3 * F.col("c") + F.when(F.col("kind") == 1, 0.3).otherwise(0)) > 0.5).cast("double"))
    hot = OneHotEncoder(inputCols=["kind"], outputCols=["hot"], dropLast=False).fit(df).transform(df)
    return VectorAssembler(inputCols=["a", "b", "c", "hot"], outputCol="features").transform(hot).cache()


def models(rows):
    return [
        DecisionTreeClassifier(maxDepth=5, labelCol="Churn").fit(rows), RandomForestClassifier(numTrees=4, maxDepth=4, labelCol="Churn", seed=1).fit(rows),
        GBTClassifier(maxIter=6, maxDepth=3, labelCol="Churn", seed=1).fit(rows),
    ]


def shapley(leaves, row, width):
    """The definition: mean gain of a feature over all orders in which features become known."""

    def value(known):
        total = 0.0
        for leaf in leaves:
            share = leaf.value
            for k, f in enumerate(leaf.features):
                share *= leaf.passed(row[None])[0] >> k & 1 if f in known else leaf.shares[k]
            total += share
        return total

    found = np.zeros(width)
    for i in range(width):
        others = [j for j in range(width) if j != i]
        for size in range(width):
            weight = factorial(size) * factorial(width - size - 1) / factorial(width)
            for known in combinations(others, size):
                found[i] += weight * (value({*known, i}) - value(set(known)))
    return found


def test_contributions_equal_the_mean_over_all_orders(spark, rows):
    data = np.array([r["x"] for r in rows.select(vector_to_array("features").alias("x")).limit(6).collect()])
    for model in models(rows):
        leaves = explain.leaves_of(spark, model)
        assert np.allclose(explain.explain_rows(leaves, data), [shapley(leaves, x, 6) for x in data], atol=1e-12)


def test_leaves_of_many_features_are_worked_out_by_batch(spark, rows, monkeypatch):
    model = DecisionTreeClassifier(maxDepth=6, labelCol="Churn").fit(rows)
    leaves, data = explain.leaves_of(spark, model), np.random.default_rng(2).random((50, 6))
    whole = explain.explain_rows(leaves, data)
    monkeypatch.setattr(explain, "TABLE_BITS", 1)
    assert np.allclose(explain.explain_rows(leaves, data), whole)


def test_base_plus_contributions_is_the_score(rows):
    for model in models(rows):
        found = explain.with_tree_contributions(rows, model, NAMES, ["id"])
        scored = model.transform(rows).select("id", vector_to_array("probability")[1].alias("p"))
        total = F.aggregate("contributions", F.col("base"), lambda a, e: a + e["contribution"])
        score = F.ln(F.col("p") / (1 - F.col("p"))) / 2 if "GBT" in type(model).__name__ else F.col("p")
        assert found.join(scored, "id").filter(F.abs(total - score) > 1e-9).count() == 0 and found.count() == 400
        assert [e["feature"] for e in found.first()["contributions"]] == ["a", "b", "c", "kind"]


def test_a_tree_without_splits_has_no_contributions(spark, rows):
    flat = DecisionTreeClassifier(labelCol="Churn", maxDepth=0).fit(rows)
    found = explain.with_tree_contributions(rows, flat, NAMES, ["id"]).first()
    assert all(e["contribution"] == 0 for e in found["contributions"]) and 0 < found["base"] < 1
