"""Logistic models that are fitted together, against Spark's own estimator."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ebbtide.models import search
from ebbtide.operators.split import split_by_hash


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3)) * [1.0, 4.0, 0.2]
    y = (x @ [1.0, -0.5, 2.0] + rng.logistic(size=300) > 1.0).astype(int)
    out = [(p, i % 2, x[i].tolist(), int(y[i]), 3.0 if y[i] else 0.7) for i in range(300) for p in (0, 1)]
    return spark.createDataFrame(out, "prep int, fold int, x array<double>, y int, balance_weight double").repartition(3).cache()


def test_joint_fits_equal_single_fits(rows):
    models = [search.Logit(k, b, c, np.zeros(4)) for k in (0, 1) for b in (False, True) for c in (0.0005, 0.1)]
    passes = search.fit_together(rows, models)
    assert passes < 20 and all(m.done for m in models)
    for m in models:
        train = rows.filter((F.col("prep") == m.fold) & (F.col("fold") != m.fold)).withColumn("v", array_to_vector("x"))
        fit = LogisticRegression(
            featuresCol="v", labelCol="y", regParam=m.penalty, standardization=False, tol=1e-12, maxIter=500,
            **({"weightCol": "balance_weight"} if m.balanced else {}),
        ).fit(train)
        assert np.allclose(m.weights, [*fit.coefficients, fit.intercept], atol=1e-5), (m.fold, m.balanced, m.penalty)


def test_separable_rows_and_no_rows_end(spark, rows):
    apart = rows.withColumn("y", (F.col("x")[0] > 0).cast("int"))
    models = [search.Logit(0, False, 1e-4, np.zeros(4))]
    assert search.fit_together(apart, models) < 100 and np.isfinite(models[0].weights).all()
    search.fit_together(rows.limit(0), [empty := search.Logit(0, False, 1e-4, np.zeros(4))])
    assert not empty.weights.any()


def test_search_gives_the_scores_of_cross_validation(inputs):
    from ebbtide.models import candidates

    likely = F.col("is_month_to_month") + F.col("payment_risk_indicator") + (F.col("tenure") < 30).cast("int")
    parts = split_by_hash(inputs.featured).withColumn("Churn", (likely >= 2).cast("int")).cache()
    single, _model = candidates.tune(parts, "logistic_regression", n_iter=2)
    found, model = search.search_logistic(parts, n_iter=2)
    assert found["best_params"] == single["best_params"] and abs(found["cv_best_score"] - single["cv_best_score"]) < 0.002
    scored = candidates.score(model, parts)
    assert scored.count() == parts.count() and found["passes"] < 40
