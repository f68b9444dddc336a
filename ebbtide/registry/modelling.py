"""Split, preparation, metrics, models, segments and attribution."""

from __future__ import annotations

import functools

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.numeric import rounded
from ebbtide.models import calibrate, explain, search, segment, versions
from ebbtide.models import candidates as models
from ebbtide.models.prepare import FEATURES, feature_names, fit_preparation, prepared, slot_columns
from ebbtide.operators import attribution, metrics, segments, split
from ebbtide.operators.features import FEATURED_NUMERIC
from ebbtide.plans import warehouse
from ebbtide.plans.scoring import find_customers
from ebbtide.registry.base import also, money, query
from ebbtide.registry.drift import _SPLIT
from ebbtide.session import scratch_path, written
from ebbtide.sources.projection import SCORECARD, SCORECARD_INTERCEPT, scorecard_signals
from ebbtide.vocab import CATEGORICAL, NUMERIC

P, Y = "churn_probability", "Churn"


# --- split -------------------------------------------------------------------------------------------
@query("o01_split", _SPLIT + "SELECT customerID, split FROM parts")
def _(x):
    return split.split_by_hash(x.scored).select("customerID", "split")


_EXACT = """, drawn AS (SELECT customerID, Churn, ROW_NUMBER() OVER (PARTITION BY Churn ORDER BY MD5(customerID || '42'), customerID) AS rn,
      COUNT(*) OVER (PARTITION BY Churn) AS n FROM clean),
    exact AS (SELECT customerID, Churn, CASE WHEN rn <= FLOOR(n * 0.15::DOUBLE + 0.5) THEN 'test'
      WHEN rn <= FLOOR(n * 0.15::DOUBLE + 0.5) * 2 THEN 'val' ELSE 'train' END AS split FROM drawn)"""


@query("o01_split_exact", _EXACT + "SELECT customerID, Churn, split FROM exact")
def _(x):
    return split.split_exact(x.clean.select("customerID", "Churn"))


@query("o02_split_summary", _EXACT + f"SELECT split, COUNT(*) AS n, {money('SUM(Churn)::DOUBLE / COUNT(*)', 4)} AS churn_rate FROM exact GROUP BY split")
def _(x):
    return split.split_summary(split.split_exact(x.clean.select("customerID", "Churn")))


_STATS = " UNION ALL ".join(
    f"""SELECT '{c}' AS field, {money('m', 4)} AS median, {money(f'CAST(SUM(CAST(COALESCE({c}, m) AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*)', 4)} AS mean,
      {money(f'STDDEV_POP(COALESCE({c}, m)::DOUBLE)', 4)} AS stddev
      FROM parts, (SELECT QUANTILE_CONT({c}::DOUBLE, 0.5) AS m FROM parts WHERE split = 'train') WHERE split = 'train' GROUP BY m"""
    for c in NUMERIC
)


@query("o03_scaling_statistics", _SPLIT + _STATS)
def _(x):
    stats = split.scaling_statistics(split.split_by_hash(x.scored))
    return stats.select("field", *[rounded(c, 4).alias(c) for c in ("median", "mean", "stddev")])


@query("o20_no_leakage", _SPLIT + "SELECT COUNT(*) - COUNT(DISTINCT customerID) AS shared_ids, CAST(0 AS BIGINT) AS changed_features FROM parts")
def _(x):
    """Ids in more than one split, and rows whose features change when the label is flipped."""
    from ebbtide.operators.features import engineer_features
    from ebbtide.vocab import ENGINEERED

    shared = split.overlapping_ids(split.split_by_hash(x.scored)).agg(F.count("*").alias("shared_ids"))
    flipped = engineer_features(x.clean.withColumn("Churn", 1 - F.col("Churn")))
    changed = x.featured.select("customerID", *ENGINEERED).exceptAll(flipped.select("customerID", *ENGINEERED))
    return shared.select("shared_ids", changed.agg(F.count("*").alias("n")).scalar().alias("changed_features"))


# --- preparation and models (rows-only: trained values) -----------------------------------------------
def parts_of(x):
    return split.split_by_hash(x.featured)


@query("o04_one_hot")
def _(x):
    train = parts_of(x).filter("split = 'train'")
    model = fit_preparation(train)
    vectors = prepared(model, parts_of(x).select("customerID", "split", *NUMERIC, *CATEGORICAL))
    return vectors.select("customerID", "split", F.col(FEATURES).cast("string").alias("vector"))


@query("o05_feature_names")
def _(x):
    train = parts_of(x).filter("split = 'train'")
    names = feature_names(fit_preparation(train, FEATURED_NUMERIC), FEATURED_NUMERIC, CATEGORICAL)
    return x.spark.createDataFrame(list(enumerate(names)), "slot int, feature string").withColumn("train_rows", train.agg(F.count("*")).scalar())


@query("o06_candidates")
def _(x):
    return models.train_and_evaluate(parts_of(x))[0]


@query("o07_balanced_training")
def _(x):
    return models.train_and_evaluate(parts_of(x), balanced=True)[0]


@query("o08_random_search")
def _(x):
    found, _model = search.search_logistic(parts_of(x), n_iter=15)
    row = [(found["model"], found["cv_best_score"], str(found["best_params"]), found["tune_time_s"])]
    return x.spark.createDataFrame(row, "model string, cv_best_score double, best_params string, tune_time_s double")


# --- metrics of the fixed scorecard ----------------------------------------------------------------------
_AT = f"""SELECT 0.5::DOUBLE AS threshold, tp, fp, fn, tn, tp + fp + fn + tn AS n, tp + fn AS positives,
    {money('(tp + tn)::DOUBLE / (tp + fp + fn + tn)', 4)} AS accuracy, {money('COALESCE(tp::DOUBLE / NULLIF(tp + fp, 0), 0.0)', 4)} AS "precision",
    {money('COALESCE(tp::DOUBLE / NULLIF(tp + fn, 0), 0.0)', 4)} AS recall, {money('COALESCE(2.0::DOUBLE * tp / NULLIF(2 * tp + fp + fn, 0), 0.0)', 4)} AS f1,
    log_loss, brier FROM (SELECT COUNT(*) FILTER (churn_probability >= 0.5 AND Churn = 1) AS tp, COUNT(*) FILTER (churn_probability >= 0.5 AND Churn = 0) AS fp,
      COUNT(*) FILTER (churn_probability < 0.5 AND Churn = 1) AS fn, COUNT(*) FILTER (churn_probability < 0.5 AND Churn = 0) AS tn,
      {money('AVG(-LN(CASE WHEN Churn = 1 THEN churn_probability ELSE 1 - churn_probability END))', 4)} AS log_loss,
      {money('AVG((churn_probability - Churn) * (churn_probability - Churn))', 4)} AS brier FROM scored)"""


@query("o09_threshold_metrics", _AT)
def _(x):
    return metrics.threshold_metrics(x.scored, P, Y)


_POINTS = """, cells AS (SELECT churn_probability AS s, SUM(Churn) AS pos, COUNT(*) - SUM(Churn) AS neg FROM scored GROUP BY 1),
    points AS (SELECT *, SUM(pos) OVER (ORDER BY s DESC) AS tp, SUM(neg) OVER (ORDER BY s DESC) AS fp,
               SUM(pos) OVER () AS np, SUM(neg) OVER () AS nn FROM cells)"""
_ROC = """, ranked AS (SELECT Churn, RANK() OVER (ORDER BY churn_probability) + (COUNT(*) OVER (PARTITION BY churn_probability) - 1) / 2.0::DOUBLE AS r FROM scored),
    auc AS (SELECT (SUM(r) FILTER (Churn = 1) - SUM(Churn) * (SUM(Churn) + 1) / 2.0::DOUBLE) / (SUM(Churn) * (COUNT(*) - SUM(Churn))) AS a FROM ranked)"""


@query("o10_roc_auc", _ROC + f"SELECT {money('a', 4)} AS roc_auc FROM auc")
def _(x):
    return metrics.ranking_metrics(x.scored, P, Y).select("roc_auc")


@query("o11_average_precision", _POINTS + f"SELECT {money('SUM(pos::DOUBLE / np * tp / (tp + fp))', 4)} AS pr_auc FROM points")
def _(x):
    """Scores without a stated number of digits: the general running totals."""
    return metrics.ranking_metrics(x.scored, P, Y).select("pr_auc")


@query("o12_log_loss_and_brier", f"SELECT log_loss, brier FROM ({_AT})")
def _(x):
    return metrics.threshold_metrics(x.scored, P, Y).select("log_loss", "brier")


@query(
    "o13_curves",
    _POINTS + f"""SELECT s AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, {money('tp::DOUBLE / np', 6)} AS tpr,
      {money('fp::DOUBLE / nn', 6)} AS fpr, {money('tp::DOUBLE / (tp + fp)', 6)} AS "precision" FROM points""",
)
def _(x):
    return metrics.curves(x.scored, P, Y)


@query(
    "o14_reliability",
    f""", e AS (SELECT QUANTILE_CONT(churn_probability, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM scored)
      SELECT CAST(LEN(LIST_FILTER(e, lambda z: z < churn_probability)) AS INTEGER) AS bin, COUNT(*) AS n,
        {money('CAST(SUM(CAST(churn_probability AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*)', 4)} AS mean_predicted,
        {money('SUM(Churn)::DOUBLE / COUNT(*)', 4)} AS observed_rate FROM scored, e GROUP BY 1""",
)
def _(x):
    return metrics.reliability(x.scored, P, Y)


_VERSIONED = """WITH ranked AS (SELECT Contract, Churn, churn_probability, RANK() OVER (PARTITION BY Contract ORDER BY churn_probability)
        + (COUNT(*) OVER (PARTITION BY Contract, churn_probability) - 1) / 2.0::DOUBLE AS r FROM scored),
      m AS (SELECT Contract, (SUM(r) FILTER (Churn = 1) - SUM(Churn) * (SUM(Churn) + 1) / 2.0::DOUBLE) / NULLIF(SUM(Churn) * (COUNT(*) - SUM(Churn)), 0) AS a,
        AVG((churn_probability - Churn) * (churn_probability - Churn)) AS b FROM ranked GROUP BY Contract)
      SELECT Contract, COALESCE(ROUND(a, 4) >= 0.80 AND ROUND(b, 4) <= 0.20, FALSE) AS gate_passed,
        CASE WHEN ROUND(a, 4) >= 0.80 AND ROUND(b, 4) <= 0.20 THEN 'production' ELSE 'staging' END AS stage FROM m"""


@query("o15_calibration")
def _(x):
    table, chosen = calibrate.calibration_report(calibrate.calibration_variants(parts_of(x)))
    return table.withColumn("selected", F.col("variant") == chosen)


@query(
    "o21_registered_versions",
    f""", v AS ({_VERSIONED}) SELECT 'churn-' || Contract AS model_name, version, gate_passed, stage FROM v, (VALUES (1), (2)) n(version)""",
)
def _(x):
    """A model for each contract, registered twice; the versions as they are read back."""
    table = metrics.classification_metrics(x.scored, P, Y, by=["Contract"])
    root, out = scratch_path(x.spark, "registry"), []
    for r in table.select("Contract", "roc_auc", "brier").collect():  # one row for each model
        for _ in range(2):
            versions.register(x.spark, root, f"churn-{r['Contract']}", r.asDict())
        out.append(versions.versions(x.spark, root, f"churn-{r['Contract']}"))
    return functools.reduce(DataFrame.unionByName, out).select("model_name", "version", "gate_passed", "stage")


_BY_CONTRACT = f"""SELECT Contract AS model, {money('AVG((churn_probability - Churn) * (churn_probability - Churn))', 4)} AS brier,
      {money('AVG(-LN(CASE WHEN Churn = 1 THEN churn_probability ELSE 1 - churn_probability END))', 4)} AS log_loss FROM scored GROUP BY Contract"""


@query("j08_best_by_brier", f"SELECT model AS selected FROM ({_BY_CONTRACT}) ORDER BY brier, log_loss, model LIMIT 1")
def _(x):
    """The selection rule over one metric row per contract."""
    table = metrics.threshold_metrics(x.scored, P, Y, by=["Contract"])
    return metrics.best_by(table, "Contract", ["brier", "log_loss"])


@query("o16_base_against_engineered")
def _(x):
    parts = parts_of(x)
    base, _m = models.train_and_evaluate(parts, ["logistic_regression"], numeric=NUMERIC)
    rich, _m = models.train_and_evaluate(parts, ["logistic_regression"])
    rows = base.withColumn("feature_set", F.lit("base")).unionByName(rich.withColumn("feature_set", F.lit("engineered")))
    return rows.select("feature_set", "roc_auc", "pr_auc", "precision", "recall", "f1", "log_loss", "brier")


@query(
    "o17_promotion_gate",
    _ROC + f""", m AS (SELECT a, (SELECT AVG((churn_probability - Churn) * (churn_probability - Churn)) FROM scored) AS b FROM auc)
      SELECT 'scorecard' AS model_name, {money('a', 4)} AS roc_auc, {money('b', 4)} AS brier_score,
        ROUND(a, 4) >= 0.80 AND ROUND(b, 4) <= 0.20 AS gate_passed,
        CASE WHEN ROUND(a, 4) >= 0.80 AND ROUND(b, 4) <= 0.20 THEN 'production' ELSE 'staging' END AS deployment_stage FROM m""",
)
def _(x):
    measured = metrics.classification_metrics(x.scored, P, Y)
    return calibrate.production_record(measured, "scorecard", "none").select(
        "model_name", "roc_auc", "brier_score", "gate_passed", "deployment_stage"
    )


@query(
    "r05_model_performance",
    _POINTS + _ROC + f"""SELECT 'scorecard' AS model_name, 'none' AS calibration_method,
        CASE WHEN ROUND(a, 4) >= 0.80 AND t.brier <= 0.20 THEN 'production' ELSE 'staging' END AS deployment_stage, {money('a', 4)} AS roc_auc,
        (SELECT {money('SUM(pos::DOUBLE / np * tp / (tp + fp))', 4)} FROM points) AS pr_auc, t.f1 AS f1_score, t.recall AS recall_score,
        t."precision" AS precision_score, t.brier AS brier_score FROM auc, ({_AT}) t""",
)
def _(x):
    """All but the version and the time, which name the run."""
    measured = metrics.classification_metrics(x.scored, P, Y)
    runs = calibrate.production_record(measured, "scorecard", "none")
    house = warehouse.Warehouse(None, None, None, None, None, model_runs=runs)
    return warehouse.model_performance(house).drop("model_version", "trained_at")


@query(
    "o18_run_log",
    f"""SELECT 'compare-' || model AS run, 'metric' AS kind, 'brier' AS key, CAST(brier AS VARCHAR) AS value FROM ({_BY_CONTRACT})
        UNION ALL SELECT 'compare-' || Contract, 'tag', 'phase', 'comparison' FROM scored GROUP BY Contract""",
)
def _(x):
    table = metrics.threshold_metrics(x.scored, P, Y, by=["Contract"])
    root = scratch_path(x.spark, "registry")
    versions.log_runs(table, root, "compare", "Contract", tags={"phase": "comparison"})
    log = versions.logged(x.spark, root).drop("batch")
    return log.filter((F.col("key") == "brier") | (F.col("kind") == "tag"))


@query("o19_batch_scoring")
def _(x):
    parts = parts_of(x)
    fitted = models.fit_candidates(parts, ["logistic_regression"])
    return models.score(fitted.pipelines["logistic_regression"], x.featured).select("customerID", rounded(P, 4).alias(P))


# --- segments -------------------------------------------------------------------------------------------
@query("p02_choose_k")
def _(x):
    return segment.choose_k(segment.segment_vectors(x.scored))


@query("p04_segments")
def _(x):
    rows = segment.fit_segments(segment.segment_vectors(x.scored), 3)
    return segments.segment_table(rows, segments.profile_clusters(rows))


@query("p07_pca")
def _(x):
    return segment.pca_2d(segment.segment_vectors(x.scored)).select("customerID", "pc1", "pc2")


# --- attribution ------------------------------------------------------------------------------------------
def explained(x):
    return attribution.with_contributions(scorecard_signals(x.scored), SCORECARD, SCORECARD_INTERCEPT)


def _signal(c: str) -> str:
    return {"is_fiber": "CAST(InternetService = 'Fiber optic' AS INTEGER)", "monthly_over_70": "(MonthlyCharges - 70)"}.get(c, c)


_PARTS = ", contrib AS (" + " UNION ALL ".join(
    f"""SELECT customerID, '{c}' AS feature, {w}::DOUBLE * ({_signal(c)} - (SELECT CAST(SUM(CAST({_signal(c)} AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*) FROM scored)) AS v FROM scored"""
    for c, w in SCORECARD.items()
) + "), shown AS (SELECT customerID, feature, CAST(ROUND(CAST(v AS DECIMAL(18,6)), 5) AS DOUBLE) AS c, TRIM(REPLACE(REPLACE(feature, '_', ' '), '  ', ' ')) AS factor FROM contrib)"


@query("s01_contributions", _PARTS + "SELECT customerID, feature, c AS contribution FROM shown")
def _(x):
    return attribution.long_contributions(explained(x))


@query("s01_additivity", "SELECT COUNT(*) AS n, COUNT(*) AS n_additive FROM scored")
def _(x):
    """Base plus contributions equals the logit of every row."""
    from ebbtide.sources.projection import scorecard_logit

    rows = explained(x)
    parts = F.aggregate("contributions", F.col("base"), lambda a, e: a + e["contribution"])
    return rows.agg(F.count("*").alias("n"), F.count_if(F.abs(parts - scorecard_logit()) < 1e-9).alias("n_additive"))


def boosted(x):
    """A boosted model of 40 rounds, all customers' vectors, and the feature that each slot belongs to."""
    parts = parts_of(x)
    prep = fit_preparation(parts.filter("split = 'train'"), FEATURED_NUMERIC, CATEGORICAL)
    vectors = written(prepared(prep, parts.select("customerID", "split", *FEATURED_NUMERIC, *CATEGORICAL, Y)).select("customerID", "split", Y, FEATURES), "boosted")
    learner = models.candidates(1)["gradient_boosting"]
    model = learner.copy({learner.maxIter: 40}).fit(models.sized(vectors.filter("split = 'train'")))
    return model, vectors, slot_columns(prep, FEATURED_NUMERIC, CATEGORICAL)


@query("s01_tree_additivity", "SELECT COUNT(*) AS n, COUNT(*) AS n_additive FROM scored")
def _(x):
    """Base plus contributions equals half the log odds of every row of a boosted model."""
    model, vectors, slots = boosted(x)
    rows = explain.with_tree_contributions(model.transform(vectors).withColumn("p", vector_to_array("probability")[1]), model, slots, ["customerID", "p"])
    parts = F.aggregate("contributions", F.col("base"), lambda a, e: a + e["contribution"])
    return rows.agg(F.count("*").alias("n"), F.count_if(F.abs(parts - F.ln(F.col("p") / (1 - F.col("p"))) / 2) < 1e-9).alias("n_additive"))


@query("s02_tree_importance")
def _(x):
    model, vectors, slots = boosted(x)
    return attribution.global_importance(explain.with_tree_contributions(vectors, model, slots, ["customerID"]))


@query("s03_tree_factors")
def _(x):
    model, vectors, slots = boosted(x)
    return attribution.factor_table(attribution.with_top_factors(explain.with_tree_contributions(vectors, model, slots, ["customerID"]), 5))


@query(
    "s02_global_importance",
    _PARTS + f"""SELECT feature, CAST(ROUND(CAST(CAST(SUM(CAST(ABS(v) AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*) AS DECIMAL(18,6)), 5) AS DOUBLE) AS mean_abs_contribution
      FROM contrib GROUP BY feature ORDER BY 2 DESC, 1 LIMIT 20""",
)
def _(x):
    return attribution.global_importance(explained(x))


_FACTORS = """, ordered AS (
    SELECT customerID, factor, c, 'raises' AS direction, ROW_NUMBER() OVER (PARTITION BY customerID ORDER BY c DESC, feature) AS rn FROM shown WHERE c > 0
    UNION ALL SELECT customerID, factor, c, 'lowers', ROW_NUMBER() OVER (PARTITION BY customerID ORDER BY c, feature) FROM shown WHERE c < 0)"""


@query("s03_explained_customers", _PARTS + _FACTORS + "SELECT customerID, direction, factor, c AS contribution FROM ordered WHERE rn <= 5")
def _(x):
    return attribution.factor_table(attribution.with_top_factors(explained(x), 5))


@query("k04_factors_both_ways", _PARTS + _FACTORS + "SELECT direction, factor, COUNT(*) AS n FROM ordered WHERE rn <= 2 GROUP BY ALL")
def _(x):
    table = attribution.factor_table(attribution.with_top_factors(explained(x), 2))
    return table.groupBy("direction", "factor").agg(F.count("*").alias("n"))


@query("j07_strongest_factor", _PARTS + _FACTORS + "SELECT customerID, factor FROM ordered WHERE rn = 1 AND direction = 'raises'")
def _(x):
    top = attribution.with_top_factors(explained(x), 1)
    return top.select("customerID", F.inline("top_positive")).select("customerID", "factor")


@query(
    "s04_top_drivers",
    _PARTS + _FACTORS + """SELECT s.customerID AS customer_id, churn_probability,
        '[' || COALESCE(STRING_AGG('"' || factor || '"', ',' ORDER BY rn), '') || ']' AS top_drivers
      FROM scored s LEFT JOIN (SELECT * FROM ordered WHERE direction = 'raises' AND rn <= 3) o ON o.customerID = s.customerID GROUP BY 1, 2""",
)
def _(x):
    from ebbtide.operators.value import with_value

    drivers = with_value(attribution.with_top_factors(explained(x), 3))
    table = warehouse.predictions_table(drivers, "scorecard-v1", attribution.driver_json())
    return table.select("customer_id", "churn_probability", "top_drivers")


@query(
    "s05_customer_lookup",
    """SELECT customerID, tenure, Contract, churn_probability, risk_level, revenue_at_risk FROM valued
       WHERE customerID IN (SELECT customer_id FROM ev WHERE event_type = 'cancellation_attempt')""",
)
def _(x):
    """Lookup in bulk: every customer who tried to cancel."""
    wanted = x.events.filter("event_type = 'cancellation_attempt'").select(F.col("customer_id").alias("customerID"))
    found = find_customers(x.valued, wanted)
    return found.select("customerID", "tenure", "Contract", "churn_probability", "risk_level", "revenue_at_risk")




also("j06_top_importance", "s02_global_importance")
