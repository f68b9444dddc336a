"""Population stability of features and predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.functions.numeric import rounded
from ebbtide.operators import drift as d
from ebbtide.operators import reference
from ebbtide.plans.monitoring import build_report, train_against_test, with_sides
from ebbtide.registry.base import money, query
from ebbtide.session import written
from ebbtide.vocab import MONITOR_CATEGORICAL, MONITOR_NUMERIC

_SPLIT = """, parts AS (SELECT *, CASE WHEN MD5(customerID || '42')[1:8] < 'b3333333' THEN 'train'
    WHEN MD5(customerID || '42')[1:8] < 'd999999a' THEN 'val' ELSE 'test' END AS split FROM scored)"""
_REAL = _SPLIT + """, sides AS (SELECT *, CASE split WHEN 'train' THEN 'r' WHEN 'test' THEN 'c' END AS side FROM parts WHERE split <> 'val')"""
_YOUNG_OLD = """, sides AS (SELECT *, CASE WHEN tenure < 36 THEN 'r' ELSE 'c' END AS side FROM scored)"""


def _numeric(features) -> str:
    values = " UNION ALL ".join(f"SELECT '{f}' AS feature, side, CAST({f} AS DOUBLE) AS v FROM sides WHERE {f} IS NOT NULL" for f in features)
    return f""", vals AS ({values}),
    edges AS (SELECT feature, LIST_SORT(LIST_DISTINCT(QUANTILE_CONT(v, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e, AVG(v) AS m
              FROM vals WHERE side = 'r' GROUP BY feature),
    cuts AS (SELECT feature, CASE WHEN LEN(e) < 3 THEN [m] ELSE e[2:LEN(e) - 1] END AS cuts FROM edges),
    num_cells AS (SELECT feature, LEN(LIST_FILTER(cuts, lambda z: z <= v)) AS cell, COUNT(*) FILTER (side = 'r') AS r, COUNT(*) FILTER (side = 'c') AS c
              FROM vals JOIN cuts USING (feature) GROUP BY ALL),
    num_psi AS (SELECT feature, SUM((cs - rs) * LN(cs / rs)) AS psi FROM (
              SELECT feature, GREATEST(1e-6, r::DOUBLE / SUM(r) OVER (PARTITION BY feature)) AS rs,
                     GREATEST(1e-6, c::DOUBLE / SUM(c) OVER (PARTITION BY feature)) AS cs FROM num_cells) GROUP BY feature)"""


def _categorical(features) -> str:
    values = " UNION ALL ".join(f"SELECT '{f}' AS feature, side, COALESCE(CAST({f} AS VARCHAR), 'nan') AS v FROM sides" for f in features)
    return f""", cats AS ({values}),
    cat_cells AS (SELECT feature, v, COUNT(*) FILTER (side = 'r') AS r, COUNT(*) FILTER (side = 'c') AS c FROM cats GROUP BY ALL),
    cat_psi AS (SELECT feature, SUM((cs - rs) * LN(cs / rs)) AS psi FROM (
              SELECT feature, GREATEST(1e-6, r::DOUBLE / SUM(r) OVER (PARTITION BY feature)) AS rs,
                     GREATEST(1e-6, c::DOUBLE / SUM(c) OVER (PARTITION BY feature)) AS cs FROM cat_cells) GROUP BY feature)"""


_BAND = "CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'significant' END"
_FEATURES = _numeric(MONITOR_NUMERIC) + _categorical(MONITOR_CATEGORICAL) + f""",
    feature_drift AS (SELECT feature, type, {money('psi', 4)} AS psi, {_BAND} AS band, psi > 0.15 AS drifted
      FROM (SELECT *, 'numeric' AS type FROM num_psi UNION ALL SELECT *, 'categorical' FROM cat_psi))"""


def young_and_old(x):
    return with_sides(x.scored, F.col("tenure") < 36, F.col("tenure") >= 36)


@query("q01_psi_numeric", _YOUNG_OLD + _numeric(MONITOR_NUMERIC) + f"SELECT feature, {money('psi', 4)} AS psi FROM num_psi")
def _(x):
    return d.psi_numeric(young_and_old(x), MONITOR_NUMERIC).withColumn("psi", rounded("psi", 4))


@query(
    "q02_psi_categorical",
    _YOUNG_OLD + _categorical(MONITOR_CATEGORICAL) + f"SELECT feature, {money('psi', 4)} AS psi FROM cat_psi",
)
def _(x):
    return d.psi_categorical(young_and_old(x), MONITOR_CATEGORICAL).withColumn("psi", rounded("psi", 4))


@query("q03_psi_bands", _YOUNG_OLD + _FEATURES + "SELECT band, COUNT(*) AS n FROM feature_drift GROUP BY band")
def _(x):
    return d.feature_drift(young_and_old(x)).groupBy("band").agg(F.count("*").alias("n"))


@query("q04_feature_drift", _REAL + _FEATURES + "SELECT * FROM feature_drift")
def _(x):
    return d.feature_drift(train_against_test(x.scored))


@query("q04_feature_drift_slices", _YOUNG_OLD + _FEATURES + "SELECT * FROM feature_drift")
def _(x):
    return d.feature_drift(young_and_old(x))


@query(
    "q05_prediction_drift",
    _REAL + _numeric(["churn_probability"])
    + f"SELECT {money('psi', 4)} AS psi, {_BAND} AS band, psi > 0.15 AS drifted, 0.15::DOUBLE AS threshold FROM num_psi",
)
def _(x):
    return d.prediction_drift(train_against_test(x.scored))


def _report(sides: str, scenario: str) -> str:
    predicted = _numeric(["churn_probability"]).replace("vals", "pv").replace("edges", "pe").replace("cuts", "pc").replace("num_cells", "pn").replace("num_psi", "p_psi")
    return sides + _FEATURES + predicted + f""",
      s AS (SELECT COUNT(*) AS n_features, COUNT(*) FILTER (drifted) AS n_drifted,
                   {money('COUNT(*) FILTER (drifted)::DOUBLE / COUNT(*)', 3)} AS share_drifted,
                   COALESCE(STRING_AGG(feature, ',' ORDER BY psi DESC, feature) FILTER (drifted), '') AS drifted_features FROM feature_drift)
      SELECT 0.15::DOUBLE AS threshold, s.*, '{scenario}' AS scenario,
             CASE WHEN share_drifted > 0.30 OR p_psi.psi > 0.15 THEN 'RETRAINING_REQUIRED' ELSE 'STABLE' END AS status,
             {money('p_psi.psi', 4)} AS prediction_psi FROM s, p_psi"""


@query("q06_drift_report_slices", _report(_YOUNG_OLD, "new-against-established"))
def _(x):
    return d.drift_report(young_and_old(x), scenario="new-against-established")


@query("q07_train_against_test", _report(_REAL, "real:train-vs-test"))
def _(x):
    return build_report(x.scored)


def sides_of(x):
    """The stored profile of the reference rows, and the current rows."""
    rows = train_against_test(x.scored)
    kept = rows.filter(F.col("side") == d.REFERENCE)
    return written(reference.profile_of(kept, [*MONITOR_NUMERIC, "churn_probability"]), "profile"), rows.filter(F.col("side") == d.CURRENT)


@query("q20_drift_against_profile", _REAL + _FEATURES + "SELECT * FROM feature_drift")
def _(x):
    return reference.drift_against(*sides_of(x)).filter("feature <> 'churn_probability'")


@query("q21_report_against_profile", _report(_REAL, "real:train-vs-test"))
def _(x):
    return reference.report_against(*sides_of(x), scenario="real:train-vs-test")


@query("g14_category_union", _YOUNG_OLD + _categorical(["Contract", "PaymentMethod"]) + "SELECT feature, v AS value, r AS ref, c AS cur FROM cat_cells")
def _(x):
    entries = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in ("Contract", "PaymentMethod")]
    long = young_and_old(x).select("side", F.inline(F.array(*entries)))
    ref = long.filter(F.col("side") == d.REFERENCE).groupBy("feature", "value").agg(F.count("*").alias("ref"))
    cur = long.filter(F.col("side") == d.CURRENT).groupBy("feature", "value").agg(F.count("*").alias("cur"))
    both = ref.join(cur, ["feature", "value"], "full_outer")
    return both.withColumns({"ref": F.coalesce("ref", F.lit(0)), "cur": F.coalesce("cur", F.lit(0))})


@query(
    "g15_value_to_bin",
    """, e AS (SELECT QUANTILE_CONT(MonthlyCharges, [0.0, 0.25, 0.5, 0.75, 1.0]) AS e FROM scored)
       SELECT customerID, CAST(LEN(LIST_FILTER(e[2:4], lambda z: z <= MonthlyCharges)) AS INTEGER) AS bin FROM scored, e""",
)
def _(x):
    """Position of a value among quantile edges: the edges are one array, no range join."""
    from ebbtide.operators.ordered import exact_quantiles

    keyed = x.scored.select(F.lit("m").alias("field"), F.col("MonthlyCharges").alias("v"))
    edges = exact_quantiles(keyed, ["field"], "v", [0.0, 0.25, 0.5, 0.75, 1.0]).select(F.slice("edges", 2, 3)).scalar()
    charge = F.col("MonthlyCharges")
    return x.scored.select("customerID", "MonthlyCharges").withColumn("e", edges).select(
        "customerID", F.size(F.filter("e", lambda z: z <= charge)).alias("bin")
    )
