"""Churn tables, histograms, dashboard numbers, segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.functions.numeric import rounded
from ebbtide.operators import explore as e
from ebbtide.operators import segments, split
from ebbtide.registry.base import mean, money, query, total
from ebbtide.vocab import CATEGORICAL, SEGMENT_FEATURES

_RATES = f"COUNT(*) AS n_customers, CAST(SUM(Churn) AS BIGINT) AS n_churned, {money('SUM(Churn)::DOUBLE / COUNT(*)', 4)} AS churn_rate"


@query("h01_overall_churn", f"SELECT {_RATES}, CAST(COUNT(*) - SUM(Churn) AS BIGINT) AS n_retained FROM clean")
def _(x):
    return e.overall_churn(x.clean)


@query(
    "h02_churn_by_category",
    " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS value, {_RATES} FROM clean GROUP BY {c}" for c in CATEGORICAL),
)
def _(x):
    return e.churn_by_every_category(x.clean)


@query(
    "h03_churn_by_tenure_band",
    f"""SELECT CASE WHEN tenure <= 12 THEN '0-12' WHEN tenure <= 24 THEN '13-24' WHEN tenure <= 36 THEN '25-36'
          WHEN tenure <= 48 THEN '37-48' WHEN tenure <= 60 THEN '49-60' ELSE '61-72' END AS tenure_band, {_RATES}
        FROM clean WHERE tenure BETWEEN 0 AND 72 GROUP BY 1""",
)
def _(x):
    return e.churn_by_tenure_band(x.clean)


@query(
    "h04_churn_by_charge_band",
    f""", q AS (SELECT QUANTILE_CONT(MonthlyCharges, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM clean),
      b AS (SELECT Churn, e, GREATEST(1, LEN(LIST_FILTER(e, lambda v: v < MonthlyCharges))) AS charge_band FROM clean, q)
      SELECT CAST(charge_band AS INTEGER) AS charge_band, {money('e[charge_band]', 4)} AS lower, {money('e[charge_band + 1]', 4)} AS upper, {_RATES}
      FROM b GROUP BY ALL""",
)
def _(x):
    return e.churn_by_charge_band(x.clean).withColumns({"lower": rounded("lower", 4), "upper": rounded("upper", 4)})


@query(
    "h05_numeric_summary",
    " UNION ALL ".join(
        f"SELECT Churn, '{c}' AS field, {mean(c, 2)} AS mean, {money(f'QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5)')} AS median FROM clean GROUP BY Churn"
        for c in ("tenure", "MonthlyCharges", "TotalCharges")
    ),
)
def _(x):
    return e.numeric_summary_by_churn(x.clean)


_CORR = ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen", "Churn"]


@query(
    "h06_correlations",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, {money(f'CORR({a}, {b})', 3)} AS r FROM clean" for a in _CORR for b in _CORR
    ),
)
def _(x):
    return e.correlations(x.clean)


@query(
    "h07_conditional_sums",
    """SELECT Contract, COUNT(*) FILTER (risk_level IN ('HIGH', 'CRITICAL')) AS at_risk, COUNT(*) FILTER (risk_level = 'CRITICAL') AS critical,
          COUNT(*) FILTER (Churn = 1) AS churned FROM valued GROUP BY Contract""",
)
def _(x):
    return x.valued.groupBy("Contract").agg(
        F.count_if(F.col("risk_level").isin("HIGH", "CRITICAL")).alias("at_risk"),
        F.count_if(F.col("risk_level") == "CRITICAL").alias("critical"),
        F.count_if(F.col("Churn") == 1).alias("churned"),
    )


@query(
    "h08_count_distinct",
    "SELECT event_type, COUNT(DISTINCT customer_id) AS customers, COUNT(*) AS events FROM ev GROUP BY event_type",
)
def _(x):
    return x.events.groupBy("event_type").agg(
        F.count_distinct("customer_id").alias("customers"), F.count("*").alias("events")
    )


@query(
    "h09_guarded_ratio",
    f"""SELECT recommended_action, {money('CAST(SUM(CAST(estimated_net_value AS DECIMAL(18,6))) AS DOUBLE) / NULLIF(CAST(SUM(CAST(estimated_intervention_cost AS DECIMAL(18,6))) AS DOUBLE), 0)', 4)} AS return_on_cost
        FROM decided GROUP BY recommended_action""",
)
def _(x):
    from ebbtide.functions.numeric import exact_sum, rounded_total

    gain, cost = exact_sum("estimated_net_value"), exact_sum("estimated_intervention_cost")
    return x.decided.groupBy("recommended_action").agg(
        rounded_total(F.try_divide(gain, F.nullif(cost, F.lit(0.0))), 4).alias("return_on_cost")
    )


@query(
    "h10_having_and_limit",
    f"""SELECT Contract, PaymentMethod, COUNT(*) AS n, {total('revenue_at_risk')} AS exposure FROM valued
        GROUP BY ALL HAVING COUNT(*) >= 20 ORDER BY exposure DESC, Contract, PaymentMethod LIMIT 20""",
)
def _(x):
    from ebbtide.functions.numeric import exact_sum, rounded_total

    cells = x.valued.groupBy("Contract", "PaymentMethod").agg(
        F.count("*").alias("n"), rounded_total(exact_sum("revenue_at_risk"), 2).alias("exposure")
    )
    return cells.filter("n >= 20").orderBy(F.desc("exposure"), "Contract", "PaymentMethod").limit(20)


@query(
    "h11_dashboard_kpis",
    f"""SELECT COUNT(*) AS total_customers, CAST(SUM(Churn) AS BIGINT) AS churned_customers,
          {money('SUM(Churn)::DOUBLE / COUNT(*)', 4)} AS churn_rate,
          COUNT(*) FILTER (risk_level IN ('HIGH', 'CRITICAL')) AS high_risk_customers,
          {total('revenue_at_risk')} AS total_revenue_at_risk, {mean('churn_probability', 4)} AS average_churn_probability,
          COUNT(*) FILTER (risk_level = 'LOW') AS n_low, COUNT(*) FILTER (risk_level = 'MEDIUM') AS n_medium,
          COUNT(*) FILTER (risk_level = 'HIGH') AS n_high, COUNT(*) FILTER (risk_level = 'CRITICAL') AS n_critical FROM valued""",
)
def _(x):
    return e.dashboard_kpis(x.valued)


def _hist_sql(column: str, bins: int, by: str, source: str) -> str:
    return f""", r AS (SELECT {by}, MIN({column})::DOUBLE AS lo, (MAX({column}) - MIN({column}))::DOUBLE / {bins} AS w, COUNT(*) AS rows FROM {source} GROUP BY {by})
      SELECT s.{by}, CAST(LEAST({bins - 1}, FLOOR(({column} - lo) / w)) AS INTEGER) AS bin, COUNT(*) AS n,
             {money(f'lo + CAST(LEAST({bins - 1}, FLOOR(({column} - lo) / w)) AS INTEGER) * w', 4)} AS bin_start,
             {money('COUNT(*) / (rows * w)', 6)} AS density
      FROM {source} s JOIN r ON r.{by} = s.{by} GROUP BY s.{by}, 2, lo, w, rows"""


@query("h14_histogram_by_outcome", _hist_sql("MonthlyCharges", 30, "Churn", "clean"))
def _(x):
    return e.histogram(x.clean, "MonthlyCharges", 30, "Churn")


@query(
    "h14_probability_histogram",
    _hist_sql("churn_probability", 40, "everyone", "(SELECT *, 'all' AS everyone FROM scored)"),
)
def _(x):
    return e.histogram(x.scored.withColumn("everyone", F.lit("all")), "churn_probability", 40, "everyone")


@query(
    "h15_box_statistics",
    f""", q AS (SELECT Churn, QUANTILE_CONT(MonthlyCharges, [0.25, 0.5, 0.75]) AS q FROM clean GROUP BY Churn),
      t AS (SELECT c.Churn, MonthlyCharges AS v, q, MonthlyCharges BETWEEN q[1] - 1.5::DOUBLE * (q[3] - q[1]) AND q[3] + 1.5::DOUBLE * (q[3] - q[1]) AS inside
            FROM clean c JOIN q ON q.Churn = c.Churn)
      SELECT Churn, {money('q[1]', 4)} AS q1, {money('q[2]', 4)} AS median, {money('q[3]', 4)} AS q3,
             MIN(v) FILTER (inside) AS whisker_low, MAX(v) FILTER (inside) AS whisker_high, COUNT(*) FILTER (NOT inside) AS n_outliers
      FROM t GROUP BY Churn, q""",
)
def _(x):
    return e.box_statistics(x.clean, "MonthlyCharges")


@query("h17_value_range", "SELECT MIN(tenure) AS min_value, MAX(tenure) AS max_value FROM clean")
def _(x):
    return e.value_range(x.clean, "tenure")


# --- segments with given labels -----------------------------------------------------------------------
_CLUSTERED = ", clustered AS (SELECT *, CAST(tenure // 25 AS INTEGER) AS cluster FROM scored)"
_PROFILE = f"""SELECT cluster, COUNT(*) AS size, {money('COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM clustered) * 100', 1)} AS pct,
      {mean('tenure', 1)} AS avg_tenure, {mean('MonthlyCharges', 2)} AS avg_monthly_charges, {mean('TotalCharges', 2)} AS avg_total_charges,
      {mean('service_adoption_score', 3)} AS avg_service_adoption, {mean('churn_probability', 4)} AS avg_churn_probability,
      {mean('Churn', 4)} AS actual_churn_rate,
      CASE WHEN CAST(SUM(CAST(MonthlyCharges AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*) >= (SELECT QUANTILE_CONT(MonthlyCharges, 0.5) FROM clustered) THEN 'High-value' ELSE 'Low-value' END
      || '/' || CASE WHEN CAST(SUM(CAST(churn_probability AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*) >= (SELECT QUANTILE_CONT(churn_probability, 0.5) FROM clustered) THEN 'high-risk' ELSE 'low-risk' END AS label
    FROM clustered GROUP BY cluster"""


def clustered(x):
    return x.scored.withColumn("cluster", F.floor(F.col("tenure") / 25).cast("int"))


@query("h12_cluster_profile", _CLUSTERED + _PROFILE)
def _(x):
    return segments.profile_clusters(clustered(x))


@query("p05_profile_by_contract", _CLUSTERED.replace("CAST(tenure // 25 AS INTEGER)", "contract_risk_indicator * 2 + is_long_term_contract") + _PROFILE)
def _(x):
    by_contract = x.scored.withColumn("cluster", F.col("contract_risk_indicator") * 2 + F.col("is_long_term_contract"))
    return segments.profile_clusters(by_contract)


@query(
    "p06_segment_table",
    _CLUSTERED + f", profile AS ({_PROFILE}) SELECT customerID, cluster, label AS segment_label, churn_probability FROM clustered JOIN profile USING (cluster)",
)
def _(x):
    rows = clustered(x)
    return segments.segment_table(rows, segments.profile_clusters(rows))


@query(
    "h13_by_segment",
    _CLUSTERED + f"""SELECT cluster, COUNT(*) AS n, {money("SUM(CAST(churn_probability * MonthlyCharges AS DECIMAL(18,6)))")} AS exposure,
      {mean('churn_probability', 4)} AS avg_p FROM clustered GROUP BY cluster""",
)
def _(x):
    from ebbtide.functions.numeric import exact_avg, exact_sum, rounded_total

    return clustered(x).groupBy("cluster").agg(
        F.count("*").alias("n"),
        rounded_total(exact_sum(F.col("churn_probability") * F.col("MonthlyCharges")), 2).alias("exposure"),
        rounded_total(exact_avg("churn_probability"), 4).alias("avg_p"),
    )


@query(
    "p01_segmentation_frame",
    "SELECT customerID, "
    + ", ".join(
        f"{money(f'({c} - (SELECT CAST(SUM(CAST({c} AS DECIMAL(18,6))) AS DOUBLE) / COUNT({c}) FROM scored)) / (SELECT STDDEV_POP({c}::DOUBLE) FROM scored)', 4)} AS {c}_z"
        for c in SEGMENT_FEATURES
    )
    + " FROM scored",
)
def _(x):
    z = split.standardised(x.scored, SEGMENT_FEATURES)
    return z.select("customerID", *[rounded(f"{c}_z", 4).alias(f"{c}_z") for c in SEGMENT_FEATURES])


@query(
    "p03_suggest_k",
    """, t AS (SELECT 2 + CAST(tenure // 12 AS INTEGER) AS k, ROUND(CAST(CAST(SUM(CAST(churn_probability AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*) AS DECIMAL(18,6)), 1) AS silhouette FROM scored GROUP BY 1)
      SELECT k FROM t ORDER BY silhouette DESC, k LIMIT 1""",
)
def _(x):
    """The choice rule on a table with ties, derived from the customers' mean risk per year of tenure."""
    from ebbtide.functions.numeric import exact_avg

    table = x.scored.groupBy((F.floor(F.col("tenure") / 12).cast("int") + 2).alias("k")).agg(
        rounded(exact_avg("churn_probability"), 1).alias("silhouette")
    )
    return segments.suggest_k(table)
