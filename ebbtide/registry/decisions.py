"""Risk bands, value, priority, decisions, their reports, top-k lists and set comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.functions.numeric import rounded
from ebbtide.functions.risk import (
    adjusted_probability, event_delta, lifetime_value, register_sql_functions, risk_level, risk_ordinal, value_at_risk,
)
from ebbtide.operators import value as v
from ebbtide.operators.skew import spread_join
from ebbtide.plans.scoring import score_adhoc
from ebbtide.registry.base import mean, money, query, total


@query("f01_risk_level", "SELECT customerID, churn_probability, risk_level FROM valued")
def _(x):
    return x.scored.select("customerID", "churn_probability", risk_level("churn_probability").alias("risk_level"))


@query(
    "f02_value_formulas",
    f"""SELECT customerID, {money('MonthlyCharges * 24 * 0.30::DOUBLE', 6)} AS clv,
          {money('churn_probability * (MonthlyCharges * 24 * 0.30::DOUBLE)', 6)} AS at_risk FROM scored""",
)
def _(x):
    clv = lifetime_value("MonthlyCharges")
    return x.scored.select(
        "customerID", rounded(clv, 6).alias("clv"), rounded(value_at_risk("churn_probability", clv), 6).alias("at_risk")
    )


@query(
    "f03_value_table",
    "SELECT customerID, estimated_clv, revenue_at_risk, risk_level, priority_score FROM valued",
)
def _(x):
    return x.valued.select("customerID", "estimated_clv", "revenue_at_risk", "risk_level", "priority_score")


@query(
    "f04_priority_rank",
    """SELECT customerID, priority_score, rn AS priority_rank,
          rn <= GREATEST(1, CAST(FLOOR((SELECT COUNT(*) FROM valued) * 0.10::DOUBLE) AS BIGINT)) AS priority_flag
        FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY priority_score DESC, customerID) AS rn FROM valued)""",
)
def _(x):
    return v.with_priority(x.valued.select("customerID", "priority_score"))


_TOPS = """, tops AS (
    SELECT customerID, ROW_NUMBER() OVER (ORDER BY churn_probability DESC, customerID) AS by_p,
           ROW_NUMBER() OVER (ORDER BY revenue_at_risk DESC, customerID) AS by_v,
           GREATEST(1, CAST(FLOOR(COUNT(*) OVER () * 0.10::DOUBLE) AS BIGINT)) AS top_n FROM valued)"""


@query(
    "f05_prioritization_shift",
    _TOPS
    + f"""SELECT 0.10::DOUBLE AS top_percent, MAX(top_n) AS top_n, COUNT(*) FILTER (by_p <= top_n AND by_v <= top_n) AS overlap,
          {money('COUNT(*) FILTER (by_p <= top_n AND by_v <= top_n) * 100.0::DOUBLE / MAX(top_n)', 1)} AS overlap_pct,
          COUNT(*) FILTER (by_v <= top_n AND by_p > top_n) AS swapped_in_by_value,
          {money('COUNT(*) FILTER (by_v <= top_n AND by_p > top_n) * 100.0::DOUBLE / MAX(top_n)', 1)} AS swapped_pct FROM tops""",
)
def _(x):
    return v.prioritization_shift(x.valued)


_SEGMENTED = """, seg AS (SELECT *, CASE WHEN Contract = 'Two year' THEN 'High-value/low-risk'
      WHEN PaperlessBilling = 'Yes' THEN 'Low-value/high-risk' END AS segment_label FROM valued)"""


def segmented(x):
    label = F.when(F.col("Contract") == "Two year", "High-value/low-risk").when(
        F.col("PaperlessBilling") == "Yes", "Low-value/high-risk"
    )
    return x.valued.withColumn("segment_label", label)


@query(
    "f06_high_value",
    _SEGMENTED
    + """SELECT customerID, COALESCE(segment_label LIKE 'High-value%', FALSE) OR estimated_clv >= 500 AS high_value FROM seg""",
)
def _(x):
    df = segmented(x)
    return df.select("customerID", v.is_high_value(df).alias("high_value"))


@query("f07_recommended_action", "SELECT customer_id, recommended_action, reason FROM decided")
def _(x):
    return x.decided.select("customer_id", "recommended_action", "reason")


@query("f08_decision_economics", """SELECT customer_id, urgency, estimated_intervention_cost,
          estimated_expected_retained_value, estimated_net_value FROM decided""")
def _(x):
    return x.decided.select(
        "customer_id", "urgency", "estimated_intervention_cost", "estimated_expected_retained_value", "estimated_net_value"
    )


@query("f09_decisions", "SELECT * FROM decided")
def _(x):
    return x.decided


@query(
    "f10_value_summary",
    f"""SELECT COUNT(*) AS n_customers, {total('estimated_clv')} AS total_estimated_clv,
          {total('revenue_at_risk')} AS total_estimated_revenue_at_risk FROM valued""",
)
def _(x):
    return v.value_summary(x.valued)


@query(
    "f10_value_by_segment",
    _SEGMENTED
    + f"""SELECT segment_label, COUNT(*) AS customers, {total('revenue_at_risk')} AS total_revenue_at_risk,
          {mean('churn_probability', 2)} AS avg_churn_prob FROM seg GROUP BY segment_label""",
)
def _(x):
    return v.value_by_segment(segmented(x))


@query(
    "f11_retention_summary",
    f"""SELECT COUNT(*) AS n_customers, COUNT(*) FILTER (recommended_action <> 'no_intervention') AS n_actionable,
          {total('estimated_intervention_cost')} AS estimated_total_intervention_cost,
          {total('estimated_expected_retained_value')} AS estimated_total_expected_retained_value,
          {money('SUM(CAST(estimated_expected_retained_value AS DECIMAL(18,6))) - SUM(CAST(estimated_intervention_cost AS DECIMAL(18,6)))')} AS estimated_net_value
        FROM decided""",
)
def _(x):
    return v.retention_summary(x.decided)


@query(
    "f12_top5_by_value",
    """SELECT customerID, churn_probability, estimated_clv, revenue_at_risk, risk_level FROM valued
       ORDER BY revenue_at_risk DESC, customerID LIMIT 5""",
)
def _(x):
    slim = x.valued.select("customerID", "churn_probability", "estimated_clv", "revenue_at_risk", "risk_level")
    return v.top_by_value(slim, 5)


@query(
    "f13_adhoc_scoring",
    """, partial AS (SELECT customerID, tenure, MonthlyCharges, TotalCharges, Contract,
             CASE WHEN SeniorCitizen = 1 THEN NULL ELSE TechSupport END AS TechSupport FROM raw),
      q AS (SELECT customerID, CAST(ROUND(CAST(1 / (1 + EXP(-(-0.4::DOUBLE - 0.04::DOUBLE * tenure
          + 1.3::DOUBLE * CAST(Contract = 'Month-to-month' AS INTEGER) + 0.7::DOUBLE + 0.8::DOUBLE
          - 0.4::DOUBLE * CAST(COALESCE(TechSupport, 'No') = 'Yes' AS INTEGER) - 0.4::DOUBLE * 0
          + 0.01::DOUBLE * (MonthlyCharges - 70)))) AS DECIMAL(18,6)), 4) AS DOUBLE) AS p,
          CAST(ROUND(CAST(MonthlyCharges * 24 * 0.30::DOUBLE AS DECIMAL(18,6)), 2) AS DOUBLE) AS clv FROM partial)
      SELECT customerID AS customer_id, p AS churn_probability, clv AS estimated_clv,
          CASE WHEN p < 0.5 THEN 'LOW' WHEN p < 0.7 THEN 'MEDIUM' WHEN p < 0.85 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level,
          CASE WHEN p < 0.5 THEN 'no_intervention' WHEN p >= 0.85 AND clv >= 500 THEN 'account_manager_contact'
               ELSE 'payment_assistance' END AS recommended_action FROM q""",
)
def _(x):
    """Customers known by a few fields only; everything missing takes the documented default."""
    partial = x.raw.select(
        "customerID", "tenure", "MonthlyCharges", "TotalCharges", "Contract",
        F.when(F.col("SeniorCitizen") == 1, F.lit(None)).otherwise(F.col("TechSupport")).alias("TechSupport"),
    )
    return score_adhoc(partial).select(
        "customer_id", "churn_probability", "estimated_clv", "risk_level", "recommended_action"
    )


# --- joins on the decision side ---------------------------------------------------------------------
@query(
    "g02_value_with_segments",
    _SEGMENTED + "SELECT v.customerID, v.revenue_at_risk, s.segment_label FROM valued v LEFT JOIN seg s ON s.customerID = v.customerID AND s.segment_label IS NOT NULL",
)
def _(x):
    labels = segmented(x).filter("segment_label is not null").select("customerID", "segment_label")
    return x.valued.select("customerID", "revenue_at_risk").join(labels, "customerID", "left")


@query(
    "g03_value_with_decisions",
    """SELECT v.customerID AS customer_id, v.tenure, v.Contract AS contract, d.recommended_action, d.urgency
       FROM valued v LEFT JOIN (SELECT * FROM decided WHERE recommended_action <> 'no_intervention') d ON d.customer_id = v.customerID""",
)
def _(x):
    acted = x.decided.filter("recommended_action <> 'no_intervention'").select("customer_id", "recommended_action", "urgency")
    who = x.valued.select(F.col("customerID").alias("customer_id"), "tenure", F.col("Contract").alias("contract"))
    return who.join(acted, "customer_id", "left")


# --- counts, ranges, filters ---------------------------------------------------------------------------
@query(
    "h16_value_counts",
    """SELECT 'recommended_action' AS field, recommended_action AS value, COUNT(*) AS n FROM decided GROUP BY 2
       UNION ALL SELECT 'urgency', urgency, COUNT(*) FROM decided GROUP BY 2
       UNION ALL SELECT 'risk_level', risk_level, COUNT(*) FROM decided GROUP BY 2""",
)
def _(x):
    return v.counts_of_many(x.decided, ["recommended_action", "urgency", "risk_level"])


@query("h16_event_type_counts", "SELECT 'event_type' AS field, event_type AS value, COUNT(*) AS n FROM ev GROUP BY event_type")
def _(x):
    return v.counts_of(x.events, "event_type")


@query(
    "c15_dashboard_filter",
    _SEGMENTED
    + """SELECT customerID, risk_level, segment_label, tenure, churn_probability, revenue_at_risk FROM seg
      WHERE risk_level IN ('MEDIUM', 'HIGH', 'CRITICAL') AND (segment_label IN ('High-value/low-risk', 'Low-value/high-risk') OR segment_label IS NULL)
        AND tenure BETWEEN 0 AND 60 AND churn_probability >= 0.55 ORDER BY revenue_at_risk DESC, customerID LIMIT 500""",
)
def _(x):
    from ebbtide.plans.scoring import filter_customers

    shown = filter_customers(
        segmented(x), levels=["MEDIUM", "HIGH", "CRITICAL"], segments=["High-value/low-risk", "Low-value/high-risk"],
        tenure=(0, 60), min_probability=0.55,
    )
    return shown.select("customerID", "risk_level", "segment_label", "tenure", "churn_probability", "revenue_at_risk")


# --- top-k -----------------------------------------------------------------------------------------------
@query(
    "j01_high_risk_list",
    """SELECT customer_id, churn_probability, risk_level, revenue_at_risk, recommended_action FROM decided
       WHERE risk_level <> 'LOW' ORDER BY revenue_at_risk DESC, customer_id LIMIT 50""",
)
def _(x):
    return v.customers_at_or_above(x.decided, "medium", 50).select(
        "customer_id", "churn_probability", "risk_level", "revenue_at_risk", "recommended_action"
    )


@query(
    "j03_level_order",
    """SELECT risk_level, COUNT(*) AS n, CAST(CASE risk_level WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 1 ELSE 0 END AS INTEGER) AS ordinal
       FROM valued GROUP BY risk_level""",
)
def _(x):
    counts = x.valued.groupBy("risk_level").agg(F.count("*").alias("n"))
    return counts.withColumn("ordinal", risk_ordinal("risk_level")).orderBy(F.desc("ordinal"))


@query(
    "j05_last_events",
    "SELECT event_id, customer_id, event_type, timestamp FROM ev ORDER BY timestamp DESC, event_id DESC LIMIT 25",
)
def _(x):
    slim = x.events.select("event_id", "customer_id", "event_type", "timestamp")
    return v.top_rows(slim, [F.desc("timestamp"), F.desc("event_id")], 25)


@query("j09_events_in_time_order", "SELECT event_id, customer_id, event_type, timestamp FROM ev ORDER BY timestamp, event_id")
def _(x):
    return x.events.select("event_id", "customer_id", "event_type", "timestamp").orderBy("timestamp", "event_id")


@query("j10_seeded_sample", "SELECT customerID FROM raw ORDER BY MD5(customerID || '42'), customerID LIMIT 100")
def _(x):
    from ebbtide.operators.split import draw

    return x.raw.select("customerID").orderBy(draw(F.col("customerID"), 42), "customerID").limit(100)


@query("j11_first_rows", "SELECT customerID, tenure, Contract FROM raw ORDER BY customerID LIMIT 5")
def _(x):
    return x.raw.select("customerID", "tenure", "Contract").orderBy("customerID").limit(5)


# --- set operations -----------------------------------------------------------------------------------------
@query("k01_top_sets_intersection", _TOPS + "SELECT customerID FROM tops WHERE by_p <= top_n AND by_v <= top_n")
def _(x):
    by_p, by_v = top_sets(x)
    return by_p.intersect(by_v)


@query("k02_top_sets_difference", _TOPS + "SELECT customerID FROM tops WHERE by_v <= top_n AND by_p > top_n")
def _(x):
    by_p, by_v = top_sets(x)
    return by_v.subtract(by_p)


def top_sets(x):
    """Ids of the top tenth by probability and by revenue at risk."""
    ranked = v.with_ranks(
        x.valued.select("customerID", "churn_probability", "revenue_at_risk"),
        {
            "by_p": [F.desc("churn_probability"), F.asc("customerID")],
            "by_v": [F.desc("revenue_at_risk"), F.asc("customerID")],
        },
        total="_rows",
    )
    n = v.top_count(F.col("_rows"), 0.10)
    return tuple(ranked.filter(F.col(r) <= n).select("customerID") for r in ("by_p", "by_v"))


@query(
    "k03_category_union",
    """SELECT DISTINCT value FROM (SELECT PaymentMethod AS value FROM raw WHERE tenure < 36
       UNION ALL SELECT PaymentMethod FROM raw WHERE tenure >= 36)""",
)
def _(x):
    young = x.raw.filter("tenure < 36").select(F.col("PaymentMethod").alias("value"))
    old = x.raw.filter("tenure >= 36").select(F.col("PaymentMethod").alias("value"))
    return young.union(old).distinct()


# --- scalar functions ---------------------------------------------------------------------------------------
@query(
    "m03_event_effects",
    """, deltas(event_type, delta) AS (VALUES ('payment_failed', 0.15), ('complaint', 0.12), ('support_ticket', 0.05),
  ('cancellation_attempt', 0.30), ('inactivity', 0.08), ('plan_downgrade', 0.06), ('login', -0.03), ('purchase', -0.05),
  ('plan_upgrade', -0.10))
  SELECT event_id, CAST(delta AS DOUBLE) AS delta,
         CAST(LEAST(1, GREATEST(0, CAST(churn_probability AS DECIMAL(18,6)) + delta)) AS DOUBLE) AS adjusted
  FROM ev JOIN valued ON customerID = customer_id JOIN deltas USING (event_type)""",
)
def _(x):
    p = x.valued.select(F.col("customerID").alias("customer_id"), "churn_probability")
    return spread_join(x.events, p, "customer_id", F.col("event_id")).select(
        "event_id",
        event_delta("event_type").cast("double").alias("delta"),
        adjusted_probability("churn_probability", "event_type").alias("adjusted"),
    )


@query(
    "n01_sql_functions",
    f"""SELECT risk_level, COUNT(*) AS n, {money('SUM(CAST(estimated_clv AS DECIMAL(18,6)))')} AS clv,
          COUNT(*) FILTER (churn_probability + 0.12 >= 0.5) AS above_medium_after_complaint
        FROM valued GROUP BY risk_level""",
)
def _(x):
    register_sql_functions(x.spark)
    x.scored.createOrReplaceTempView("scored_customers")
    return x.spark.sql(
        """SELECT churn_risk_level(churn_probability) AS risk_level, COUNT(*) AS n,
                  CAST(ROUND(SUM(ROUND(CAST(customer_lifetime_value(MonthlyCharges) AS DECIMAL(18,6)), 2)), 2) AS DOUBLE) AS clv,
                  COUNT_IF(event_adjusted_probability(churn_probability, 'complaint') >= 0.5) AS above_medium_after_complaint
           FROM scored_customers GROUP BY ALL"""
    )
