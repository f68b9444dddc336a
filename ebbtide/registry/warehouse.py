"""Reporting views and queries, joins included."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ebbtide.functions.numeric import rounded
from ebbtide.plans import warehouse as wh
from ebbtide.plans.load import store_co_located
from ebbtide.registry.base import Inputs, also, mean, money, query, total
from ebbtide.session import scratch_path

# Columns of the SQL sides that several queries share.
_HIGH = "COUNT(*) FILTER (risk_level IN ('HIGH', 'CRITICAL'))"


@query(
    "r01_customer_360",
    f"""SELECT r.customerID AS customer_id, r.gender, r.SeniorCitizen AS senior_citizen, r.Partner AS partner,
          r.Dependents AS dependents, r.tenure, tenure_cohort, r.Contract AS contract, contract_risk_index,
          r.PaymentMethod AS payment_method, is_high_risk_payment, r.InternetService AS internet_service,
          is_fiber_without_techsupport, r.MonthlyCharges AS monthly_charges,
          TRY_CAST(TRIM(r.TotalCharges) AS DOUBLE) AS total_charges, {money('charge_ratio', 6)} AS charge_ratio,
          security_bundle_score, streaming_bundle_score, total_active_services, complaint_count,
          support_ticket_count, payment_failed_count, estimated_clv, r.Churn AS churn_label
        FROM raw r LEFT JOIN gold g USING (customerID)""",
)
def _(x):
    return wh.customer_360(x.house).withColumn("charge_ratio", rounded("charge_ratio", 6))


@query(
    "r02_rfm_metrics",
    """SELECT customerID AS customer_id, tenure AS monetary_tenure_months, TotalCharges AS cumulative_spend,
          MonthlyCharges AS current_mrr, total_active_services AS service_frequency,
          recent_events_count AS activity_frequency, complaint_count AS risk_frequency,
          CAST(NTILE(5) OVER (ORDER BY TotalCharges DESC, customerID) AS INTEGER) AS monetary_quintile,
          CAST(NTILE(5) OVER (ORDER BY tenure DESC, customerID) AS INTEGER) AS recency_quintile,
          CAST(NTILE(5) OVER (ORDER BY total_active_services DESC, customerID) AS INTEGER) AS frequency_quintile
        FROM gold""",
)
def _(x):
    return wh.rfm_metrics(x.house)


@query(
    "r03_churn_correlations",
    f"""SELECT Contract AS contract, PaymentMethod AS payment_method, InternetService AS internet_service,
          COUNT(*) AS total_customers, COUNT(*) FILTER (Churn = 'Yes') AS churned_customers,
          {money("COUNT(*) FILTER (Churn = 'Yes') * 100.0::DOUBLE / COUNT(*)")} AS churn_percentage,
          {mean('MonthlyCharges', 2)} AS avg_monthly_charges, {mean('num_total', 2)} AS avg_total_charges
        FROM (SELECT *, TRY_CAST(TRIM(TotalCharges) AS DOUBLE) AS num_total FROM raw)
        GROUP BY ALL""",
)
def _(x):
    return wh.churn_correlations(x.house)


@query(
    "r04_high_risk_customers",
    """SELECT v.customerID AS customer_id, churn_probability, risk_level, v.estimated_clv, revenue_at_risk,
          CAST(NULL AS VARCHAR) AS top_drivers, 'scorecard-v1' AS model_version, tenure_cohort,
          v.Contract AS contract, v.MonthlyCharges AS monthly_charges, complaint_count, support_ticket_count
        FROM valued v JOIN gold g USING (customerID) WHERE risk_level IN ('HIGH', 'CRITICAL')""",
)
def _(x):
    return wh.high_risk_customers(x.house)


_EXEC = f"""SELECT COUNT(DISTINCT c.customerID) AS total_customers, {_HIGH} AS at_risk_customers,
          {money(_HIGH + " * 100.0::DOUBLE / COUNT(DISTINCT c.customerID)")} AS at_risk_percentage,
          {mean('churn_probability', 4)} AS average_churn_probability,
          {total('p.revenue_at_risk')} AS total_revenue_at_risk,
          {total('estimated_net_value')} AS total_potential_recovery_value,
          {total('c.MonthlyCharges')} AS total_monthly_recurring_revenue
        FROM raw c LEFT JOIN p ON p.customerID = c.customerID
        LEFT JOIN (SELECT customer_id, estimated_net_value FROM decided) d ON d.customer_id = c.customerID"""


@query("r06_executive_summary", f", p AS (SELECT customerID, churn_probability, risk_level, revenue_at_risk FROM valued) {_EXEC}")
def _(x):
    return wh.executive_summary(x.house)


def with_repeats(x: Inputs) -> wh.Warehouse:
    """Every fiftieth customer has been scored twice."""
    w = replace(x.house)
    k = F.substring("customer_id", 2, 8).cast("long")
    w.predictions = w.predictions.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(k % 50 == 0, 2).otherwise(1)))).drop("copy")
    return w


_REPEATED = """, p AS (SELECT customerID, churn_probability, risk_level, revenue_at_risk FROM valued UNION ALL
    SELECT customerID, churn_probability, risk_level, revenue_at_risk FROM valued
    WHERE CAST(SUBSTR(customerID, 2) AS BIGINT) % 50 = 0) """


@query("g06_executive_summary_fanout", _REPEATED + _EXEC)
def _(x):
    return wh.executive_summary(with_repeats(x))


@query("r06_executive_summary_per_customer", f", p AS (SELECT customerID, churn_probability, risk_level, revenue_at_risk FROM valued) {_EXEC}")
def _(x):
    return wh.executive_summary_per_customer(with_repeats(x))


@query(
    "r07_revenue_at_risk_by_segment",
    f"""SELECT tenure_cohort, g.Contract AS contract, g.PaymentMethod AS payment_method, COUNT(*) AS customer_count,
          {_HIGH} AS high_risk_count, {mean('churn_probability', 3)} AS avg_churn_prob,
          {total('revenue_at_risk')} AS total_revenue_at_risk, {mean('revenue_at_risk', 2)} AS avg_revenue_at_risk_per_cust
        FROM gold g JOIN valued v USING (customerID) GROUP BY ALL""",
)
def _(x):
    return wh.revenue_at_risk_by_segment(x.house)


@query(
    "r08_campaign_roi",
    f"""SELECT recommended_action, urgency, COUNT(*) AS total_recommended_campaigns,
          {total('revenue_at_risk')} AS total_revenue_protected,
          {total('estimated_intervention_cost')} AS total_intervention_investment,
          {total('estimated_expected_retained_value')} AS total_expected_retained_value,
          {total('estimated_net_value')} AS total_expected_net_profit,
          {money("CAST(SUM(CAST(estimated_net_value AS DECIMAL(18,6))) AS DOUBLE) / NULLIF(CAST(SUM(CAST(estimated_intervention_cost AS DECIMAL(18,6))) AS DOUBLE), 0) * 100.0::DOUBLE", 1)} AS expected_campaign_roi_percent
        FROM decided GROUP BY ALL""",
)
def _(x):
    return wh.campaign_roi(x.house)


_ALERTS = """SELECT e.customer_id, event_type, timestamp AS event_timestamp, d.churn_probability AS current_churn_prob,
          risk_level, recommended_action, urgency
        FROM ev e JOIN decided d USING (customer_id)
        WHERE event_type IN ('complaint', 'payment_failed', 'cancellation_attempt') AND risk_level IN ('HIGH', 'CRITICAL')"""


@query("r09_realtime_alerts", _ALERTS)
def _(x):
    return wh.realtime_alerts(x.house)


@query(
    "r10_risk_exposure",
    f"""SELECT risk_level, COUNT(*) AS customer_count,
          {money("COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER ()")} AS share_of_base_pct,
          {mean('churn_probability', 4)} AS avg_churn_probability, {total('revenue_at_risk')} AS total_revenue_at_risk,
          {mean('revenue_at_risk', 2)} AS avg_revenue_at_risk_per_cust, {total('estimated_clv')} AS total_portfolio_clv
        FROM valued GROUP BY risk_level""",
)
def _(x):
    return wh.risk_exposure(x.house)


@query(
    "r11_cohort_vulnerability",
    f"""SELECT tenure_cohort, g.Contract AS contract, g.PaymentMethod AS payment_method, COUNT(*) AS total_customers,
          {_HIGH} AS high_risk_customers, {money(_HIGH + " * 100.0::DOUBLE / COUNT(*)")} AS high_risk_rate_pct,
          {mean('g.MonthlyCharges', 2)} AS avg_monthly_charges, {total('revenue_at_risk')} AS total_exposure
        FROM gold g JOIN valued v USING (customerID) GROUP BY tenure_cohort, g.Contract, g.PaymentMethod
        HAVING COUNT(*) >= 20 ORDER BY total_exposure DESC, tenure_cohort, contract, payment_method LIMIT 20""",
)
def _(x):
    return wh.cohort_vulnerability(x.house)


_URGENT = """SELECT d.customer_id, tenure AS tenure_months, Contract AS contract, PaymentMethod AS payment_method,
          InternetService AS internet_service, MonthlyCharges AS monthly_charges, d.churn_probability, risk_level,
          revenue_at_risk, recommended_action, urgency, reason, estimated_net_value
        FROM decided d JOIN raw r ON r.customerID = d.customer_id WHERE urgency IN ('IMMEDIATE', 'HIGH')
        ORDER BY revenue_at_risk DESC, d.customer_id LIMIT 10"""


@query("r12_urgent_customers", _URGENT)
def _(x):
    return wh.urgent_customers(x.house)


_IMPACT = f"""SELECT event_type, COUNT(*) AS event_count, COUNT(DISTINCT customer_id) AS affected_customers,
          {mean('churn_probability', 4)} AS avg_churn_prob_after_event,
          COUNT(*) FILTER (risk_level = 'CRITICAL') AS critical_escalations,
          {total('revenue_at_risk')} AS total_associated_risk
        FROM ev JOIN decided USING (customer_id) GROUP BY event_type"""


@query("r13_incident_impact", _IMPACT)
def _(x):
    return wh.incident_impact(x.house)


_BREAKDOWN = f"""SELECT recommended_action, urgency, COUNT(*) AS total_actions, {total('revenue_at_risk')} AS revenue_at_risk_covered,
          {total('estimated_intervention_cost')} AS total_budget_required,
          {total('estimated_expected_retained_value')} AS total_expected_return,
          {total('estimated_net_value')} AS net_preserved_profit
        FROM decided GROUP BY ALL"""


@query("r14_action_breakdown", _BREAKDOWN)
def _(x):
    return wh.action_breakdown(x.house)


@query(
    "r15_high_risk_top10",
    """SELECT v.customerID AS customer_id, churn_probability, risk_level, revenue_at_risk, v.estimated_clv, tenure_cohort,
          v.Contract AS contract
        FROM valued v JOIN gold g USING (customerID) WHERE risk_level IN ('HIGH', 'CRITICAL')
        ORDER BY revenue_at_risk DESC, v.customerID LIMIT 10""",
)
def _(x):
    view = wh.high_risk_customers(x.house).select(
        "customer_id", "churn_probability", "risk_level", "revenue_at_risk", "estimated_clv", "tenure_cohort", "contract"
    )
    return wh.top_rows(view, [F.desc("revenue_at_risk"), F.asc("customer_id")], 10)


@query(
    "r16_raw_ingestion_check",
    f"""SELECT COUNT(*) AS total_raw_customers, COUNT(DISTINCT customerID) AS distinct_customers,
          COUNT(*) FILTER (Churn = 'Yes') AS historical_churned, {mean('MonthlyCharges', 2)} AS avg_monthly_charges
        FROM raw""",
)
def _(x):
    return wh.raw_ingestion_check(x.house)


@query(
    "a24_views_in_sql",
    f"""SELECT urgency, COUNT(*) AS alerts, COUNT(DISTINCT customer_id) AS customers FROM ({_ALERTS}) GROUP BY urgency""",
)
def _(x):
    wh.create_views(x.spark, x.house, ["v_realtime_churn_alerts"])
    return x.spark.sql(
        """SELECT URGENCY AS urgency, COUNT(*) AS alerts, COUNT(DISTINCT CUSTOMER_ID) AS customers
           FROM V_REALTIME_CHURN_ALERTS GROUP BY URGENCY"""
    )


# --- the joins of the inventory, each the whole report that uses it ----------------------------------
@query(
    "g09_co_located_join",
    f"""SELECT r.Contract AS contract, tenure_cohort, COUNT(*) AS n, {total('revenue_at_risk')} AS exposure,
          {total('estimated_net_value')} AS net_value
        FROM raw r JOIN gold g USING (customerID) JOIN decided d ON d.customer_id = customerID GROUP BY ALL""",
)
def _(x):
    """Four customer-keyed tables bucketed alike: joined and grouped without moving a customer."""
    from ebbtide.functions.numeric import exact_sum, rounded_total

    w = store_co_located(x.house, scratch_path(x.spark, "buckets"), "co_located_")
    rows = (
        w.customers.select("customer_id", "contract")
        .join(w.features.select("customer_id", "tenure_cohort"), "customer_id")
        .join(w.predictions.select("customer_id", "revenue_at_risk"), "customer_id")
        .join(w.actions.select("customer_id", "estimated_net_value"), "customer_id")
    )
    return rows.groupBy("contract", "tenure_cohort").agg(
        F.count("*").alias("n"),
        rounded_total(exact_sum("revenue_at_risk"), 2).alias("exposure"),
        rounded_total(exact_sum("estimated_net_value"), 2).alias("net_value"),
    )


also("b16_raw_check", "r16_raw_ingestion_check")
also("g04_customers_left_features", "r01_customer_360")
also("g05_predictions_join_features", "r04_high_risk_customers")
also("g07_features_join_predictions", "r07_revenue_at_risk_by_segment")
also("g08_events_predictions_actions", "r09_realtime_alerts")
also("g10_predictions_customers_actions", "r12_urgent_customers")
also("g11_events_join_predictions", "r13_incident_impact")
also("j02_urgent_customers", "r12_urgent_customers")
