"""Warehouse tables and reporting views over customers, events, features, predictions, actions.

The views carry no ORDER BY; the reports that show an order sort when they are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ebbtide.functions.numeric import count_of, exact_avg, exact_sum, number_or_null, rounded, rounded_total
from ebbtide.functions.risk import at_risk, risk_ordinal
from ebbtide.operators.ordered import top_rows, with_ntiles, with_rank
from ebbtide.operators.skew import spread_join
from ebbtide.vocab import ALERT_EVENTS, ID, WAREHOUSE_NAMES

FEATURE_COLUMNS = {
    "customerID": "customer_id", "tenure": "tenure", "tenure_cohort": "tenure_cohort", "Contract": "contract",
    "contract_risk_index": "contract_risk_index", "PaymentMethod": "payment_method",
    "is_high_risk_payment": "is_high_risk_payment", "InternetService": "internet_service",
    "is_fiber_without_techsupport": "is_fiber_without_techsupport", "MonthlyCharges": "monthly_charges",
    "TotalCharges": "total_charges", "avg_monthly_charges_history": "avg_monthly_charges_history",
    "charge_discrepancy": "charge_discrepancy", "charge_ratio": "charge_ratio",
    "security_bundle_score": "security_bundle_score", "streaming_bundle_score": "streaming_bundle_score",
    "total_active_services": "total_active_services", "complaint_count": "complaint_count",
    "support_ticket_count": "support_ticket_count", "payment_failed_count": "payment_failed_count",
    "login_count": "login_count", "recent_events_count": "recent_events_count", "estimated_clv": "estimated_clv",
}


# --- tables ------------------------------------------------------------------------------------
def customers_table(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(WAREHOUSE_NAMES).withColumn("total_charges", number_or_null("total_charges"))


def events_table(events: DataFrame) -> DataFrame:
    return events.select(
        F.coalesce(F.col("event_id").cast("string"), F.uuid()).alias("event_id"),
        "customer_id",
        "event_type",
        F.col("timestamp").alias("event_timestamp"),
        F.coalesce("value", F.lit(1.0)).alias("event_value"),
        F.coalesce("is_simulated", F.lit(True)).alias("is_simulated"),
    )


def features_table(gold: DataFrame) -> DataFrame:
    return gold.select([F.col(c).alias(n) for c, n in FEATURE_COLUMNS.items()])


def predictions_table(valued: DataFrame, model_version: str, drivers: Column | None = None) -> DataFrame:
    return valued.select(
        F.col(ID).alias("customer_id"),
        "churn_probability",
        "risk_level",
        "estimated_clv",
        "revenue_at_risk",
        (F.lit(None).cast("string") if drivers is None else drivers).alias("top_drivers"),
        F.lit(model_version).alias("model_version"),
    )


def actions_table(decided: DataFrame) -> DataFrame:
    return decided.select(
        "customer_id", "churn_probability", "risk_level", "urgency", "recommended_action", "reason", "revenue_at_risk",
        "estimated_intervention_cost",
        F.col("estimated_expected_retained_value").alias("estimated_retained_value"),
        "estimated_net_value",
        F.lit("RECOMMENDED").alias("action_status"),
    )


def with_sequence_key(df: DataFrame, order: list[Column], prefix: str, name: str) -> DataFrame:
    """Synthetic keys ``prefix-00000...`` in ``order`` from the global rank."""
    return (
        with_rank(df, order, "_n")
        .withColumn(name, F.format_string(f"{prefix}-%05d", F.col("_n") - 1))
        .drop("_n")
    )


@dataclass
class Warehouse:
    customers: DataFrame
    events: DataFrame
    features: DataFrame
    predictions: DataFrame
    actions: DataFrame
    model_runs: DataFrame | None = None


# --- shared measures ------------------------------------------------------------------------------
def _total(c: str) -> Column:
    return rounded_total(exact_sum(c), 2)


def _mean(c: str, digits: int) -> Column:
    return rounded_total(exact_avg(c), digits)


def _percent(part: Column, whole: Column) -> Column:
    return rounded_total(part * 100.0 / whole, 2)


# --- customer views ----------------------------------------------------------------------------------
def customer_360(w: Warehouse) -> DataFrame:
    base = w.customers.select(
        "customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure", "contract", "payment_method",
        "internet_service", "monthly_charges", "total_charges", "churn_label",
    )
    extra = w.features.select(
        "customer_id", "tenure_cohort", "contract_risk_index", "is_high_risk_payment", "is_fiber_without_techsupport",
        "charge_ratio", "security_bundle_score", "streaming_bundle_score", "total_active_services",
        "complaint_count", "support_ticket_count", "payment_failed_count", "estimated_clv",
    )
    return base.join(extra, "customer_id", "left")


def rfm_metrics(w: Warehouse) -> DataFrame:
    """Three quintiles over the whole base, 1 = highest, from global ranks."""
    out = w.features.select(
        "customer_id",
        F.col("tenure").alias("monetary_tenure_months"),
        F.col("total_charges").alias("cumulative_spend"),
        F.col("monthly_charges").alias("current_mrr"),
        F.col("total_active_services").alias("service_frequency"),
        F.col("recent_events_count").alias("activity_frequency"),
        F.col("complaint_count").alias("risk_frequency"),
    )
    tiles = {
        "monetary_quintile": "cumulative_spend",
        "recency_quintile": "monetary_tenure_months",
        "frequency_quintile": "service_frequency",
    }
    orders = {tile: [F.desc_nulls_last(m), F.asc("customer_id")] for tile, m in tiles.items()}
    return with_ntiles(out, 5, orders)


def churn_correlations(w: Warehouse) -> DataFrame:
    churned = count_of(F.col("churn_label") == "Yes")
    return w.customers.groupBy("contract", "payment_method", "internet_service").agg(
        F.count("*").alias("total_customers"),
        churned.alias("churned_customers"),
        _percent(churned, F.count("*")).alias("churn_percentage"),
        _mean("monthly_charges", 2).alias("avg_monthly_charges"),
        _mean("total_charges", 2).alias("avg_total_charges"),
    )


def raw_ingestion_check(w: Warehouse) -> DataFrame:
    return w.customers.agg(
        F.count("*").alias("total_raw_customers"),
        F.count_distinct("customer_id").alias("distinct_customers"),
        count_of(F.col("churn_label") == "Yes").alias("historical_churned"),
        _mean("monthly_charges", 2).alias("avg_monthly_charges"),
    )


# --- prediction views ------------------------------------------------------------------------------
def high_risk_customers(w: Warehouse) -> DataFrame:
    extra = w.features.select(
        "customer_id", "tenure_cohort", "contract", "monthly_charges", "complaint_count", "support_ticket_count"
    )
    return w.predictions.filter(at_risk("risk_level")).join(extra, "customer_id")


def model_performance(w: Warehouse) -> DataFrame:
    metrics = ["roc_auc", "pr_auc", "f1_score", "recall_score", "precision_score", "brier_score"]
    return w.model_runs.select(
        "model_name", "model_version", "calibration_method", "deployment_stage", *[rounded(m, 4).alias(m) for m in metrics],
        "trained_at",
    )


def risk_exposure(w: Warehouse) -> DataFrame:
    """Exposure per level; the share is taken over the few aggregated rows."""
    share = F.col("customer_count") * 100.0 / F.sum("customer_count").over(W.partitionBy())
    return (
        w.predictions.groupBy("risk_level")
        .agg(
            F.count("customer_id").alias("customer_count"),
            _mean("churn_probability", 4).alias("avg_churn_probability"),
            _total("revenue_at_risk").alias("total_revenue_at_risk"),
            _mean("revenue_at_risk", 2).alias("avg_revenue_at_risk_per_cust"),
            _total("estimated_clv").alias("total_portfolio_clv"),
        )
        .withColumn("share_of_base_pct", rounded_total(share, 2))
        .orderBy(risk_ordinal("risk_level").desc())
    )


def cohort_vulnerability(w: Warehouse, min_customers: int = 20, limit: int = 20) -> DataFrame:
    rows = (
        w.customers.select("customer_id", "contract", "payment_method", "monthly_charges")
        .join(w.features.select("customer_id", "tenure_cohort"), "customer_id")
        .join(w.predictions.select("customer_id", "risk_level", "revenue_at_risk"), "customer_id")
    )
    high = count_of(at_risk("risk_level"))
    cells = rows.groupBy("tenure_cohort", "contract", "payment_method").agg(
        F.count("*").alias("total_customers"),
        high.alias("high_risk_customers"),
        _percent(high, F.count("*")).alias("high_risk_rate_pct"),
        _mean("monthly_charges", 2).alias("avg_monthly_charges"),
        _total("revenue_at_risk").alias("total_exposure"),
    )
    order = [F.desc("total_exposure"), F.asc("tenure_cohort"), F.asc("contract"), F.asc("payment_method")]
    return top_rows(cells.filter(F.col("total_customers") >= min_customers), order, limit)


def urgent_customers(w: Warehouse, limit: int = 10) -> DataFrame:
    """The limit is on the joined result, so a customer without an action never takes a place."""
    risky = w.predictions.filter(at_risk("risk_level")).select(
        "customer_id", "churn_probability", "risk_level", "revenue_at_risk"
    )
    who = w.customers.select(
        "customer_id", F.col("tenure").alias("tenure_months"), "contract", "payment_method", "internet_service",
        "monthly_charges",
    )
    todo = w.actions.filter(F.col("urgency").isin("IMMEDIATE", "HIGH")).select(
        "customer_id", "recommended_action", "urgency", "reason", "estimated_net_value"
    )
    rows = risky.join(who, "customer_id").join(todo, "customer_id")
    return top_rows(rows, [F.desc("revenue_at_risk"), F.asc("customer_id")], limit)


# --- executive and campaign views --------------------------------------------------------------------
def executive_summary(w: Warehouse) -> DataFrame:
    """Seven KPIs over the joined tables; a customer with several predictions counts several
    times in the sums, as the report defines it."""
    rows = (
        w.customers.select("customer_id", "monthly_charges")
        .join(w.predictions.select("customer_id", "churn_probability", "risk_level", "revenue_at_risk"), "customer_id", "left")
        .join(w.actions.select("customer_id", "estimated_net_value"), "customer_id", "left")
    )
    high, people = count_of(at_risk("risk_level")), F.count_distinct("customer_id")
    return rows.agg(
        people.alias("total_customers"),
        high.alias("at_risk_customers"),
        _percent(high, people).alias("at_risk_percentage"),
        _mean("churn_probability", 4).alias("average_churn_probability"),
        _total("revenue_at_risk").alias("total_revenue_at_risk"),
        _total("estimated_net_value").alias("total_potential_recovery_value"),
        _total("monthly_charges").alias("total_monthly_recurring_revenue"),
    )


def executive_summary_per_customer(w: Warehouse) -> DataFrame:
    """The same KPIs with each customer counted once, however many predictions or actions exist."""
    latest = w.predictions.groupBy("customer_id").agg(
        F.max("churn_probability").alias("churn_probability"),
        F.max(risk_ordinal("risk_level")).alias("level"),
        F.max("revenue_at_risk").alias("revenue_at_risk"),
    )
    gains = w.actions.groupBy("customer_id").agg(F.max("estimated_net_value").alias("estimated_net_value"))
    rows = (
        w.customers.select("customer_id", "monthly_charges")
        .join(latest, "customer_id", "left")
        .join(gains, "customer_id", "left")
    )
    high = count_of(F.col("level") >= 2)
    return rows.agg(
        F.count("*").alias("total_customers"),
        high.alias("at_risk_customers"),
        _percent(high, F.count("*")).alias("at_risk_percentage"),
        _mean("churn_probability", 4).alias("average_churn_probability"),
        _total("revenue_at_risk").alias("total_revenue_at_risk"),
        _total("estimated_net_value").alias("total_potential_recovery_value"),
        _total("monthly_charges").alias("total_monthly_recurring_revenue"),
    )


def revenue_at_risk_by_segment(w: Warehouse) -> DataFrame:
    rows = w.features.select("customer_id", "tenure_cohort", "contract", "payment_method").join(
        w.predictions.select("customer_id", "churn_probability", "risk_level", "revenue_at_risk"), "customer_id"
    )
    return rows.groupBy("tenure_cohort", "contract", "payment_method").agg(
        F.count("customer_id").alias("customer_count"),
        count_of(at_risk("risk_level")).alias("high_risk_count"),
        _mean("churn_probability", 3).alias("avg_churn_prob"),
        _total("revenue_at_risk").alias("total_revenue_at_risk"),
        _mean("revenue_at_risk", 2).alias("avg_revenue_at_risk_per_cust"),
    )


def campaign_roi(w: Warehouse) -> DataFrame:
    gain, cost = exact_sum("estimated_net_value"), exact_sum("estimated_intervention_cost")
    return w.actions.groupBy("recommended_action", "urgency").agg(
        F.count("*").alias("total_recommended_campaigns"),
        _total("revenue_at_risk").alias("total_revenue_protected"),
        _total("estimated_intervention_cost").alias("total_intervention_investment"),
        _total("estimated_retained_value").alias("total_expected_retained_value"),
        _total("estimated_net_value").alias("total_expected_net_profit"),
        rounded_total(F.try_divide(gain, F.nullif(cost, F.lit(0.0))) * 100.0, 1).alias("expected_campaign_roi_percent"),
    )


def action_breakdown(w: Warehouse) -> DataFrame:
    return w.actions.groupBy("recommended_action", "urgency").agg(
        F.count("*").alias("total_actions"),
        _total("revenue_at_risk").alias("revenue_at_risk_covered"),
        _total("estimated_intervention_cost").alias("total_budget_required"),
        _total("estimated_retained_value").alias("total_expected_return"),
        _total("estimated_net_value").alias("net_preserved_profit"),
    )


# --- event views --------------------------------------------------------------------------------------
def realtime_alerts(w: Warehouse) -> DataFrame:
    """Risk-raising events of high-risk customers with their action. The customer side is joined
    and filtered first; the event side may hold hot customers, so their rows are spread."""
    who = (
        w.predictions.filter(at_risk("risk_level"))
        .select("customer_id", F.col("churn_probability").alias("current_churn_prob"), "risk_level")
        .join(w.actions.select("customer_id", "recommended_action", "urgency"), "customer_id")
    )
    raised = w.events.filter(F.col("event_type").isin(ALERT_EVENTS)).select(
        "customer_id", "event_type", "event_timestamp", "event_id"
    )
    return spread_join(raised, who, "customer_id", F.col("event_id")).drop("event_id")


def incident_impact(w: Warehouse) -> DataFrame:
    """Impact per event type. Events are counted per customer and type before the join, so a hot
    customer enters it with at most one row per type."""
    return impact_of(w.events.groupBy("customer_id", "event_type").agg(F.count("event_id").alias("n")), w.predictions)


def impact_of(counted: DataFrame, predictions: DataFrame) -> DataFrame:
    """Impact per event type from counts (customer_id, event_type, n)."""
    rows = counted.join(
        predictions.select("customer_id", "churn_probability", "risk_level", "revenue_at_risk"), "customer_id"
    )
    n, p, exposed = F.col("n"), F.col("churn_probability"), F.col("revenue_at_risk")
    weighted_p = F.sum(n * p.cast("decimal(18,6)")).cast("double")
    known_p = F.sum(F.when(p.isNotNull(), n))
    return rows.groupBy("event_type").agg(
        F.sum(n).cast("long").alias("event_count"),
        F.count_distinct("customer_id").alias("affected_customers"),
        rounded_total(weighted_p / F.nullif(known_p, F.lit(0)), 4).alias("avg_churn_prob_after_event"),
        F.sum(F.when(F.col("risk_level") == "CRITICAL", n).otherwise(0)).cast("long").alias("critical_escalations"),
        rounded_total(F.sum(n * exposed.cast("decimal(18,6)")), 2).alias("total_associated_risk"),
    )


VIEWS = {
    "v_customer_360": customer_360,
    "v_rfm_metrics": rfm_metrics,
    "v_churn_correlations": churn_correlations,
    "v_high_risk_customers": high_risk_customers,
    "v_model_performance_metrics": model_performance,
    "v_executive_churn_summary": executive_summary,
    "v_revenue_at_risk_by_segment": revenue_at_risk_by_segment,
    "v_retention_campaign_roi": campaign_roi,
    "v_realtime_churn_alerts": realtime_alerts,
}


def create_views(spark: SparkSession, w: Warehouse, views: list[str] | None = None) -> list[str]:
    """Register the tables and all (or the named) views for SQL; names are case-insensitive."""
    tables = {
        "customers": w.customers, "customer_events": w.events, "customer_features": w.features,
        "churn_predictions": w.predictions, "retention_actions": w.actions, "model_runs": w.model_runs,
    }
    made = []
    for name, df in tables.items():
        if df is not None:
            df.createOrReplaceTempView(name)
            made.append(name)
    for name, build in VIEWS.items():
        if (views and name not in views) or (name == "v_model_performance_metrics" and w.model_runs is None):
            continue
        build(w).createOrReplaceTempView(name)
        made.append(name)
    return made
