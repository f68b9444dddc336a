"""Query registry, shared input frames and the shared SQL view of the inputs."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.clean import clean_raw, standardise, to_silver_customers, to_silver_events
from ebbtide.operators.features import engineer_features, to_gold
from ebbtide.operators.value import decisions, with_value
from ebbtide.plans import warehouse as wh
from ebbtide.sources.projection import events_of, subscriptions, table, with_scorecard

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query over the given tables, with its SQL twin where there is one."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs.over(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = INPUTS_SQL + sql.strip()
        return fn

    return register


def also(name: str, of: str) -> None:
    """Register a query under a second inventory row that it covers as a whole."""
    if name in QUERIES:
        raise ValueError(f"duplicate query {name}")
    QUERIES[name] = QUERIES[of]
    if of in ORACLES:
        ORACLES[name] = ORACLES[of]


class Inputs:
    """The frames the queries start from: lazy plans over the tables, described once per session.

    Only the plans are kept; every query still reads the tables.
    """

    _known: dict[str, Inputs] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @classmethod
    def over(cls, spark: SparkSession, sf_dir: str) -> Inputs:
        inputs = cls._known.get(sf_dir)
        if inputs is None or inputs.spark is not spark:
            inputs = cls._known[sf_dir] = cls(spark, sf_dir)
        return inputs

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> DataFrame:
        return subscriptions(self.spark, self.sf_dir)

    @cached_property
    def clean(self) -> DataFrame:
        return clean_raw(self.raw)

    @cached_property
    def featured(self) -> DataFrame:
        return engineer_features(self.clean)

    @cached_property
    def scored(self) -> DataFrame:
        return with_scorecard(self.featured)

    @cached_property
    def valued(self) -> DataFrame:
        return with_value(self.scored)

    @cached_property
    def decided(self) -> DataFrame:
        return decisions(self.valued)

    @cached_property
    def events(self) -> DataFrame:
        return events_of(self.spark, self.sf_dir)

    @cached_property
    def landing(self) -> DataFrame:
        """A dirty landing feed derived from the customers: every seventh is sent a second time
        with padded, missing or broken cells. ``arrival`` orders the two deliveries."""
        first = self.raw.withColumns({"tenure": F.col("tenure").cast("string"), "arrival": F.lit(1).cast("long")})
        k = F.substring("customerID", 2, 8).cast("long")
        resent = first.filter(k % 7 == 0).withColumns(
            {
                "arrival": F.lit(2).cast("long"),
                "Contract": F.concat(F.lit("  "), F.col("Contract"), F.lit(" ")),
                "Churn": F.concat(F.lit(" "), F.upper("Churn")),
                "TotalCharges": F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, F.lit("n/a")).otherwise(F.col("TotalCharges")),
                "MonthlyCharges": F.when(k % 5 == 0, -F.col("MonthlyCharges")).otherwise(F.col("MonthlyCharges")),
                "tenure": F.when(k % 11 == 0, F.lit("unknown")).otherwise(F.concat(F.lit(" "), F.col("tenure"))),
            }
        )
        return first.unionByName(resent)

    @cached_property
    def silver(self) -> DataFrame:
        return to_silver_customers(self.landing, "arrival")

    @cached_property
    def silver_events(self) -> DataFrame:
        return to_silver_events(self.events)

    @cached_property
    def gold(self) -> DataFrame:
        """Gold over the clean customers (first deliveries) and all events."""
        return to_gold(standardise(self.raw), self.events)

    @cached_property
    def house(self) -> wh.Warehouse:
        """The warehouse tables, loaded from the projection of the given tables."""
        return wh.Warehouse(
            customers=wh.customers_table(self.raw),
            events=wh.events_table(self.events),
            features=wh.features_table(self.gold),
            predictions=wh.predictions_table(self.valued, "scorecard-v1"),
            actions=wh.actions_table(self.decided),
        )


# The same inputs, stated in SQL over the given tables.
INPUTS_SQL = """
WITH spend AS (
  SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent,
         COUNT(*) AS orders, MAX(o_orderdate) AS last_order
  FROM orders GROUP BY o_custkey),
sized AS (
  SELECT c_custkey AS k, c_mktsegment AS seg, last_order, CAST(c_custkey % 73 AS INTEGER) AS tenure,
         CAST(ROUND(CAST(COALESCE(spent / orders, 70000.0) / 3500 AS DECIMAL(18,6)), 2) AS DOUBLE) AS monthly
  FROM customer LEFT JOIN spend ON o_custkey = c_custkey),
raw AS (
  SELECT 'C' || LPAD(CAST(k AS VARCHAR), 8, '0') AS customerID,
         CASE WHEN k % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
         CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END AS SeniorCitizen,
         CASE WHEN (k // 2) % 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
         CASE WHEN k % 10 < 3 THEN 'Yes' ELSE 'No' END AS Dependents,
         tenure,
         CASE WHEN k % 10 = 9 THEN 'No' ELSE 'Yes' END AS PhoneService,
         CASE WHEN k % 10 = 9 THEN 'No phone service' WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS MultipleLines,
         CASE WHEN k % 5 IN (0, 1) THEN 'Fiber optic' WHEN k % 5 IN (2, 3) THEN 'DSL' ELSE 'No' END AS InternetService,
         CASE WHEN k % 5 = 4 THEN 'No internet service' WHEN k % 11 < 5 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
         CASE WHEN k % 5 = 4 THEN 'No internet service' WHEN k % 13 < 6 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
         CASE WHEN k % 5 = 4 THEN 'No internet service' WHEN k % 17 < 8 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
         CASE WHEN k % 5 = 4 THEN 'No internet service' WHEN k % 7 < 3 THEN 'Yes' ELSE 'No' END AS TechSupport,
         CASE WHEN k % 5 = 4 THEN 'No internet service' WHEN k % 19 < 9 THEN 'Yes' ELSE 'No' END AS StreamingTV,
         CASE WHEN k % 5 = 4 THEN 'No internet service' WHEN k % 23 < 11 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
         CASE seg WHEN 'FURNITURE' THEN 'One year' WHEN 'HOUSEHOLD' THEN 'Two year' ELSE 'Month-to-month' END AS Contract,
         CASE WHEN k % 3 = 0 THEN 'No' ELSE 'Yes' END AS PaperlessBilling,
         CASE k % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
                    WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
         monthly AS MonthlyCharges,
         CASE WHEN tenure = 0 THEN ' '
              ELSE CAST(CAST(ROUND(CAST(monthly * tenure AS DECIMAL(18,6)), 2) AS DECIMAL(18,2)) AS VARCHAR) END AS TotalCharges,
         CASE WHEN last_order >= TIMESTAMP '2000-11-01' THEN 'No' ELSE 'Yes' END AS Churn
  FROM sized),
clean AS (
  SELECT * REPLACE (
    CASE WHEN tenure = 0 THEN COALESCE(TRY_CAST(TRIM(TotalCharges) AS DOUBLE), 0.0)
         ELSE TRY_CAST(TRIM(TotalCharges) AS DOUBLE) END AS TotalCharges,
    CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS Churn)
  FROM raw),
featured AS (
  SELECT *, CAST(ROUND(CAST(total_services / 9.0 AS DECIMAL(18,6)), 4) AS DOUBLE) AS service_adoption_score
  FROM (SELECT *,
      CAST(has_phone + has_multiple_lines + has_internet + has_online_security + has_online_backup
        + has_device_protection + has_tech_support + has_streaming_tv + has_streaming_movies AS INTEGER) AS total_services,
      CASE WHEN has_streaming_tv + has_streaming_movies > 0 THEN 1 ELSE 0 END AS has_streaming
    FROM (SELECT *,
      CAST(PhoneService = 'Yes' AS INTEGER) AS has_phone,
      CAST(MultipleLines = 'Yes' AS INTEGER) AS has_multiple_lines,
      CAST(InternetService <> 'No' AS INTEGER) AS has_internet,
      CAST(OnlineSecurity = 'Yes' AS INTEGER) AS has_online_security,
      CAST(OnlineBackup = 'Yes' AS INTEGER) AS has_online_backup,
      CAST(DeviceProtection = 'Yes' AS INTEGER) AS has_device_protection,
      CAST(TechSupport = 'Yes' AS INTEGER) AS has_tech_support,
      CAST(StreamingTV = 'Yes' AS INTEGER) AS has_streaming_tv,
      CAST(StreamingMovies = 'Yes' AS INTEGER) AS has_streaming_movies,
      CAST(ROUND(CAST(CASE WHEN tenure > 0 THEN TotalCharges / tenure ELSE MonthlyCharges END AS DECIMAL(18,6)), 2) AS DOUBLE) AS average_charge_per_month,
      CAST(Contract = 'Month-to-month' AS INTEGER) AS is_month_to_month,
      CAST(Contract <> 'Month-to-month' AS INTEGER) AS is_long_term_contract,
      CAST(Contract = 'Month-to-month' AS INTEGER) AS contract_risk_indicator,
      CAST(PaymentMethod = 'Electronic check' AS INTEGER) AS payment_risk_indicator,
      CAST(tenure < 12 AS INTEGER) AS tenure_risk_indicator
    FROM clean))),
scored AS (
  SELECT *, CAST(ROUND(CAST(1 / (1 + EXP(-(-0.4::DOUBLE - 0.04::DOUBLE * tenure + 1.3::DOUBLE * is_month_to_month
      + 0.7::DOUBLE * payment_risk_indicator + 0.8::DOUBLE * CAST(InternetService = 'Fiber optic' AS INTEGER)
      - 0.4::DOUBLE * has_tech_support - 0.4::DOUBLE * has_online_security
      + 0.01::DOUBLE * (MonthlyCharges - 70)))) AS DECIMAL(18,6)), 4) AS DOUBLE) AS churn_probability
  FROM featured),
valued AS (
  SELECT *, revenue_at_risk AS priority_score,
    CASE WHEN churn_probability < 0.5 THEN 'LOW' WHEN churn_probability < 0.7 THEN 'MEDIUM'
         WHEN churn_probability < 0.85 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level
  FROM (SELECT *, CAST(ROUND(CAST(churn_probability * estimated_clv AS DECIMAL(18,6)), 2) AS DOUBLE) AS revenue_at_risk
    FROM (SELECT *, CAST(ROUND(CAST(MonthlyCharges * 24 * 0.30::DOUBLE AS DECIMAL(18,6)), 2) AS DOUBLE) AS estimated_clv
      FROM scored))),
acted AS (
  SELECT *, CASE
      WHEN risk_level = 'LOW' THEN 'no_intervention'
      WHEN risk_level = 'CRITICAL' AND estimated_clv >= 500 THEN 'account_manager_contact'
      WHEN PaymentMethod = 'Electronic check' THEN 'payment_assistance'
      WHEN Contract = 'Month-to-month' AND tenure < 12 THEN 'onboarding_assistance'
      WHEN Contract = 'Month-to-month' THEN 'plan_optimization'
      WHEN InternetService <> 'No' AND TechSupport <> 'Yes' THEN 'technical_support_intervention'
      WHEN InternetService <> 'No' AND OnlineSecurity <> 'Yes' THEN 'feature_education'
      WHEN estimated_clv >= 500 THEN 'loyalty_reward'
      ELSE 'personalized_discount' END AS recommended_action
  FROM valued),
catalogue(action, cost, reason) AS (VALUES
  ('no_intervention', 0.0::DOUBLE, 'Low churn risk; monitor only, no intervention needed.'),
  ('account_manager_contact', 120.0, 'Critical churn risk on a high-value customer; escalate to an account manager for immediate personal outreach.'),
  ('payment_assistance', 30.0, 'Electronic-check payer with elevated churn risk; offer payment assistance / auto-pay migration to reduce billing friction.'),
  ('onboarding_assistance', 25.0, 'New month-to-month customer within the high-churn first year; provide onboarding assistance and early engagement.'),
  ('plan_optimization', 40.0, 'Month-to-month contract; propose an annual plan with incentives to lengthen commitment.'),
  ('technical_support_intervention', 45.0, 'Internet plan without tech support; proactive technical support can address unresolved issues driving churn.'),
  ('feature_education', 15.0, 'No online-security add-on; educate on protective features to increase engagement and stickiness.'),
  ('loyalty_reward', 70.0, 'High-value at-risk customer; offer a loyalty reward to reinforce the relationship.'),
  ('personalized_discount', 60.0, 'Elevated churn risk without a dominant driver; a targeted personalised discount is the most cost-effective lever.')),
decided AS (
  SELECT customer_id, churn_probability, risk_level, estimated_clv, revenue_at_risk, priority_score, urgency,
         recommended_action, reason, estimated_intervention_cost, estimated_expected_retained_value,
         CAST(ROUND(CAST(estimated_expected_retained_value - estimated_intervention_cost AS DECIMAL(18,6)), 2) AS DOUBLE) AS estimated_net_value
  FROM (SELECT customerID AS customer_id, churn_probability, risk_level, estimated_clv, revenue_at_risk, priority_score,
         CASE risk_level WHEN 'CRITICAL' THEN 'IMMEDIATE' ELSE risk_level END AS urgency,
         recommended_action, reason, cost AS estimated_intervention_cost,
         CASE WHEN recommended_action = 'no_intervention' THEN 0.0::DOUBLE
              ELSE CAST(ROUND(CAST(revenue_at_risk * 0.35::DOUBLE AS DECIMAL(18,6)), 2) AS DOUBLE) END AS estimated_expected_retained_value
        FROM acted JOIN catalogue ON action = recommended_action)),
evn AS (SELECT *, CAST(REGEXP_EXTRACT(props, '([0-9]+)', 1) AS INTEGER) AS n FROM events),
ev AS (
  SELECT event_id, 'C' || LPAD(CAST(user_id AS VARCHAR), 8, '0') AS customer_id,
         CASE event_type WHEN 'view' THEN 'login' WHEN 'purchase' THEN 'purchase'
              WHEN 'signup' THEN CASE WHEN n % 2 = 0 THEN 'plan_upgrade' ELSE 'plan_downgrade' END
              WHEN 'error' THEN CASE WHEN n >= 66 THEN 'cancellation_attempt' WHEN n >= 33 THEN 'complaint' ELSE 'payment_failed' END
              WHEN 'click' THEN CASE WHEN n % 2 = 0 THEN 'support_ticket' ELSE 'inactivity' END END AS event_type,
         ts AS timestamp, value, TRUE AS is_simulated
  FROM evn),
landing AS (
  SELECT * REPLACE (CAST(tenure AS VARCHAR) AS tenure), CAST(1 AS BIGINT) AS arrival FROM raw
  UNION ALL
  SELECT * EXCLUDE (key) REPLACE (
      CASE WHEN key % 11 = 0 THEN 'unknown' ELSE ' ' || CAST(tenure AS VARCHAR) END AS tenure,
      '  ' || Contract || ' ' AS Contract, ' ' || UPPER(Churn) AS Churn,
      CASE WHEN key % 3 = 0 THEN NULL WHEN key % 3 = 1 THEN 'n/a' ELSE TotalCharges END AS TotalCharges,
      CASE WHEN key % 5 = 0 THEN -MonthlyCharges ELSE MonthlyCharges END AS MonthlyCharges),
    CAST(2 AS BIGINT) AS arrival
  FROM (SELECT *, CAST(SUBSTR(customerID, 2) AS BIGINT) AS key FROM raw) WHERE key % 7 = 0),
silver_all AS (
  SELECT * REPLACE (
      CASE WHEN total IS NOT NULL THEN total WHEN tenure = 0 THEN 0.0 ELSE MonthlyCharges * GREATEST(tenure, 1) END AS TotalCharges),
    CAST(LOWER(TRIM(Churn)) IN ('yes', '1', 'true') AS INTEGER) AS Churn_Numeric
  FROM (SELECT * REPLACE (COALESCE(TRY_CAST(TRIM(tenure) AS INTEGER), 0) AS tenure, TRIM(Contract) AS Contract),
               TRY_CAST(TRIM(TotalCharges) AS DOUBLE) AS total
        FROM landing QUALIFY ROW_NUMBER() OVER (PARTITION BY customerID ORDER BY arrival DESC) = 1)),
silver AS (SELECT * EXCLUDE (total, arrival) FROM silver_all
           WHERE tenure >= 0 AND MonthlyCharges >= 0 AND TotalCharges >= 0),
ev_counts AS (
  SELECT customer_id, COUNT(*) FILTER (event_type = 'complaint') AS complaint_count,
         COUNT(*) FILTER (event_type = 'support_ticket') AS support_ticket_count,
         COUNT(*) FILTER (event_type = 'payment_failed') AS payment_failed_count,
         COUNT(*) FILTER (event_type = 'login') AS login_count, COUNT(*) AS recent_events_count
  FROM ev GROUP BY customer_id),
gold_base AS (
  SELECT *, (MonthlyCharges - avg_monthly_charges_history) AS charge_discrepancy,
         LEAST(10.0::DOUBLE, GREATEST(0.1::DOUBLE, MonthlyCharges / (avg_monthly_charges_history + 0.000001::DOUBLE))) AS charge_ratio,
         CAST(CAST(PhoneService = 'Yes' AS INTEGER) + CAST(MultipleLines = 'Yes' AS INTEGER)
            + CAST(InternetService IN ('DSL', 'Fiber optic') AS INTEGER)
            + security_bundle_score + streaming_bundle_score AS INTEGER) AS total_active_services
  FROM (SELECT *,
      CASE WHEN tenure <= 12 THEN '0-12m (New)' WHEN tenure <= 24 THEN '12-24m (Early)'
           WHEN tenure <= 48 THEN '24-48m (Established)' WHEN tenure <= 72 THEN '48-72m (Loyal)'
           WHEN tenure <= 100 THEN '72m+ (Champion)' ELSE 'nan' END AS tenure_cohort,
      TotalCharges / (CASE WHEN tenure = 0 THEN 1 ELSE tenure END) AS avg_monthly_charges_history,
      CAST(CAST(OnlineSecurity = 'Yes' AS INTEGER) + CAST(OnlineBackup = 'Yes' AS INTEGER)
         + CAST(DeviceProtection = 'Yes' AS INTEGER) + CAST(TechSupport = 'Yes' AS INTEGER) AS INTEGER) AS security_bundle_score,
      CAST(CAST(StreamingTV = 'Yes' AS INTEGER) + CAST(StreamingMovies = 'Yes' AS INTEGER) AS INTEGER) AS streaming_bundle_score,
      CASE Contract WHEN 'Month-to-month' THEN 3 WHEN 'Two year' THEN 1 ELSE 2 END AS contract_risk_index,
      CAST(PaymentMethod = 'Electronic check' AS INTEGER) AS is_high_risk_payment,
      CAST(InternetService = 'Fiber optic' AND TechSupport <> 'Yes' AS INTEGER) AS is_fiber_without_techsupport,
      CAST(ROUND(CAST(MonthlyCharges * 24 * 0.30::DOUBLE AS DECIMAL(18,6)), 2) AS DOUBLE) AS estimated_clv
    FROM (SELECT * REPLACE (COALESCE(TRY_CAST(TRIM(TotalCharges) AS DOUBLE), 0.0) AS TotalCharges) FROM raw))),
gold AS (
  SELECT g.*, COALESCE(complaint_count, 0) AS complaint_count, COALESCE(support_ticket_count, 0) AS support_ticket_count,
         COALESCE(payment_failed_count, 0) AS payment_failed_count, COALESCE(login_count, 0) AS login_count,
         COALESCE(recent_events_count, 0) AS recent_events_count
  FROM gold_base g LEFT JOIN ev_counts e ON e.customer_id = g.customerID)
"""


# --- SQL text helpers of the registered queries ---------------------------------------------------
def money(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def total(c: str) -> str:
    return money(f"SUM(CAST({c} AS DECIMAL(18,6)))")


def mean(c: str, digits: int) -> str:
    return money(f"CAST(SUM(CAST({c} AS DECIMAL(18,6))) AS DOUBLE) / COUNT({c})", digits)
