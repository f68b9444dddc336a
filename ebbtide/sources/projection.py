"""Subscription customers and events as a projection of the star-schema tables.

Every customer and every event of the given tables becomes one row; nothing is filtered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.numeric import rounded
from ebbtide.vocab import RAW_COLUMNS

# The fixed scorecard that stands in for a trained model wherever results are compared exactly:
# intercept, then weight per signal.
SCORECARD_INTERCEPT = -0.4
SCORECARD = {
    "tenure": -0.04,
    "is_month_to_month": 1.3,
    "payment_risk_indicator": 0.7,
    "is_fiber": 0.8,
    "has_tech_support": -0.4,
    "has_online_security": -0.4,
    "monthly_over_70": 0.01,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _yes_when(condition: Column) -> Column:
    return F.when(condition, "Yes").otherwise("No")


def _add_on(k: Column, modulus: int, below: int) -> Column:
    return F.when(k % 5 == 4, "No internet service").otherwise(_yes_when(k % modulus < below))


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 21 raw customer columns, one row per customer."""
    spend = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spent"),
            F.count("*").alias("orders"),
            F.max("o_orderdate").alias("last_order"),
        )
    )
    k = F.col("c_custkey")
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").join(spend, "c_custkey", "left")
    monthly = rounded(F.coalesce(F.col("spent") / F.col("orders"), F.lit(70000.0)) / 3500, 2)
    sized = base.withColumns({"tenure": (k % 73).cast("int"), "MonthlyCharges": monthly})
    segment = F.col("c_mktsegment")
    total = F.round((F.col("MonthlyCharges") * F.col("tenure")).cast("decimal(18,6)"), 2).cast("decimal(18,2)")
    return sized.withColumns(
        {
            "customerID": F.concat(F.lit("C"), F.lpad(k.cast("string"), 8, "0")),
            "gender": F.when(k % 2 == 0, "Male").otherwise("Female"),
            "SeniorCitizen": (k % 6 == 0).cast("int"),
            "Partner": _yes_when(F.floor(k / 2) % 2 == 0),
            "Dependents": _yes_when(k % 10 < 3),
            "PhoneService": _yes_when(k % 10 != 9),
            "MultipleLines": F.when(k % 10 == 9, "No phone service").otherwise(_yes_when(k % 3 == 0)),
            "InternetService": F.when(k % 5 < 2, "Fiber optic").when(k % 5 < 4, "DSL").otherwise("No"),
            "OnlineSecurity": _add_on(k, 11, 5),
            "OnlineBackup": _add_on(k, 13, 6),
            "DeviceProtection": _add_on(k, 17, 8),
            "TechSupport": _add_on(k, 7, 3),
            "StreamingTV": _add_on(k, 19, 9),
            "StreamingMovies": _add_on(k, 23, 11),
            "Contract": F.when(segment == "FURNITURE", "One year")
            .when(segment == "HOUSEHOLD", "Two year")
            .otherwise("Month-to-month"),
            "PaperlessBilling": _yes_when(k % 3 != 0),
            "PaymentMethod": F.when(k % 4 == 0, "Electronic check")
            .when(k % 4 == 1, "Mailed check")
            .when(k % 4 == 2, "Bank transfer (automatic)")
            .otherwise("Credit card (automatic)"),
            "TotalCharges": F.when(F.col("tenure") == 0, " ").otherwise(total.cast("string")),
            "Churn": _yes_when(
                F.coalesce(F.col("last_order") < F.lit("2000-11-01").cast("timestamp_ntz"), F.lit(True))
            ),
        }
    ).select(*RAW_COLUMNS)


def customer_events(events: DataFrame) -> DataFrame:
    """Event rows (batch or streaming) as customer events; a row-wise projection."""
    n = F.get_json_object("props", "$.k").cast("int")
    even = n % 2 == 0
    kind = F.col("event_type")
    return events.select(
        "event_id",
        F.concat(F.lit("C"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("customer_id"),
        F.when(kind == "view", "login")
        .when(kind == "purchase", "purchase")
        .when((kind == "signup") & even, "plan_upgrade")
        .when(kind == "signup", "plan_downgrade")
        .when((kind == "error") & (n < 33), "payment_failed")
        .when((kind == "error") & (n < 66), "complaint")
        .when(kind == "error", "cancellation_attempt")
        .when((kind == "click") & even, "support_ticket")
        .when(kind == "click", "inactivity")
        .alias("event_type"),
        F.col("ts").alias("timestamp"),
        "value",
        F.lit(True).alias("is_simulated"),
    )


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_events(table(spark, sf_dir, "events"))


def scorecard_signals(featured: DataFrame) -> DataFrame:
    return featured.withColumns(
        {
            "is_fiber": (F.col("InternetService") == "Fiber optic").cast("int"),
            "monthly_over_70": F.col("MonthlyCharges") - 70,
        }
    )


def scorecard_logit() -> Column:
    z = F.lit(SCORECARD_INTERCEPT)
    for signal, weight in SCORECARD.items():
        z = z + F.lit(weight) * F.col(signal)
    return z


def with_scorecard(featured: DataFrame) -> DataFrame:
    """Attach ``churn_probability`` of the fixed scorecard, rounded to four digits."""
    p = rounded(1 / (1 + F.exp(-scorecard_logit())), 4)
    return scorecard_signals(featured).withColumn("churn_probability", p).drop("is_fiber", "monthly_over_70")
