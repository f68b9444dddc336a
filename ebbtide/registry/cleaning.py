"""Bronze, silver and gold, and the row-wise features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.functions.numeric import flag, looked_up, rounded
from ebbtide.operators import clean as c
from ebbtide.operators import features as f
from ebbtide.registry.base import money, query
from ebbtide.vocab import CATEGORICAL, RAW_COLUMNS

_CELLS = ", ".join(f"COALESCE(CAST({col} AS VARCHAR), '\\N')" for col in RAW_COLUMNS)


@query(
    "c01_bronze_customers",
    "SELECT customerID, tenure, TotalCharges, arrival, 'landing' AS _bronze_source_file FROM landing",
)
def _(x):
    return c.to_bronze_customers(x.landing, "landing").select(
        "customerID", "tenure", "TotalCharges", "arrival", "_bronze_source_file"
    )


@query("c02_batch_id", None)
def _(x):
    """One batch id for the whole load."""
    return c.to_bronze_customers(x.raw, "landing").groupBy("_bronze_batch_id").agg(F.count("*").alias("n"))


@query(
    "c03_record_hash",
    f"SELECT customerID, arrival, MD5(CONCAT_WS(CHR(31), {_CELLS})) AS record_hash FROM landing",
)
def _(x):
    return x.landing.select("customerID", "arrival", c.record_hash(RAW_COLUMNS).alias("record_hash"))


@query(
    "c04_bronze_events",
    "SELECT event_id, customer_id, event_type, value, 'streaming_event_bus' AS _bronze_source_file FROM ev",
)
def _(x):
    return c.to_bronze_events(x.events).select("event_id", "customer_id", "event_type", "value", "_bronze_source_file")


@query("c05_clean_totals", "SELECT customerID, TotalCharges FROM clean")
def _(x):
    return x.clean.select("customerID", "TotalCharges")


@query(
    "c06_clean_flags",
    """SELECT customerID, arrival, SeniorCitizen, CAST(COALESCE(Churn = 'Yes', FALSE) AS INTEGER) AS Churn,
         CASE WHEN tenure = '0' THEN COALESCE(TRY_CAST(TRIM(TotalCharges) AS DOUBLE), 0.0) ELSE TRY_CAST(TRIM(TotalCharges) AS DOUBLE) END AS TotalCharges
       FROM landing""",
)
def _(x):
    """Over the dirty feed, whose tenure is text: only a true zero counts as a new customer."""
    zero = F.when(F.col("tenure") == "0", 0).otherwise(1)
    return c.clean_raw(x.landing.withColumn("tenure", zero)).select(
        "customerID", "arrival", "SeniorCitizen", "Churn", "TotalCharges"
    )


@query(
    "c07_silver_keep_last",
    "SELECT * FROM landing QUALIFY ROW_NUMBER() OVER (PARTITION BY customerID ORDER BY arrival DESC) = 1",
)
def _(x):
    return c.keep_last(x.landing, "customerID", "arrival")


@query("c08_silver_totals", f"SELECT customerID, {money('TotalCharges', 4)} AS TotalCharges FROM silver_all")
def _(x):
    return c.standardise(c.keep_last(x.landing, "customerID", "arrival")).select(
        "customerID", rounded("TotalCharges", 4).alias("TotalCharges")
    )


@query("c09_silver_numbers", "SELECT customerID, SeniorCitizen, tenure, MonthlyCharges FROM silver_all")
def _(x):
    return c.standardise(c.keep_last(x.landing, "customerID", "arrival")).select(
        "customerID", "SeniorCitizen", "tenure", "MonthlyCharges"
    )


@query("c10_label_map", "SELECT customerID, arrival, CAST(LOWER(TRIM(Churn)) IN ('yes', '1', 'true') AS INTEGER) AS Churn_Numeric FROM landing")
def _(x):
    return x.landing.select("customerID", "arrival", c.label_value("Churn").alias("Churn_Numeric"))


@query("c11_trimmed_categories", f"SELECT customerID, {', '.join(CATEGORICAL)} FROM silver")
def _(x):
    return x.silver.select("customerID", *CATEGORICAL)


@query("c12_valid_customers", f"SELECT customerID, tenure, MonthlyCharges, {money('TotalCharges', 4)} AS TotalCharges, Churn_Numeric, 1.0::DOUBLE AS _silver_quality_score FROM silver")
def _(x):
    return x.silver.select(
        "customerID", "tenure", "MonthlyCharges", rounded("TotalCharges", 4).alias("TotalCharges"), "Churn_Numeric",
        "_silver_quality_score",
    )


@query(
    "c13_silver_quality",
    """SELECT (SELECT COUNT(*) FROM landing) AS raw_records, (SELECT COUNT(*) FROM silver_all) AS deduplicated_records,
         (SELECT COUNT(*) FROM silver_all) - (SELECT COUNT(*) FROM silver) AS invalid_records_dropped,
         (SELECT COUNT(*) FROM silver) AS clean_records, 'PASSED' AS quality_status""",
)
def _(x):
    return c.silver_quality(x.landing, "arrival")


@query(
    "c14_silver_events",
    "SELECT event_id, customer_id, STRFTIME(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, event_type, COALESCE(value, 1.0) AS value FROM ev",
)
def _(x):
    shouted = x.events.withColumn("event_type", F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")))
    return c.to_silver_events(c.to_bronze_events(shouted)).select("event_id", "customer_id", "timestamp", "event_type", "value")


@query(
    "c17_rename",
    "SELECT customerID AS customer_id, Contract AS contract, PaymentMethod AS payment_method, Churn AS churn_label FROM raw",
)
def _(x):
    return x.house.customers.select("customer_id", "contract", "payment_method", "churn_label")


# --- row-wise features --------------------------------------------------------------------------------
_FLAGS = "has_phone, has_multiple_lines, has_online_security, has_online_backup, has_device_protection, has_tech_support, has_streaming_tv, has_streaming_movies"


def feature_query(name: str, columns: str):
    @query(name, f"SELECT customerID, {columns} FROM featured")
    def _(x):
        return x.featured.select("customerID", *[col.strip() for col in columns.split(",")])


feature_query("d01_service_flags", _FLAGS)
feature_query("d02_has_internet", "has_internet")
feature_query("d03_has_streaming", "has_streaming")
feature_query("d04_total_services", "total_services")
feature_query("d05_service_adoption", "service_adoption_score")
feature_query("d06_average_charge", "average_charge_per_month")
feature_query("d07_month_to_month", "is_month_to_month, contract_risk_indicator")
feature_query("d08_long_term_contract", "is_long_term_contract")
feature_query("d09_payment_risk", "payment_risk_indicator")
feature_query("d10_tenure_risk", "tenure_risk_indicator")
feature_query("d12_featured_projection", ", ".join([*f.FEATURED_COLUMNS, "Churn"]))


# --- gold ------------------------------------------------------------------------------------------------
def gold_query(name: str, columns: list[str], ratios: list[str] = ()):
    shown = ", ".join([*columns, *[f"{money(r, 6)} AS {r}" for r in ratios]])

    @query(name, f"SELECT customerID, {shown} FROM gold")
    def _(x):
        return x.gold.select("customerID", *columns, *[rounded(r, 6).alias(r) for r in ratios])


gold_query("e01_tenure_cohort", ["tenure_cohort"])
gold_query("e02_charge_history", [], ["avg_monthly_charges_history"])
gold_query("e03_charge_discrepancy", [], ["charge_discrepancy"])
gold_query("e04_charge_ratio", [], ["charge_ratio"])
gold_query("e05_security_bundle", ["security_bundle_score"])
gold_query("e06_streaming_bundle", ["streaming_bundle_score"])
gold_query("e07_active_services", ["total_active_services"])
gold_query("e08_contract_risk_index", ["contract_risk_index"])
gold_query("e09_gold_flags", ["is_high_risk_payment", "is_fiber_without_techsupport"])
gold_query(
    "e10_event_counts",
    ["complaint_count", "support_ticket_count", "payment_failed_count", "login_count", "recent_events_count"],
)
gold_query("e11_estimated_clv", ["estimated_clv"])


@query("e12_feature_version", "SELECT 'v2.0' AS _gold_feature_version, COUNT(*) AS n, COUNT(*) AS stamped FROM gold")
def _(x):
    return x.gold.groupBy("_gold_feature_version").agg(F.count("*").alias("n"), F.count("_gold_feature_timestamp").alias("stamped"))


@query(
    "g01_customers_with_events",
    """SELECT customerID, COALESCE(recent_events_count, 0) AS recent_events_count, COALESCE(complaint_count, 0) AS complaint_count
       FROM silver LEFT JOIN ev_counts ON customer_id = customerID""",
)
def _(x):
    return f.to_gold(x.silver, x.events).select("customerID", "recent_events_count", "complaint_count")


@query(
    "g16_code_to_label",
    """SELECT customerID, CASE Contract WHEN 'Month-to-month' THEN 3 WHEN 'One year' THEN 2 WHEN 'Two year' THEN 1 ELSE 2 END AS contract_risk,
         CAST(Churn = 1 AS INTEGER) AS churned FROM clean""",
)
def _(x):
    return x.clean.select(
        "customerID", looked_up("Contract", {"Month-to-month": 3, "One year": 2, "Two year": 1}, 2).alias("contract_risk"),
        flag(F.col("Churn") == 1).alias("churned"),
    )


# --- scalar functions, one query per family --------------------------------------------------------------
@query(
    "l01_string_hash_cast",
    """SELECT customerID, arrival, LOWER(TRIM(Contract)) AS contract, STARTS_WITH(TRIM(Contract), 'Month') AS monthly,
         REPLACE(PaymentMethod, ' ', '_') AS payment, MD5(customerID) AS md, SUBSTR(SHA256(customerID), 1, 12) AS sha,
         TRY_CAST(TRIM(TotalCharges) AS DOUBLE) AS total FROM landing""",
)
def _(x):
    from ebbtide.functions.numeric import number_or_null

    return x.landing.select(
        "customerID", "arrival", F.lower(F.trim("Contract")).alias("contract"),
        F.trim("Contract").startswith("Month").alias("monthly"),
        F.replace("PaymentMethod", F.lit(" "), F.lit("_")).alias("payment"), F.md5("customerID").alias("md"),
        F.substring(F.sha2("customerID", 256), 1, 12).alias("sha"), number_or_null("TotalCharges").alias("total"),
    )


@query(
    "l02_dates_and_math",
    f"""SELECT event_id, STRFTIME(timestamp, '%Y-%m-%d') AS day, timestamp + INTERVAL 24 HOUR AS next_day,
         {money('LN(value + 1)', 6)} AS ln_value, LEAST(10.0, GREATEST(0.5, value)) AS clipped, ABS(value - 10) AS distance,
         COALESCE(NULLIF(event_type, 'login'), 'none') AS raised FROM ev""",
)
def _(x):
    v = F.col("value")
    return x.events.select(
        "event_id", F.date_format("timestamp", "yyyy-MM-dd").alias("day"),
        (F.col("timestamp") + F.expr("interval 24 hours")).alias("next_day"),
        rounded(F.ln(v + 1), 6).alias("ln_value"), F.least(F.lit(10.0), F.greatest(F.lit(0.5), v)).alias("clipped"),
        F.abs(v - 10).alias("distance"), F.coalesce(F.nullif("event_type", F.lit("login")), F.lit("none")).alias("raised"),
    )


@query(
    "l03_json_map_array",
    """SELECT event_id, CAST(REGEXP_EXTRACT(props, '([0-9]+)', 1) AS INTEGER) AS k,
         '{"customer_id":"' || ev.customer_id || '","event_type":"' || ev.event_type || '"}' AS message,
         CASE ev.event_type WHEN 'complaint' THEN 'raised' WHEN 'payment_failed' THEN 'raised' ELSE 'other' END AS kind
       FROM ev JOIN events USING (event_id)""",
)
def _(x):
    events = x.events.join(x.table("events").select("event_id", "props"), "event_id")
    return events.select(
        "event_id", F.from_json("props", "k int").getField("k").alias("k"),
        F.to_json(F.struct("customer_id", "event_type")).alias("message"),
        looked_up("event_type", {"complaint": "raised", "payment_failed": "raised"}, "other").alias("kind"),
    )
