"""Sources and sinks: every query writes what Spark derives from the given tables and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.functions.numeric import rounded_total
from ebbtide.operators import metrics
from ebbtide.plans import load, medallion, warehouse
from ebbtide.registry.base import money, query
from ebbtide.session import scratch_path
from ebbtide.sources import arrays, files, tables, topics
from ebbtide.streaming import events as ev
from ebbtide.vocab import PACKED_SERVICES


def as_csv(x, df, name):
    path = scratch_path(x.spark, name)
    df.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


@query("a01_csv_scan", "SELECT * FROM raw")
def _(x):
    return files.read_raw_csv(x.spark, as_csv(x, x.raw, "csv"))


@query(
    "a03_tolerant_csv",
    """SELECT * REPLACE (NULLIF(TRIM(TotalCharges), '') AS TotalCharges,
         CASE WHEN PaperlessBilling = 'Yes' THEN 'Yes' END AS PaperlessBilling,
         CASE WHEN gender = 'Male' THEN 'Male' END AS gender,
         CASE WHEN tenure % 2 = 0 THEN tenure END AS tenure) FROM raw""",
)
def _(x):
    """Landing cells with null tokens, padding, quotes and unreadable numbers."""
    dirty = x.raw.withColumns(
        {
            "PaperlessBilling": F.when(F.col("PaperlessBilling") == "No", "null").otherwise(F.lit(" Yes  ")),
            "gender": F.when(F.col("gender") == "Female", "NULL").otherwise(F.col("gender")),
            "tenure": F.when(F.col("tenure") % 2 == 0, F.col("tenure").cast("string")).otherwise("x, y"),
        }
    )
    return files.read_landing_csv(x.spark, as_csv(x, dirty, "landing"))


@query(
    "a04_json_arrays",
    """SELECT customerID AS customer_id, 'contract' AS item, Contract AS value FROM raw
       UNION ALL SELECT customerID, 'payment', PaymentMethod FROM raw""",
)
def _(x):
    items = F.array(
        F.struct(F.col("customerID").alias("customer_id"), F.lit("contract").alias("item"), F.col("Contract").alias("value")),
        F.struct(F.col("customerID").alias("customer_id"), F.lit("payment").alias("item"), F.col("PaymentMethod").alias("value")),
    )
    path = scratch_path(x.spark, "json")
    x.raw.select(F.to_json(items)).write.text(path)
    return files.read_json_array(x.spark, path, "customer_id string, item string, value string", whole_file=False)


@query(
    "a04_json_array_files",
    """SELECT customerID AS customer_id, Contract || ' "}] {[' AS note, tenure AS months, Contract AS contract, PaymentMethod AS payment FROM raw""",
)
def _(x):
    """Files of one array each, with nested objects and strings that hold braces, brackets and quotes, read by byte ranges."""
    path = scratch_path(x.spark, "arrays")
    note = F.concat("Contract", F.lit(' "}] {[')).alias("note")
    terms = F.array(F.struct(F.col("Contract").alias("contract")), F.struct(F.col("PaymentMethod").alias("contract"))).alias("terms")
    arrays.write_array_files(x.raw.select(F.col("customerID").alias("customer_id"), note, F.struct(F.col("tenure").alias("months"), terms).alias("held")), path)
    rows = arrays.read_array_files(x.spark, path, "customer_id string, note string, held struct<months: int, terms: array<struct<contract: string>>>")
    terms = F.col("held.terms.contract")
    return rows.select("customer_id", "note", "held.months", terms[0].alias("contract"), terms[1].alias("payment"))


@query("a05_parquet", "SELECT event_id, customer_id, event_type, timestamp, value FROM ev")
def _(x):
    path = scratch_path(x.spark, "parquet")
    x.events.write.parquet(path)
    return x.spark.read.parquet(path).select("event_id", "customer_id", "event_type", "timestamp", "value")


@query(
    "a06_load_past_bad_lines",
    """SELECT customerID, CASE WHEN CAST(SUBSTR(customerID, 2) AS BIGINT) % 9 = 0 THEN 'quarantined' ELSE 'loaded' END AS outcome,
         CASE WHEN CAST(SUBSTR(customerID, 2) AS BIGINT) % 9 = 0 THEN NULL ELSE tenure END AS tenure FROM raw""",
)
def _(x):
    k = F.substring("customerID", 2, 8).cast("long")
    dirty = x.raw.withColumn("tenure", F.when(k % 9 == 0, "oops").otherwise(F.col("tenure").cast("string")))
    good, bad = files.copy_csv(x.spark, as_csv(x, dirty, "copy"))
    return good.select("customerID", F.lit("loaded").alias("outcome"), "tenure").unionByName(
        bad.select("customerID", F.lit("quarantined").alias("outcome"), F.lit(None).cast("int").alias("tenure"))
    )


@query("a07_read_or_build", "SELECT customerID, tenure_cohort, total_active_services, recent_events_count FROM gold")
def _(x):
    path = scratch_path(x.spark, "gold")
    tables.read_or_build(x.spark, path, lambda: x.gold)
    return tables.read_or_build(x.spark, path, lambda: x.gold.limit(0)).select(
        "customerID", "tenure_cohort", "total_active_services", "recent_events_count"
    )


# --- topics ---------------------------------------------------------------------------------------------
def topic_of(x):
    """The events as a topic, in time order."""
    path = scratch_path(x.spark, "topic")
    rows = x.events.select(
        "customer_id", "event_type", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "value",
        "is_simulated", "event_id",
    )
    topics.produce(rows.orderBy("timestamp", "event_id").drop("event_id"), path)
    return path


_TOPIC = ", topic AS (SELECT ROW_NUMBER() OVER (ORDER BY timestamp, event_id) - 1 AS \"offset\", customer_id, event_type, value FROM ev)"


@query("a08_topic_from_offset", _TOPIC + 'SELECT * FROM topic WHERE "offset" >= 300')
def _(x):
    return topics.read_topic(x.spark, topic_of(x), topics.EVENT, 300).select("offset", "customer_id", "event_type", "value")


@query("m14_committed_reader", _TOPIC + 'SELECT * FROM topic')
def _(x):
    """A reader that takes runs of offsets, commits each, and goes on in a second call; runs are folders named by their first offset."""
    path, out = topic_of(x), scratch_path(x.spark, "read")

    def handle(messages, first, end):
        messages.write.mode("overwrite").parquet(f"{out}/first={first}")

    for _ in range(2):
        topics.process_new(x.spark, path, topics.EVENT, "scores", handle, most=4000)
    return x.spark.read.parquet(f"{out}/*").select("offset", "customer_id", "event_type", "value")


@query("m15_stream_from_offset", _TOPIC + 'SELECT * FROM topic WHERE "offset" >= 300')
def _(x):
    """A stream that starts at an offset, and its restart, which finds nothing new."""
    path, out, checkpoint = topic_of(x), scratch_path(x.spark, "streamed"), scratch_path(x.spark, "stream-checkpoint")
    for _ in range(2):
        done = ev.run_available(topics.stream_from(x.spark, path, topics.EVENT, 300), out, checkpoint, x.spark)
    return done.select("offset", "customer_id", "event_type", "value")


@query("a11_topic_count", "SELECT COUNT(*) AS n FROM ev")
def _(x):
    return topics.topic_count(x.spark, topic_of(x))


@query("a12_purge", "SELECT COUNT(*) AS n FROM raw")
def _(x):
    path = topic_of(x)
    topics.purge(x.spark, path)
    topics.produce(x.raw.select(F.col("customerID").alias("customer_id"), "tenure"), path)
    return topics.topic_count(x.spark, path)


@query("a13_latest_messages", _TOPIC + 'SELECT * FROM topic ORDER BY "offset" DESC LIMIT 20')
def _(x):
    return topics.latest(x.spark, topic_of(x), topics.EVENT, 20).select("offset", "customer_id", "event_type", "value")


@query("c16_unwrap_messages", "SELECT customer_id, event_type, value, CASE WHEN event_id % 2 = 0 THEN customer_id END AS key FROM ev")
def _(x):
    path = scratch_path(x.spark, "mixed")
    even = F.col("event_id") % 2 == 0
    columns = x.events.select("customer_id", "event_type", "value", "event_id")
    topics.produce(columns.filter(even).drop("event_id"), path)
    bare = columns.filter(~even).select(F.to_json(F.struct("customer_id", "event_type", "value")).alias("value"))
    bare.write.text(topics.delivery(path))
    return topics.read_topic(x.spark, path, topics.EVENT).select("customer_id", "event_type", "value", "key")


# --- tables ----------------------------------------------------------------------------------------------
@query("a14_overwrite", "SELECT customer_id, recommended_action FROM decided")
def _(x):
    path = scratch_path(x.spark, "decisions")
    tables.load_table(x.decided.select("customer_id", F.lit("old").alias("recommended_action")), path)
    tables.load_table(x.decided.select("customer_id", "recommended_action"), path)
    return x.spark.read.parquet(path)


@query(
    "a15_load_manifest",
    """SELECT * FROM (SELECT 'bronze_customers_raw' AS table_name, 'BRONZE' AS tier, COUNT(*) AS record_count FROM landing
       UNION ALL SELECT 'bronze_events_raw', 'BRONZE', COUNT(*) FROM ev UNION ALL SELECT 'silver_customers_clean', 'SILVER', COUNT(*) FROM silver
       UNION ALL SELECT 'silver_events_clean', 'SILVER', COUNT(*) FROM ev UNION ALL SELECT 'gold_customer_features_daily', 'GOLD', COUNT(*) FROM silver
       UNION ALL SELECT 'silver_quality', 'SILVER', 1)""",
)
def _(x):
    folder = scratch_path(x.spark, "medallion")
    medallion.run(x.landing, x.events, folder, "arrival")
    return x.spark.read.parquet(f"{folder}/audit_loads").select("table_name", "tier", "record_count")


@query(
    "e13_medallion_run",
    """SELECT tier, COUNT(*) AS n_tables, CAST(SUM(n) AS BIGINT) AS records FROM (
         SELECT 'bronze' AS tier, COUNT(*) AS n FROM landing UNION ALL SELECT 'bronze', COUNT(*) FROM ev
         UNION ALL SELECT 'silver', COUNT(*) FROM silver UNION ALL SELECT 'silver', COUNT(*) FROM ev UNION ALL SELECT 'silver', 1
         UNION ALL SELECT 'gold', COUNT(*) FROM silver) GROUP BY tier""",
)
def _(x):
    summary = medallion.run(x.landing, x.events, scratch_path(x.spark, "medallion"), "arrival")
    return summary.groupBy("tier").agg(F.count("*").alias("n_tables"), F.sum("records").alias("records"))


@query("a16_replace_and_append", "SELECT customer_id, COUNT(*) AS n FROM (SELECT customer_id FROM ev UNION ALL SELECT customer_id FROM ev) GROUP BY 1")
def _(x):
    path = scratch_path(x.spark, "appended")
    rows = x.events.select("customer_id")
    tables.load_table(rows, path, "replace")
    tables.load_table(rows, path, "append")
    return x.spark.read.parquet(path).groupBy("customer_id").agg(F.count("*").alias("n"))


@query(
    "a17_load_all",
    """SELECT 'raw_customers' AS table_name, COUNT(*) AS rows_loaded FROM raw UNION ALL SELECT 'raw_customer_events', COUNT(*) FROM ev
       UNION ALL SELECT 'analytics_customer_features', COUNT(*) FROM gold UNION ALL SELECT 'ml_churn_predictions', COUNT(*) FROM valued
       UNION ALL SELECT 'reporting_retention_actions', COUNT(*) FROM decided""",
)
def _(x):
    return load.load_all(x.house, scratch_path(x.spark, "warehouse"))


@query(
    "a17_sequence_keys",
    "SELECT PRINTF('pred-%05d', ROW_NUMBER() OVER (ORDER BY customerID) - 1) AS prediction_id, customerID AS customer_id FROM valued",
)
def _(x):
    keyed = warehouse.with_sequence_key(x.house.predictions.select("customer_id"), [F.asc("customer_id")], "pred", "prediction_id")
    return keyed.select("prediction_id", "customer_id")


@query(
    "a18_column_defaults",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1.0::DOUBLE ELSE value END AS event_value, TRUE AS is_simulated,
         TRUE AS has_ingest_time FROM ev""",
)
def _(x):
    sparse = x.events.select(
        "event_id", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("event_value"),
        F.col("timestamp").alias("event_timestamp"),
    )
    defaults = {k: v for k, v in tables.event_defaults().items() if k != "event_id"}
    filled = tables.with_defaults(sparse.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")), defaults)
    return filled.select(
        "event_id", "event_value", "is_simulated", F.col("ingested_at").isNotNull().alias("has_ingest_time")
    )


@query(
    "a19_seed_customers",
    """SELECT customerID AS customer_id, gender, SeniorCitizen AS senior_citizen, Partner AS partner, Dependents AS dependents, tenure FROM clean""",
)
def _(x):
    return tables.seed_customers(x.clean)[0]


_JSON = " || ',' || ".join(f"""'"{c}":"' || {c} || '"'""" for c in PACKED_SERVICES)


@query(
    "a19_seed_subscriptions",
    f"""SELECT customerID AS customer_id, Contract AS contract, PaymentMethod AS payment_method, PaperlessBilling AS paperless_billing,
          MonthlyCharges AS monthly_charges, COALESCE(TotalCharges, 0.0) AS total_charges, InternetService AS internet_service,
          PhoneService AS phone_service, '{{' || {_JSON} || '}}' AS services, Churn AS churn FROM clean""",
)
def _(x):
    return tables.seed_customers(x.clean)[1]


_AUC = """, ranked AS (SELECT Churn, RANK() OVER (ORDER BY churn_probability) + (COUNT(*) OVER (PARTITION BY churn_probability) - 1) / 2.0::DOUBLE AS r FROM scored),
    auc AS (SELECT (SUM(r) FILTER (Churn = 1) - SUM(Churn) * (SUM(Churn) + 1) / 2.0::DOUBLE) / (SUM(Churn) * (COUNT(*) - SUM(Churn))) AS a FROM ranked)"""


@query(
    "a20_model_version",
    _AUC + f"""SELECT 'scorecard-v1' AS model_version, 'scorecard' AS base_model, {money('a', 4)} AS roc_auc, 'production' AS stage FROM auc""",
)
def _(x):
    """Metadata of the scorecard, measured on the customers, through its JSON file."""
    measured = metrics.ranking_metrics(x.scored, "churn_probability", "Churn")
    path = scratch_path(x.spark, "model-meta")
    files.write_report(
        measured.select(
            F.lit("scorecard-v1").alias("model_version"), F.lit("scorecard").alias("base_model"),
            F.lit("none").alias("calibration"), F.struct("roc_auc", "pr_auc").alias("val_metrics"),
        ),
        path, "json",
    )
    return tables.model_version_row(x.spark, path).select("model_version", "base_model", "roc_auc", "stage")


@query("a21_seed_predictions", "SELECT customer_id, churn_probability, risk_level, 'scorecard-v1' AS model_version FROM decided")
def _(x):
    return tables.seed_decisions(x.decided.withColumn("risk_level", F.nullif("risk_level", F.lit("HIGH"))), "scorecard-v1")[0]


@query(
    "a21_seed_risk_scores",
    """SELECT customer_id, CAST(NULL AS DOUBLE) AS previous_probability, churn_probability AS new_probability,
         CAST(NULL AS DOUBLE) AS risk_change, risk_level, revenue_at_risk FROM decided""",
)
def _(x):
    return tables.seed_decisions(x.decided, "scorecard-v1")[1]


@query(
    "a21_seed_recommendations",
    "SELECT customer_id, recommended_action, urgency, reason, priority_score, estimated_net_value FROM decided",
)
def _(x):
    return tables.seed_decisions(x.decided, "scorecard-v1")[2]


@query("a23_report_sink", f"SELECT risk_level, COUNT(*) AS n, {money('SUM(CAST(revenue_at_risk AS DECIMAL(18,6)))')} AS exposed FROM valued GROUP BY risk_level")
def _(x):
    path = scratch_path(x.spark, "report")
    report = x.valued.groupBy("risk_level").agg(
        F.count("*").alias("n"), rounded_total(F.sum(F.col("revenue_at_risk").cast("decimal(18,6)")), 2).alias("exposed")
    )
    files.write_report(report, path, "csv")
    return x.spark.read.schema("risk_level string, n long, exposed double").option("header", True).csv(path)


