"""Streaming jobs over the event table, run to the end of what is available."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.operators.clean import to_bronze_events, to_silver_events
from ebbtide.operators.fold import unknown_customer_events
from ebbtide.plans.warehouse import impact_of
from ebbtide.registry.base import also, money, query
from ebbtide.registry.ordering import _DELTAS
from ebbtide.registry.warehouse import _ALERTS, _IMPACT
from ebbtide.session import scratch_path, written
from ebbtide.sources import topics
from ebbtide.sources.projection import customer_events
from ebbtide.sources.tables import table_stream
from ebbtide.streaming import events as ev
from ebbtide.streaming import risk


def stream_of(x):
    """The event table, one file or a folder of part files, as a stream of customer events."""
    return customer_events(table_stream(x.spark, f"{x.sf_dir}/events.parquet", x.table("events").schema, per_trigger=1))


def scored_customers(x):
    """Stored once, as every micro-batch reads it."""
    table = x.valued.withColumnRenamed("customerID", "customer_id")
    return written(table.select("customer_id", "churn_probability", "risk_level", *risk.DECISION_SIGNALS), "scored")


def updates(x, version="scorecard-v1"):
    return risk.risk_updates(ev.validated(stream_of(x)), scored_customers(x), version)


def folded(x, version="scorecard-v1"):
    places = [scratch_path(x.spark, n) for n in ("folded-risk", "stream-checkpoint")]
    return risk.run_folded(ev.validated(stream_of(x)), scored_customers(x), *places, model_version=version)


_LEVEL = "CASE WHEN {p} < 0.5 THEN 'LOW' WHEN {p} < 0.7 THEN 'MEDIUM' WHEN {p} < 0.85 THEN 'HIGH' ELSE 'CRITICAL' END"
_UPDATES = _DELTAS + f""", moved AS (
    SELECT event_id, r.customer_id, event_type, CAST(ROUND(p_before, 4) AS DOUBLE) AS previous_probability,
      CAST(ROUND(p_after, 4) AS DOUBLE) AS new_probability, CAST(ROUND(p_after - p_before, 4) AS DOUBLE) AS risk_change,
      {_LEVEL.format(p='p_before')} AS previous_risk_level, {_LEVEL.format(p='p_after')} AS new_risk_level,
      {money('CAST(p_after AS DOUBLE) * r.estimated_clv')} AS revenue_at_risk, v.* EXCLUDE (estimated_clv, churn_probability, revenue_at_risk, risk_level, priority_score),
      r.estimated_clv FROM risk_path r JOIN valued v ON v.customerID = r.customer_id),
  decided_moves AS (SELECT event_id, customer_id, event_type, previous_probability, new_probability, risk_change, previous_risk_level,
      new_risk_level, revenue_at_risk, CASE WHEN new_risk_level = 'LOW' THEN 'no_intervention'
        WHEN new_risk_level = 'CRITICAL' AND estimated_clv >= 500 THEN 'account_manager_contact'
        WHEN PaymentMethod = 'Electronic check' THEN 'payment_assistance'
        WHEN Contract = 'Month-to-month' AND tenure < 12 THEN 'onboarding_assistance'
        WHEN Contract = 'Month-to-month' THEN 'plan_optimization'
        WHEN InternetService <> 'No' AND TechSupport <> 'Yes' THEN 'technical_support_intervention'
        WHEN InternetService <> 'No' AND OnlineSecurity <> 'Yes' THEN 'feature_education'
        WHEN estimated_clv >= 500 THEN 'loyalty_reward' ELSE 'personalized_discount' END AS recommended_action FROM moved)
"""
_SHOWN = [
    "event_id", "customer_id", "event_type", "previous_probability", "new_probability", "risk_change",
    "previous_risk_level", "new_risk_level", "revenue_at_risk", "recommended_action",
]


@query("m01_process_available", _UPDATES + "SELECT new_risk_level, COUNT(*) AS n FROM decided_moves GROUP BY 1")
def _(x):
    done = ev.run_available(updates(x))
    return done.groupBy("new_risk_level").agg(F.count("*").alias("n"))


@query("m02_risk_updates", _UPDATES + f"SELECT {', '.join(_SHOWN)} FROM decided_moves")
def _(x):
    """The micro-batches folded in ranges, with the state in stored tables."""
    return folded(x).select(*_SHOWN)


@query("m16_keyed_state_updates", _UPDATES + f"SELECT {', '.join(_SHOWN)} FROM decided_moves")
def _(x):
    """The same updates from one streaming plan with keyed state."""
    return ev.run_available(updates(x)).select(*_SHOWN)


@query("m05_quarantine", "SELECT event_id, customer_id, event_type FROM ev WHERE event_type IN ('login', 'purchase')")
def _(x):
    """Logins arrive with an unknown type here, purchases without a customer."""
    broken = stream_of(x).withColumns(
        {
            "event_type": F.when(F.col("event_type") == "login", "log-in").otherwise(F.col("event_type")),
            "kept_id": F.col("customer_id"),
            "customer_id": F.when(F.col("event_type") != "purchase", F.col("customer_id")),
        }
    )
    bad = ev.run_available(ev.quarantined(broken))
    kind = F.when(F.col("event_type") == "log-in", "login").otherwise(F.col("event_type"))
    return bad.select("event_id", F.col("kept_id").alias("customer_id"), kind.alias("event_type"))


@query(
    "m06_state_seeding",
    _DELTAS + """SELECT customer_id, CAST(ARG_MIN(p0, event_id) AS DOUBLE) AS seeded_probability FROM path GROUP BY customer_id""",
)
def _(x):
    """The first update of every customer starts from the scored table."""
    return folded(x).groupBy("customer_id").agg(
        F.min_by("previous_probability", F.struct("timestamp", "event_id")).alias("seeded_probability")
    )


@query("m07_output_topic", _UPDATES + "SELECT customer_id, customer_id AS key, event_type, new_probability, recommended_action FROM decided_moves")
def _(x):
    path = scratch_path(x.spark, "risk-topic")
    job = (
        topics.messages(updates(x)).writeStream.format("text")
        .option("checkpointLocation", scratch_path(x.spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start(path)
    )
    job.awaitTermination()
    return topics.read_topic(x.spark, path, topics.RISK_UPDATE).select(
        "customer_id", "key", "event_type", "new_probability", "recommended_action"
    )


@query(
    "m08_dual_tables",
    _UPDATES + """SELECT event_id, value, new_probability, risk_change, new_risk_level AS risk_level FROM decided_moves JOIN ev USING (event_id)""",
)
def _(x):
    """Both tables of the fan-out, joined back on the event."""
    folder = scratch_path(x.spark, "fanout")
    job = (
        updates(x).writeStream.foreachBatch(risk.store_updates(folder, "once"))
        .option("checkpointLocation", scratch_path(x.spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    events = x.spark.read.parquet(f"{folder}/customer_events").select("event_id", "value")
    scores = x.spark.read.parquet(f"{folder}/risk_scores")
    return scores.join(events, "event_id").select("event_id", "value", "new_probability", "risk_change", "risk_level")


@query("m10_streamed_silver", "SELECT event_id, customer_id, event_type, STRFTIME(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, value FROM ev")
def _(x):
    done = ev.run_available(to_silver_events(to_bronze_events(stream_of(x))))
    return done.select("event_id", "customer_id", "event_type", "timestamp", "value")


@query("m11_streamed_alerts", f"SELECT customer_id, event_type, risk_level, recommended_action, urgency FROM ({_ALERTS})")
def _(x):
    done = ev.run_available(ev.raised_alerts(stream_of(x), x.decided))
    return done.select("customer_id", "event_type", "risk_level", "recommended_action", "urgency")


@query("m12_streamed_impact", _IMPACT)
def _(x):
    """The incident report over the counts that the stream stored."""
    folder = scratch_path(x.spark, "incident-counts")
    job = (
        stream_of(x).writeStream.foreachBatch(ev.store_counts(folder, "once"))
        .option("checkpointLocation", scratch_path(x.spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return impact_of(ev.running_counts(x.spark, folder), x.house.predictions)


@query("m13_deduplicated_stream", "SELECT event_id, customer_id FROM ev")
def _(x):
    """Repeated deliveries: every third event arrives twice."""
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("event_id") % 3 == 0, 2).otherwise(1)))
    twice = ev.validated(stream_of(x)).withColumn("copy", copies)
    return ev.run_available(ev.deduplicated(twice)).select("event_id", "customer_id")


also("a10_produce_stream", "m07_output_topic")
also("a22_fan_out_tables", "m08_dual_tables")


@query(
    "g12_stream_static_lookup",
    """SELECT event_id, customer_id, risk_level, TRUE AS known FROM ev JOIN valued ON customerID = customer_id WHERE risk_level <> 'LOW'
       UNION ALL SELECT event_id, ev.customer_id, NULL, FALSE FROM ev LEFT JOIN valued ON customerID = ev.customer_id AND risk_level <> 'LOW' WHERE customerID IS NULL""",
)
def _(x):
    """Events against the scored customers above LOW: matches and rejects, each one stream."""
    who = scored_customers(x).filter("risk_level <> 'LOW'").select("customer_id", "risk_level")
    known = ev.run_available(stream_of(x).join(who, "customer_id").select("event_id", "customer_id", "risk_level"))
    unknown = ev.run_available(unknown_customer_events(stream_of(x), who).select("event_id", "customer_id"))
    return known.withColumn("known", F.lit(True)).unionByName(
        unknown.withColumns({"risk_level": F.lit(None).cast("string"), "known": F.lit(False)})
    )
