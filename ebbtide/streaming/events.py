"""Event streams: validation, quarantine, landing, alerts and stored counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.risk import at_risk
from ebbtide.session import scratch_path
from ebbtide.vocab import ALERT_EVENTS, EVENT_DELTAS


def known_event() -> Column:
    return F.coalesce(F.col("event_type").isin(list(EVENT_DELTAS)) & F.col("customer_id").isNotNull(), F.lit(False))


def validated(events: DataFrame) -> DataFrame:
    """Valid events with defaults: value 1.0, missing time = processing time."""
    return events.filter(known_event()).withColumns(
        {
            "value": F.coalesce("value", F.lit(1.0)),
            "timestamp": F.coalesce(F.col("timestamp").cast("timestamp"), F.current_timestamp()),
        }
    )


def quarantined(events: DataFrame) -> DataFrame:
    return events.filter(~known_event())


def deduplicated(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Drop repeated deliveries, however late. The state holds one key per event seen: a watermark would bound it, but would
    also drop late events that are no copies."""
    return events.dropDuplicates([key])


def raised_alerts(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Risk-raising events of high-risk customers; ``customers`` is the static scored and decided
    table, reduced to those customers before the join."""
    who = customers.filter(at_risk("risk_level")).select("customer_id", "risk_level", "recommended_action", "urgency")
    raised = events.filter(F.col("event_type").isin(ALERT_EVENTS))
    return raised.join(who, "customer_id")


def store_counts(folder: str, run: str):
    """A foreachBatch sink of event counts per customer and type, a folder for each micro-batch, which a repeated batch
    overwrites. Nothing is kept between batches: running totals are the sums over the folders."""

    def store(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy("customer_id", "event_type").agg(F.count("event_id").alias("n"))
        counted.write.mode("overwrite").parquet(f"{folder}/run={run}/batch_id={batch_id}")

    return store


def running_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of all micro-batches so far: customer_id, event_type, n."""
    stored = spark.read.schema("customer_id string, event_type string, n long").parquet(f"{folder}/run=*/batch_id=*")
    return stored.groupBy("customer_id", "event_type").agg(F.sum("n").alias("n"))


def run_available(
    stream: DataFrame, path: str | None = None, checkpoint: str | None = None, spark: SparkSession | None = None
) -> DataFrame:
    """Process everything that is available now into a table and return the table.

    With a fixed path and checkpoint a restart goes on where the last run ended, exactly once.
    """
    spark = spark or stream.sparkSession
    path = path or scratch_path(spark, "stream")
    job = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start(path)
    )
    job.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
