"""Tables on storage: read or build, replace or append, load manifest, operational tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.risk import risk_level
from ebbtide.vocab import ID, PACKED_SERVICES, TARGET


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored table if there is one, else build and store it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    build().write.mode("overwrite").parquet(path)  # a folder that a failed build left without data
    return spark.read.parquet(path)


def table_stream(spark: SparkSession, path: str, schema, per_trigger: int | None = None) -> DataFrame:
    """A stored table as a stream of its files, be it a folder of part files or a single file."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    if file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(file).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", file.getName()).parquet(str(file.getParent().toString()))


def _stored_rows(spark: SparkSession, path: str) -> int:
    """Row count of a stored table from the file footers; 0 when there is none."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return 0
        raise


def load_table(df: DataFrame, path: str, if_exists: str = "replace") -> int:
    """Write a table and return the rows written.

    The rows are counted from the written footers. An observation would count them during the
    write, but once a session has used one, Spark 4.1 can no longer ship logistic models to its
    tasks (their training summary holds the session, and the session then an object that cannot
    be serialised).
    """
    mode = {"replace": "overwrite", "append": "append"}[if_exists]
    spark = df.sparkSession
    before = _stored_rows(spark, path) if if_exists == "append" else 0
    df.write.mode(mode).parquet(path)
    return _stored_rows(spark, path) - before


def store_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """A catalog table bucketed and sorted by ``key``: tables with equal buckets join and
    aggregate on the key without a shuffle. Size ``buckets`` for 100-500 MB each."""
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def load_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "replace", **options: str) -> None:
    """Write to an operational database; ``numPartitions`` bounds the parallel connections."""
    mode = {"replace": "overwrite", "append": "append"}[if_exists]
    df.write.mode(mode).options(**options).jdbc(url, table)


def store_with_manifest(df: DataFrame, path: str, table: str, tier: str, manifest: str) -> int:
    """Overwrite a tier table and append one line to the load manifest."""
    rows = load_table(df, path)
    spark = df.sparkSession
    line = spark.range(1).select(
        F.lit(table).alias("table_name"),
        F.lit(tier).alias("tier"),
        F.lit(rows).cast("long").alias("record_count"),
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        F.current_timestamp().alias("ingested_at"),
        F.substring(F.sha2(F.concat(F.uuid(), F.lit(table)), 256), 1, 12).alias("batch_id"),
    )
    line.write.mode("append").parquet(manifest)
    return rows


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Declared column defaults: fill nulls, add absent columns."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), d) if c in df.columns else d for c, d in defaults.items()}
    )


# Declared defaults of the warehouse tables.
def event_defaults() -> dict[str, Column]:
    return {
        "event_id": F.uuid(), "event_timestamp": F.current_timestamp(), "event_value": F.lit(1.0),
        "is_simulated": F.lit(True), "ingested_at": F.current_timestamp(),
    }


def action_defaults() -> dict[str, Column]:
    return {"action_id": F.uuid(), "action_status": F.lit("RECOMMENDED"), "created_at": F.current_timestamp()}


# --- operational tables -------------------------------------------------------------------------------
def seed_customers(clean: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Wide customer rows as customers and subscriptions; the service answers packed as JSON."""
    rows = clean.orderBy(ID).limit(limit) if limit else clean
    customers = rows.select(
        F.col(ID).alias("customer_id"), "gender", F.coalesce("SeniorCitizen", F.lit(0)).alias("senior_citizen"),
        F.col("Partner").alias("partner"), F.col("Dependents").alias("dependents"),
        F.coalesce("tenure", F.lit(0)).alias("tenure"),
    )
    subscriptions = rows.select(
        F.col(ID).alias("customer_id"), F.col("Contract").alias("contract"),
        F.col("PaymentMethod").alias("payment_method"), F.col("PaperlessBilling").alias("paperless_billing"),
        F.coalesce("MonthlyCharges", F.lit(0.0)).alias("monthly_charges"),
        F.coalesce("TotalCharges", F.lit(0.0)).alias("total_charges"),
        F.col("InternetService").alias("internet_service"), F.col("PhoneService").alias("phone_service"),
        F.to_json(F.struct(*PACKED_SERVICES)).alias("services"),
        F.coalesce(TARGET, F.lit(0)).alias("churn"),
    )
    return customers, subscriptions


def seed_decisions(decided: DataFrame, model_version: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One decision row as prediction, risk score and recommendation."""
    level = F.coalesce("risk_level", risk_level("churn_probability"))
    predictions = decided.select(
        "customer_id", "churn_probability", level.alias("risk_level"), F.lit(model_version).alias("model_version")
    )
    scores = decided.select(
        "customer_id", F.lit(None).cast("double").alias("previous_probability"),
        F.col("churn_probability").alias("new_probability"), F.lit(None).cast("double").alias("risk_change"),
        level.alias("risk_level"), F.coalesce("revenue_at_risk", F.lit(0.0)).alias("revenue_at_risk"),
    )
    recommendations = decided.select(
        "customer_id", F.coalesce("recommended_action", F.lit("no_intervention")).alias("recommended_action"),
        F.coalesce("urgency", F.lit("LOW")).alias("urgency"), "reason",
        F.coalesce("priority_score", F.lit(0.0)).alias("priority_score"),
        F.coalesce("estimated_net_value", F.lit(0.0)).alias("estimated_net_value"),
    )
    return predictions, scores, recommendations


MODEL_META = (
    "model_version string, base_model string, calibration string, feature_set string, "
    "val_metrics struct<roc_auc: double, pr_auc: double, f1: double, brier: double, log_loss: double>"
)


def model_version_row(spark: SparkSession, path: str) -> DataFrame:
    """The production model's metadata file as a table row."""
    meta = spark.read.schema(MODEL_META).option("multiLine", True).json(path)
    return meta.select(
        F.coalesce("model_version", F.lit("unknown")).alias("model_version"), "base_model", "calibration",
        "val_metrics.roc_auc", "val_metrics.pr_auc", "val_metrics.f1", "val_metrics.brier",
        F.lit("production").alias("stage"),
    )


def row_counts_frame(spark: SparkSession, loaded: dict[str, int]) -> DataFrame:
    """Load counts (one per table) as a frame."""
    return spark.createDataFrame(list(loaded.items()), "table_name string, rows_loaded long")
