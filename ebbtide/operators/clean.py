"""Bronze lineage, two cleaning contracts, event cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.numeric import as_col, count_of, flag, number_or_null
from ebbtide.vocab import CATEGORICAL, ID, RAW_COLUMNS, TARGET


# --- bronze -----------------------------------------------------------------------------------
def record_hash(columns: list[str]) -> Column:
    """md5 over the business columns; separated, so that shifted cells do not collide."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *cells))


def batch_id(run_key: str) -> Column:
    """First 12 hex digits of a sha256 over the run's key and start time."""
    return F.substring(
        F.sha2(F.concat_ws("_", F.current_timestamp().cast("string"), F.lit(run_key)), 256), 1, 12
    )


def to_bronze_customers(raw: DataFrame, source: Column | str, run_key: str = "customers") -> DataFrame:
    return raw.withColumns(
        {
            "_bronze_ingested_at": F.current_timestamp(),
            "_bronze_source_file": F.lit(source) if isinstance(source, str) else source,
            "_bronze_batch_id": batch_id(run_key),
            "_bronze_record_hash": record_hash([c for c in RAW_COLUMNS if c in raw.columns]),
        }
    )


def to_bronze_events(events: DataFrame, source: str = "streaming_event_bus", run_key: str = "events") -> DataFrame:
    """Works on batch and streaming frames; an empty frame stays typed."""
    return events.withColumns(
        {
            "_bronze_ingested_at": F.current_timestamp(),
            "_bronze_source_file": F.lit(source),
            "_bronze_batch_id": batch_id(run_key),
        }
    )


# --- model cleaning: no row is dropped, only new customers get a zero total ----------------------
def clean_raw(raw: DataFrame) -> DataFrame:
    total = number_or_null("TotalCharges")
    cleaned = raw.withColumns(
        {
            "TotalCharges": F.when(total.isNull() & (F.col("tenure") == 0), 0.0).otherwise(total),
            "SeniorCitizen": F.col("SeniorCitizen").cast("string").try_cast("int"),
        }
    )
    if TARGET in raw.columns:
        cleaned = cleaned.withColumn(TARGET, flag(F.col(TARGET) == "Yes"))
    return cleaned


# --- silver ------------------------------------------------------------------------------------
def newest(arrival: str) -> Column:
    """An order that is never null as a whole, which ``max_by`` would skip."""
    return F.struct(F.col(arrival).isNotNull(), F.col(arrival))


def keep_last(df: DataFrame, key: str, arrival: str) -> DataFrame:
    """Last row per key by ``arrival``; rows without one come first. An aggregate, so repeats of one
    key combine map-side instead of being sorted in one task."""
    rest = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*rest), newest(arrival)).alias("_last"))
        .select(*[F.col(key) if c == key else F.col(f"_last.{c}").alias(c) for c in df.columns])
    )


def label_value(c: Column | str) -> Column:
    return flag(F.lower(F.trim(as_col(c).cast("string"))).isin("yes", "1", "true"))


def standardise(df: DataFrame) -> DataFrame:
    """Types, imputed totals, 0/1 label and trimmed categories; row-wise."""
    tenure = F.coalesce(number_or_null("tenure").cast("int"), F.lit(0))
    monthly = F.coalesce(number_or_null("MonthlyCharges"), F.lit(0.0))
    total = number_or_null("TotalCharges")
    imputed = F.coalesce(total, F.when(tenure == 0, 0.0), monthly * F.greatest(tenure, F.lit(1)))
    columns = {
        "SeniorCitizen": F.coalesce(number_or_null("SeniorCitizen").cast("int"), F.lit(0)),
        "tenure": tenure,
        "MonthlyCharges": monthly,
        "TotalCharges": imputed,
        **{c: F.trim(F.col(c)) for c in CATEGORICAL if c in df.columns},
    }
    if TARGET in df.columns:
        columns["Churn_Numeric"] = label_value(TARGET)
    return df.withColumns(columns)


def valid_customer() -> Column:
    ok = (F.col("tenure") >= 0) & (F.col("MonthlyCharges") >= 0) & (F.col("TotalCharges") >= 0)
    return F.coalesce(ok, F.lit(False))


def to_silver_customers(bronze: DataFrame, arrival: str) -> DataFrame:
    return (
        standardise(keep_last(bronze, ID, arrival))
        .filter(valid_customer())
        .withColumns({"_silver_processed_at": F.current_timestamp(), "_silver_quality_score": F.lit(1.0)})
    )


def silver_quality(bronze: DataFrame, arrival: str) -> DataFrame:
    """One row: raw, deduplicated, dropped and clean counts, from one pass over the bronze table."""
    per_id = bronze.groupBy(ID).agg(
        F.count("*").alias("_copies"),
        *[F.max_by(c, newest(arrival)).alias(c) for c in ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen"]],
    )
    checked = standardise(per_id).withColumn("_ok", valid_customer())
    return checked.agg(
        F.sum("_copies").cast("long").alias("raw_records"),
        F.count("*").alias("deduplicated_records"),
        count_of(~F.col("_ok")).alias("invalid_records_dropped"),
        count_of(F.col("_ok")).alias("clean_records"),
    ).withColumn("quality_status", F.lit("PASSED"))


def to_silver_events(bronze: DataFrame) -> DataFrame:
    """Batch or streaming. Unreadable times become null, types are lower-cased, value defaults to 1."""
    when = F.col("timestamp")
    if dict(bronze.dtypes)["timestamp"] == "string":
        when = F.try_to_timestamp(when)
    return bronze.withColumns(
        {
            "timestamp": F.date_format(when, "yyyy-MM-dd HH:mm:ss"),
            "event_type": F.lower(F.trim("event_type")),
            "value": F.coalesce(number_or_null("value"), F.lit(1.0)),
            "_silver_processed_at": F.current_timestamp(),
        }
    )
