"""Land, clean and feature one batch of customers and events, with a run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.operators.clean import silver_quality, to_bronze_customers, to_bronze_events, to_silver_customers, to_silver_events
from ebbtide.operators.features import to_gold
from ebbtide.sources.tables import store_with_manifest


def run(
    landing: DataFrame, events: DataFrame, folder: str, arrival: str, source: str = "landing", cfg: Settings = DEFAULTS
) -> DataFrame:
    """Each tier is written once and read back by the next, so a lost executor costs one tier.

    Returns one row per tier: tier, table_name, records, columns, runtime_seconds.
    """
    import time

    spark = landing.sparkSession
    steps = []

    def stored(tier: str, table: str, df: DataFrame) -> DataFrame:
        path, begun = f"{folder}/{tier}/{table}", time.perf_counter()
        rows = store_with_manifest(df, path, table, tier.upper(), f"{folder}/audit_loads")
        steps.append((tier, table, rows, len(df.columns), round(time.perf_counter() - begun, 3)))
        return spark.read.parquet(path)

    bronze = stored("bronze", "bronze_customers_raw", to_bronze_customers(landing, source))
    bronze_events = stored("bronze", "bronze_events_raw", to_bronze_events(events))
    silver = stored("silver", "silver_customers_clean", to_silver_customers(bronze, arrival))
    silver_events = stored("silver", "silver_events_clean", to_silver_events(bronze_events))
    stored("gold", "gold_customer_features_daily", to_gold(silver, silver_events, cfg))
    stored("silver", "silver_quality", silver_quality(bronze, arrival).withColumn("processed_at", F.current_timestamp()))
    return spark.createDataFrame(
        steps, "tier string, table_name string, records long, columns int, runtime_seconds double"
    )
