"""Load all warehouse tables, with synthetic keys and counts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.plans.warehouse import Warehouse, with_sequence_key
from ebbtide.sources.tables import load_table, row_counts_frame, store_bucketed

TABLES = {
    "raw_customers": ("customers", None),
    "raw_customer_events": ("events", ("evt", "event_id", ["event_timestamp", "event_id"])),
    "analytics_customer_features": ("features", None),
    "ml_churn_predictions": ("predictions", ("pred", "prediction_id", ["customer_id"])),
    "reporting_retention_actions": ("actions", ("act", "action_id", ["customer_id"])),
}


def store_co_located(w: Warehouse, folder: str, prefix: str = "warehouse_", buckets: int | None = None) -> Warehouse:
    """The customer-keyed tables as catalog tables bucketed alike, for views without join shuffles.

    Events stay as they are: they may hold hot customers, which buckets cannot split. Without
    ``buckets`` there are as many as the session's shuffle partitions.
    """
    buckets = buckets or int(w.customers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return replace(
        w,
        **{
            part: store_bucketed(getattr(w, part), f"{prefix}{part}", f"{folder}/{part}", "customer_id", buckets)
            for part in ("customers", "features", "predictions", "actions")
        },
    )


def load_all(w: Warehouse, folder: str) -> DataFrame:
    """Write every table below ``folder``; returns table_name and rows loaded."""
    loaded = {}
    for name, (part, key) in TABLES.items():
        df = getattr(w, part)
        if key:
            prefix, column, order = key
            df = with_sequence_key(df, [F.col(c) for c in order], prefix, column)
        loaded[name] = load_table(df, f"{folder}/{name}")
    return row_counts_frame(w.customers.sparkSession, loaded)
