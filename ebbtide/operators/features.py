"""Row-wise features of one customer, and the gold feature table."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.functions.numeric import added, banded, count_of, flag, looked_up, rounded
from ebbtide.functions.risk import lifetime_value
from ebbtide.vocab import (
    CATEGORICAL, CONTRACT_RISK, COUNTED_EVENTS, ENGINEERED, ID, NUMERIC, SECURITY_BUNDLE,
    STREAMING_BUNDLE, TARGET, TENURE_COHORTS,
)

# Flag column -> service column answered with Yes.
_YES_FLAGS = {
    "has_phone": "PhoneService",
    "has_multiple_lines": "MultipleLines",
    "has_online_security": "OnlineSecurity",
    "has_online_backup": "OnlineBackup",
    "has_device_protection": "DeviceProtection",
    "has_tech_support": "TechSupport",
    "has_streaming_tv": "StreamingTV",
    "has_streaming_movies": "StreamingMovies",
}
SERVICE_FLAGS = [*_YES_FLAGS, "has_internet"]
FEATURED_NUMERIC = [*NUMERIC, *ENGINEERED]
FEATURED_COLUMNS = [*FEATURED_NUMERIC, *CATEGORICAL]


def engineer_features(clean: DataFrame) -> DataFrame:
    """Add the engineered columns to a cleaned customer frame: three projections, no shuffle."""
    flags = {name: flag(F.col(service) == "Yes") for name, service in _YES_FLAGS.items()}
    # A missing internet service counts as having one.
    flags["has_internet"] = F.coalesce(F.col("InternetService") != "No", F.lit(True)).cast("int")
    monthly_contract = flag(F.col("Contract") == "Month-to-month")
    spend_rate = F.when(F.col("tenure") > 0, F.try_divide("TotalCharges", "tenure")).otherwise(
        F.col("MonthlyCharges")
    )
    return (
        clean.withColumns(flags)
        .withColumns(
            {
                "has_streaming": F.greatest("has_streaming_tv", "has_streaming_movies"),
                "total_services": added(F.col(c) for c in SERVICE_FLAGS),
                "average_charge_per_month": rounded(spend_rate, 2),
                "is_month_to_month": monthly_contract,
                "is_long_term_contract": flag(F.col("Contract").isin("One year", "Two year")),
                "contract_risk_indicator": monthly_contract,
                "payment_risk_indicator": flag(F.col("PaymentMethod") == "Electronic check"),
                "tenure_risk_indicator": flag(F.col("tenure") < 12),
            }
        )
        .withColumn("service_adoption_score", rounded(F.col("total_services") / len(SERVICE_FLAGS), 4))
    )


def featured_projection(featured: DataFrame) -> DataFrame:
    """Model table: id, numeric and engineered columns, categories, label."""
    return featured.select(ID, *FEATURED_COLUMNS, TARGET)


class FeatureEngineer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless ML stage around :func:`engineer_features`."""

    @keyword_only
    def __init__(self):
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return engineer_features(dataset)


# --- gold ----------------------------------------------------------------------------------------
def event_counts(events: DataFrame) -> DataFrame:
    """Event counts per customer; combined map-side, so a busy customer travels as one row per task."""
    return events.groupBy("customer_id").agg(
        *[count_of(F.col("event_type") == kind).alias(name) for kind, name in COUNTED_EVENTS.items()],
        F.count("event_type").alias("recent_events_count"),
    )


def gold_columns(silver: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    history = F.col("TotalCharges") / F.when(F.col("tenure") == 0, 1).otherwise(F.col("tenure"))
    fiber = F.col("InternetService") == "Fiber optic"
    no_support = F.coalesce(F.col("TechSupport") != "Yes", F.lit(True))
    return (
        silver.withColumns(
            {
                "tenure_cohort": banded("tenure", TENURE_COHORTS, other="nan"),
                "avg_monthly_charges_history": history,
                "security_bundle_score": added(flag(F.col(c) == "Yes") for c in SECURITY_BUNDLE),
                "streaming_bundle_score": added(flag(F.col(c) == "Yes") for c in STREAMING_BUNDLE),
                "contract_risk_index": looked_up("Contract", CONTRACT_RISK, 2),
                "is_high_risk_payment": flag(F.col("PaymentMethod") == "Electronic check"),
                "is_fiber_without_techsupport": flag(fiber & no_support),
                "estimated_clv": rounded(lifetime_value("MonthlyCharges", cfg), 2),
            }
        ).withColumns(
            {
                "charge_discrepancy": F.col("MonthlyCharges") - F.col("avg_monthly_charges_history"),
                "charge_ratio": F.least(
                    F.lit(10.0),
                    F.greatest(
                        F.lit(0.1), F.col("MonthlyCharges") / (F.col("avg_monthly_charges_history") + F.lit(1e-6))
                    ),
                ),
                "total_active_services": flag(F.col("PhoneService") == "Yes")
                + flag(F.col("MultipleLines") == "Yes")
                + flag(F.col("InternetService").isin("DSL", "Fiber optic"))
                + F.col("security_bundle_score")
                + F.col("streaming_bundle_score"),
            }
        )
    )


def to_gold(silver: DataFrame, events: DataFrame | None, cfg: Settings = DEFAULTS) -> DataFrame:
    """Customer feature table. ``events`` is an explicit input; without it the counts are zero."""
    gold = gold_columns(silver, cfg)
    names = [*COUNTED_EVENTS.values(), "recent_events_count"]
    if events is None:
        gold = gold.withColumns({n: F.lit(0).cast("long") for n in names})
    else:
        counts = event_counts(events).withColumnRenamed("customer_id", ID)
        gold = gold.join(counts, ID, "left").withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in names})
    return gold.withColumns(
        {"_gold_feature_timestamp": F.current_timestamp(), "_gold_feature_version": F.lit("v2.0")}
    )
