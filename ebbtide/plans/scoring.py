"""Score, value and decide in one chain; ad-hoc customers and customer lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.operators.clean import clean_raw
from ebbtide.operators.features import engineer_features
from ebbtide.operators.ordered import top_rows
from ebbtide.operators.value import decisions, with_value
from ebbtide.sources.projection import with_scorecard
from ebbtide.vocab import ADHOC_DEFAULTS, ID, TARGET

Scorer = Callable[[DataFrame], DataFrame]


def fill_defaults(partial: DataFrame) -> DataFrame:
    """Every raw column present, missing cells filled with the documented defaults."""
    return partial.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(d)) if c in partial.columns else F.lit(d)
            for c, d in ADHOC_DEFAULTS.items()
        }
    )


def score_adhoc(partial: DataFrame, scorer: Scorer = with_scorecard, cfg: Settings = DEFAULTS) -> DataFrame:
    """Decision records for customers that are only partly described."""
    raw = fill_defaults(partial)
    if ID not in raw.columns:
        raw = raw.withColumn(ID, F.lit("adhoc"))
    raw = raw.withColumn(TARGET, F.lit("No"))
    return (
        raw.transform(clean_raw)
        .transform(engineer_features)
        .transform(scorer)
        .transform(with_value, cfg)
        .transform(decisions, cfg)
    )


def filter_customers(
    valued: DataFrame,
    levels: list[str] | None = None,
    segments: list[str] | None = None,
    tenure: tuple[int, int] | None = None,
    min_probability: float = 0.0,
    limit: int = 500,
) -> DataFrame:
    """Customer list of the risk page: filters, then the highest revenue at risk."""
    rows = valued.filter(F.col("churn_probability") >= min_probability)
    if levels:
        rows = rows.filter(F.col("risk_level").isin(levels))
    if segments:
        rows = rows.filter(F.col("segment_label").isin(segments) | F.col("segment_label").isNull())
    if tenure:
        rows = rows.filter(F.col("tenure").between(*tenure))
    return top_rows(rows, [F.desc("revenue_at_risk"), F.asc(ID)], limit)


def find_customer(valued: DataFrame, customer_id: str, key: str = ID) -> DataFrame:
    """The customer's row; a missing customer is an error. The filter reaches the scan."""
    found = valued.filter(F.col(key) == customer_id)
    if found.isEmpty():
        raise KeyError(customer_id)
    return found


def find_customers(valued: DataFrame, ids: DataFrame, key: str = ID) -> DataFrame:
    """Rows of all wanted customers, for lookups in bulk."""
    return valued.join(ids.select(key).distinct(), key, "left_semi")
