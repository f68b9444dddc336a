"""Risk bands, value formulas, event effects; also as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.functions.numeric import as_col, looked_up
from ebbtide.vocab import EVENT_DELTAS, RISK_LEVELS


def risk_level(p: Column | str, cfg: Settings = DEFAULTS) -> Column:
    """Band of a probability; a value outside [0, 1] fails the job."""
    p = as_col(p)
    return (
        F.when(p.isNull(), F.lit(None).cast("string"))
        .when(
            ~p.between(0.0, 1.0) | F.isnan(p.cast("double")),
            F.raise_error(F.concat(F.lit("probability must be in [0, 1], got "), p.cast("string"))),
        )
        .when(p >= cfg.critical_from, "CRITICAL")
        .when(p >= cfg.high_from, "HIGH")
        .when(p >= cfg.medium_from, "MEDIUM")
        .otherwise("LOW")
    )


def risk_ordinal(level: Column | str) -> Column:
    return looked_up(level, {name: i for i, name in enumerate(RISK_LEVELS)}, 0)


def at_risk(level: Column | str) -> Column:
    return as_col(level).isin("HIGH", "CRITICAL")


def lifetime_value(monthly: Column | str, cfg: Settings = DEFAULTS) -> Column:
    return as_col(monthly) * F.lit(cfg.lifetime_months) * F.lit(cfg.gross_margin)


def value_at_risk(p: Column | str, clv: Column | str) -> Column:
    return as_col(p) * as_col(clv)


def event_delta(event_type: Column | str) -> Column:
    """Effect of an event on the probability, as decimal(4,2); unknown types have none."""
    pairs = []
    for name, delta in EVENT_DELTAS.items():
        pairs += [F.lit(name), F.lit(delta).cast("decimal(4,2)")]
    found = F.element_at(F.create_map(*pairs), as_col(event_type))
    return F.coalesce(found, F.lit("0").cast("decimal(4,2)"))


def adjusted_probability(p: Column | str, event_type: Column | str) -> Column:
    """Probability after one event, kept within [0, 1]."""
    moved = as_col(p).cast("decimal(18,6)") + event_delta(event_type)
    return F.least(F.lit(1), F.greatest(F.lit(0), moved)).cast("decimal(18,6)").cast("double")


def register_sql_functions(spark: SparkSession, cfg: Settings = DEFAULTS) -> None:
    """Expose the scalar rules to SQL as temporary functions (plain SQL bodies, inlined)."""
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in EVENT_DELTAS.items())
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION churn_risk_level(p DOUBLE) RETURNS STRING RETURN
            CASE WHEN p IS NULL THEN NULL
                 WHEN p < 0 OR p > 1 THEN raise_error('probability must be in [0, 1]')
                 WHEN p >= {cfg.critical_from} THEN 'CRITICAL'
                 WHEN p >= {cfg.high_from} THEN 'HIGH'
                 WHEN p >= {cfg.medium_from} THEN 'MEDIUM' ELSE 'LOW' END"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION customer_lifetime_value(monthly DOUBLE)
            RETURNS DOUBLE RETURN monthly * {cfg.lifetime_months} * {cfg.gross_margin}D"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION event_adjusted_probability(p DOUBLE, kind STRING)
            RETURNS DOUBLE RETURN CAST(least(1, greatest(0, CAST(p AS DECIMAL(18,6)) +
                CAST(CASE kind {cases} ELSE 0 END AS DECIMAL(4,2)))) AS DOUBLE)"""
    )
