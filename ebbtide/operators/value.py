"""Customer value, revenue at risk, priority, and the retention decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.functions.numeric import count_of, exact_avg, exact_sum, looked_up, rounded, rounded_total
from ebbtide.functions.risk import lifetime_value, risk_level, value_at_risk
from ebbtide.operators.ordered import top_rows, with_rank, with_ranks
from ebbtide.vocab import ACTION_REASONS, ID, URGENCY


def with_value(scored: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Value, revenue at risk, level and priority score; row-wise."""
    return (
        scored.withColumn("estimated_clv", rounded(lifetime_value("MonthlyCharges", cfg), 2))
        .withColumn("revenue_at_risk", rounded(value_at_risk("churn_probability", "estimated_clv"), 2))
        .withColumns({"risk_level": risk_level("churn_probability", cfg), "priority_score": F.col("revenue_at_risk")})
    )


def top_count(rows: Column, share: float) -> Column:
    return F.greatest(F.lit(1), F.floor(rows * F.lit(share))).cast("long")


def with_priority(valued: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Priority rank over all customers (ties by id) and the flag of the top share."""
    ranked = with_rank(valued, [F.desc("priority_score"), F.asc(ID)], "priority_rank", total="_rows")
    flagged = F.col("priority_rank") <= top_count(F.col("_rows"), cfg.top_share)
    return ranked.withColumn("priority_flag", flagged).drop("_rows")


def prioritization_shift(valued: DataFrame, share: float = DEFAULTS.top_share) -> DataFrame:
    """How the top share differs when ranked by value at risk instead of probability.

    Both top sets are a share of all customers, so both come from global ranks.
    """
    both = with_ranks(
        valued.select(ID, "churn_probability", "revenue_at_risk"),
        {
            "_rank_p": [F.desc("churn_probability"), F.asc(ID)],
            "_rank_v": [F.desc("revenue_at_risk"), F.asc(ID)],
        },
        total="_rows",
    )
    n = top_count(F.col("_rows"), share)
    in_p, in_v = F.col("_rank_p") <= F.col("_n"), F.col("_rank_v") <= F.col("_n")
    return (
        both.withColumn("_n", n)
        .agg(
            F.max("_n").alias("top_n"),
            count_of(in_p & in_v).alias("overlap"),
            count_of(in_v & ~in_p).alias("swapped_in_by_value"),
        )
        .select(
            F.lit(share).alias("top_percent"),
            "top_n",
            "overlap",
            rounded(F.col("overlap") / F.col("top_n") * 100, 1).alias("overlap_pct"),
            "swapped_in_by_value",
            rounded(F.col("swapped_in_by_value") / F.col("top_n") * 100, 1).alias("swapped_pct"),
        )
    )


# --- decisions -----------------------------------------------------------------------------------
def _given(df: DataFrame, name: str, default) -> Column:
    """A signal that may be absent from the frame or null."""
    return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)


def is_high_value(df: DataFrame, cfg: Settings = DEFAULTS) -> Column:
    segment = _given(df, "segment_label", "")
    return segment.startswith("High-value") | (_given(df, "estimated_clv", 0.0) >= cfg.high_value_clv)


def recommended_action(df: DataFrame, cfg: Settings = DEFAULTS) -> Column:
    """Ordered rules, first match wins."""
    level = _given(df, "risk_level", "")
    high_value = is_high_value(df, cfg)
    monthly = _given(df, "is_month_to_month", 0) == 1
    internet = _given(df, "has_internet", 1) == 1
    rules = [
        (level == "LOW", "no_intervention"),
        ((level == "CRITICAL") & high_value, "account_manager_contact"),
        (_given(df, "payment_risk_indicator", 0) == 1, "payment_assistance"),
        (monthly & (_given(df, "tenure", 99) < 12), "onboarding_assistance"),
        (monthly, "plan_optimization"),
        (internet & (_given(df, "has_tech_support", 0) == 0), "technical_support_intervention"),
        (internet & (_given(df, "has_online_security", 0) == 0), "feature_education"),
        (high_value, "loyalty_reward"),
    ]
    condition, action = rules[0]
    chain = F.when(condition, action)
    for condition, action in rules[1:]:
        chain = chain.when(condition, action)
    return chain.otherwise("personalized_discount")


def with_decision(valued: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Add urgency, action, reason and the retention economics; row-wise."""
    acts = F.col("recommended_action") != "no_intervention"
    cost = looked_up(
        "recommended_action", {k: float(v) for k, v in cfg.action_costs.items()}, float(cfg.default_action_cost)
    )
    retained = rounded(F.col("revenue_at_risk") * cfg.effectiveness, 2)
    return (
        valued.withColumn("recommended_action", recommended_action(valued, cfg))
        .withColumns(
            {
                "urgency": looked_up(_given(valued, "risk_level", "LOW"), URGENCY, "LOW"),
                "reason": looked_up("recommended_action", ACTION_REASONS, ""),
                "estimated_intervention_cost": F.when(acts, cost).otherwise(0.0),
                "estimated_expected_retained_value": F.when(acts, retained).otherwise(0.0),
            }
        )
        .withColumn(
            "estimated_net_value",
            rounded(F.col("estimated_expected_retained_value") - F.col("estimated_intervention_cost"), 2),
        )
    )


DECISION_COLUMNS = [
    "customer_id", "churn_probability", "risk_level", "estimated_clv", "revenue_at_risk", "priority_score",
    "urgency", "recommended_action", "reason", "estimated_intervention_cost",
    "estimated_expected_retained_value", "estimated_net_value",
]


def decisions(valued: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """The twelve-column decision record of every customer."""
    return (
        with_decision(valued, cfg)
        .withColumnRenamed(ID, "customer_id")
        .withColumns(
            {
                "churn_probability": rounded("churn_probability", 4),
                "estimated_clv": rounded("estimated_clv", 2),
                "revenue_at_risk": rounded("revenue_at_risk", 2),
                "priority_score": rounded("priority_score", 2),
            }
        )
        .select(*DECISION_COLUMNS)
    )


# --- reports -------------------------------------------------------------------------------------
def value_summary(valued: DataFrame) -> DataFrame:
    return valued.agg(
        F.count("*").alias("n_customers"),
        rounded_total(exact_sum("estimated_clv"), 2).alias("total_estimated_clv"),
        rounded_total(exact_sum("revenue_at_risk"), 2).alias("total_estimated_revenue_at_risk"),
    )


def value_by_segment(valued: DataFrame, segment: str = "segment_label") -> DataFrame:
    return valued.groupBy(segment).agg(
        F.count("*").alias("customers"),
        rounded_total(exact_sum("revenue_at_risk"), 2).alias("total_revenue_at_risk"),
        rounded_total(exact_avg("churn_probability"), 2).alias("avg_churn_prob"),
    )


def retention_summary(decided: DataFrame) -> DataFrame:
    acts = F.col("recommended_action") != "no_intervention"

    def over_actions(name: str) -> Column:
        return F.coalesce(exact_sum(F.when(acts, F.col(name))), F.lit(0.0))

    cost, kept = over_actions("estimated_intervention_cost"), over_actions("estimated_expected_retained_value")
    return decided.agg(
        F.count("*").alias("n_customers"),
        count_of(acts).alias("n_actionable"),
        rounded_total(cost, 2).alias("estimated_total_intervention_cost"),
        rounded_total(kept, 2).alias("estimated_total_expected_retained_value"),
        rounded_total(kept - cost, 2).alias("estimated_net_value"),
    )


def counts_of(df: DataFrame, column: str) -> DataFrame:
    """Value counts in long form: field, value, n."""
    return (
        df.groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(column).alias("field"), "value", "n")
    )


def counts_of_many(df: DataFrame, columns: list[str]) -> DataFrame:
    """Value counts of several columns in one scan and one shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).groupBy("field", "value").agg(F.count("*").alias("n"))


def top_by_value(df: DataFrame, n: int, key: str = ID) -> DataFrame:
    return top_rows(df, [F.desc("revenue_at_risk"), F.asc(key)], n)


def customers_at_or_above(decided: DataFrame, min_level: str = "HIGH", limit: int = 50, key: str = "customer_id") -> DataFrame:
    """Highest revenue at risk among customers whose level is at least ``min_level``."""
    from ebbtide.functions.risk import risk_ordinal
    from ebbtide.vocab import RISK_LEVELS

    if not 1 <= limit <= 500:
        raise ValueError("limit must be between 1 and 500")
    name = min_level.upper()
    floor = RISK_LEVELS.index(name) if name in RISK_LEVELS else 2
    return top_by_value(decided.filter(risk_ordinal("risk_level") >= floor), limit, key)
