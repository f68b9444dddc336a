import pytest
from pyspark.sql import functions as F

from ebbtide.functions.risk import adjusted_probability, register_sql_functions, risk_level
from ebbtide.operators import value as v
from ebbtide.plans.scoring import find_customer, score_adhoc


def levels(spark, values):
    df = spark.createDataFrame([(p,) for p in values], "p double")
    return [r[0] for r in df.select(risk_level("p")).collect()]


def test_band_edges(spark):
    assert levels(spark, [0.0, 0.29, 0.49, 0.50, 0.69, 0.70, 0.84, 0.85, 1.0]) == [
        "LOW", "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL", "CRITICAL",
    ]
    assert levels(spark, [None]) == [None]


@pytest.mark.parametrize("p", [-0.01, 1.01, 2.0, float("nan")])
def test_out_of_range_fails(spark, p):
    with pytest.raises(Exception, match="probability must be in"):
        levels(spark, [p])


def test_value_table_ranks_by_value_not_probability(spark):
    rows = [("a", 20.0, 0.05), ("b", 50.0, 0.4), ("c", 100.0, 0.9), ("d", 80.0, 0.75)]
    df = spark.createDataFrame(rows, "customerID string, MonthlyCharges double, churn_probability double")
    out = {r["customerID"]: r for r in v.with_priority(v.with_value(df)).collect()}
    assert out["b"]["estimated_clv"] == 360.0 and out["b"]["revenue_at_risk"] == 144.0
    assert out["c"]["priority_rank"] == 1 and out["c"]["priority_flag"]
    assert sorted(r["priority_rank"] for r in out.values()) == [1, 2, 3, 4]
    assert sum(r["priority_flag"] for r in out.values()) == 1


def test_prioritization_shift(spark):
    rows = [(f"c{i}", 10.0 * (i + 1), (10 - i) / 10.5) for i in range(10)]
    df = spark.createDataFrame(rows, "customerID string, MonthlyCharges double, churn_probability double")
    got = v.prioritization_shift(v.with_value(df), 0.3).first()
    by_p = {f"c{i}" for i in (0, 1, 2)}
    rar = sorted(rows, key=lambda r: -round(r[2] * round(r[1] * 7.2, 2), 2))
    by_v = {r[0] for r in rar[:3]}
    assert got["top_n"] == 3 and got["overlap"] == len(by_p & by_v) and got["swapped_in_by_value"] == len(by_v - by_p)


BASE = {
    "customerID": "x", "risk_level": "HIGH", "payment_risk_indicator": 0, "is_month_to_month": 0, "tenure": 40,
    "has_internet": 1, "has_tech_support": 1, "has_online_security": 1, "segment_label": "Low-value/high-risk",
    "estimated_clv": 300.0, "churn_probability": 0.75, "revenue_at_risk": 225.0, "priority_score": 225.0,
}
CASES = [
    ({"risk_level": "LOW"}, "no_intervention"),
    ({"risk_level": "CRITICAL", "estimated_clv": 600.0}, "account_manager_contact"),
    ({"risk_level": "CRITICAL", "segment_label": "High-value/high-risk"}, "account_manager_contact"),
    ({"risk_level": "CRITICAL", "payment_risk_indicator": 1}, "payment_assistance"),
    ({"payment_risk_indicator": 1, "is_month_to_month": 1}, "payment_assistance"),
    ({"is_month_to_month": 1, "tenure": 11}, "onboarding_assistance"),
    ({"is_month_to_month": 1, "tenure": 12}, "plan_optimization"),
    ({"has_tech_support": 0}, "technical_support_intervention"),
    ({"has_tech_support": 0, "has_internet": 0, "has_online_security": 0}, "personalized_discount"),
    ({"has_online_security": 0}, "feature_education"),
    ({"estimated_clv": 600.0}, "loyalty_reward"),
    ({}, "personalized_discount"),
]


def test_decision_rules_in_order(spark):
    rows = [{**BASE, **change, "customerID": str(i)} for i, (change, _) in enumerate(CASES)]
    out = {r["customer_id"]: r for r in v.decisions(spark.createDataFrame(rows)).collect()}
    assert [out[str(i)]["recommended_action"] for i in range(len(CASES))] == [a for _, a in CASES]
    assert all(r["reason"] for r in out.values())
    low, critical = out["0"], out["1"]
    assert (low["estimated_intervention_cost"], low["estimated_net_value"]) == (0.0, 0.0)
    assert critical["urgency"] == "IMMEDIATE" and critical["estimated_intervention_cost"] == 120.0
    assert critical["estimated_expected_retained_value"] == 78.75 and critical["estimated_net_value"] == -41.25


def test_absent_signals_take_defaults(spark):
    df = spark.createDataFrame([("HIGH",)], "risk_level string")
    assert df.select(v.recommended_action(df)).first()[0] == "technical_support_intervention"


def test_clamp_and_unknown_event(spark):
    rows = [(0.95, "cancellation_attempt"), (0.01, "plan_upgrade"), (0.4, "mystery"), (0.4, None)]
    df = spark.createDataFrame(rows, "p double, t string")
    assert [r[0] for r in df.select(adjusted_probability("p", "t")).collect()] == [1.0, 0.0, 0.4, 0.4]


def test_sql_functions_match(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT churn_risk_level(0.85) a, customer_lifetime_value(100D) b, event_adjusted_probability(0.5, 'complaint') c"
    ).first()
    assert (row["a"], round(row["b"], 6), row["c"]) == ("CRITICAL", 720.0, 0.62)


def test_adhoc_customer_without_any_field(spark):
    got = score_adhoc(spark.range(1).select(F.lit("n1").alias("customerID"))).first()
    assert got["customer_id"] == "n1" and got["estimated_clv"] == 504.0 and got["risk_level"] == "CRITICAL"


def test_missing_customer_raises(inputs):
    assert find_customer(inputs.valued, "C00000007").first()["customerID"] == "C00000007"
    with pytest.raises(KeyError):
        find_customer(inputs.valued, "nobody")


def test_high_risk_limits(inputs):
    with pytest.raises(ValueError):
        v.customers_at_or_above(inputs.decided, limit=501)
    rows = v.customers_at_or_above(inputs.decided, "critical", 50).collect()
    assert rows and all(r["risk_level"] == "CRITICAL" for r in rows)
