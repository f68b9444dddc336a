"""Business assumptions. They are part of the query semantics, not tuning knobs."""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType


def _frozen(mapping):
    return MappingProxyType(dict(mapping))


@dataclass(frozen=True)
class Settings:
    seed: int = 42

    # Most tasks of an iterative fit; without it the stored table's partitions. Never follows the data.
    fit_tasks: int | None = None

    # Split shares, stratified on the label.
    train_share: float = 0.70
    validation_share: float = 0.15
    test_share: float = 0.15

    # Lower bounds (inclusive) of the risk levels above LOW.
    medium_from: float = 0.50
    high_from: float = 0.70
    critical_from: float = 0.85

    # Value estimate: monthly charge x lifetime x margin.
    lifetime_months: int = 24
    gross_margin: float = 0.30

    # Retention economics.
    effectiveness: float = 0.35
    default_action_cost: float = 50.0
    top_share: float = 0.10
    high_value_clv: float = 500.0
    action_costs: MappingProxyType = field(
        default_factory=lambda: _frozen(
            {
                "payment_assistance": 30,
                "plan_optimization": 40,
                "personalized_discount": 60,
                "technical_support_intervention": 45,
                "account_manager_contact": 120,
                "loyalty_reward": 70,
                "feature_education": 15,
                "onboarding_assistance": 25,
                "no_intervention": 0,
            }
        )
    )

    # Drift.
    psi_drifted_above: float = 0.15
    max_drifted_share: float = 0.30

    # Promotion gate on validation metrics.
    gate_min_roc_auc: float = 0.80
    gate_max_brier: float = 0.20


DEFAULTS = Settings()
