"""Drift of the scored customers: train rows against test rows, or any two slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.operators.drift import CURRENT, REFERENCE, drift_report
from ebbtide.operators.split import split_by_hash


def with_sides(df: DataFrame, reference: Column, current: Column) -> DataFrame:
    return df.withColumn("side", F.when(reference, REFERENCE).when(current, CURRENT))


def train_against_test(scored: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    parts = split_by_hash(scored, cfg=cfg)
    return with_sides(parts, F.col("split") == "train", F.col("split") == "test")


def build_report(scored: DataFrame, cfg: Settings = DEFAULTS, scenario: str = "real:train-vs-test") -> DataFrame:
    return drift_report(train_against_test(scored, cfg), scenario=scenario, cfg=cfg)
