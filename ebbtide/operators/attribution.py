"""Additive attribution of a linear score: weight x (value - mean), per customer and feature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.numeric import exact_avg, rounded
from ebbtide.vocab import ID


def label_of(feature: Column) -> Column:
    """Readable name of a feature."""
    return F.trim(F.replace(F.replace(feature, F.lit("_"), F.lit(" ")), F.lit("  "), F.lit(" ")))


def with_contributions(df: DataFrame, weights: dict[str, float], intercept: float) -> DataFrame:
    """Add ``base`` (the score of the average customer) and ``contributions``, an array with one
    entry per feature; base plus the contributions is the logit of the row.

    The means come from one aggregate row; the rest is a projection.
    """
    means = df.agg(F.struct(*[exact_avg(c).alias(c) for c in weights])).scalar()
    with_means = df.withColumn("_means", means)
    base = F.lit(intercept)
    for c, w in weights.items():
        base = base + F.lit(w) * F.col(f"_means.{c}")
    entries = [
        F.struct(F.lit(c).alias("feature"), (F.lit(w) * (F.col(c) - F.col(f"_means.{c}"))).alias("contribution"))
        for c, w in weights.items()
    ]
    return with_means.withColumns({"base": base, "contributions": F.array(*entries)}).drop("_means")


def long_contributions(df: DataFrame, key: str = ID) -> DataFrame:
    return df.select(key, F.inline("contributions")).withColumn("contribution", rounded("contribution", 5))


def global_importance(df: DataFrame, top_n: int = 20) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    return (
        df.select(F.inline("contributions"))
        .groupBy("feature")
        .agg(rounded(exact_avg(F.abs("contribution")), 5).alias("mean_abs_contribution"))
        .orderBy(F.desc("mean_abs_contribution"), "feature")
        .limit(top_n)
    )


def with_top_factors(df: DataFrame, top_k: int = 5) -> DataFrame:
    """``top_positive`` (towards churn) and ``top_negative`` (protective): arrays of
    (factor, contribution), strongest first, within the row."""
    entries = F.transform(
        "contributions",
        lambda e: F.struct(rounded(e["contribution"], 5).alias("c"), e["feature"].alias("feature")),
    )
    # Strongest first: sort by descending size, ties by name.
    towards = F.array_sort(
        F.transform(F.filter(entries, lambda e: e["c"] > 0), lambda e: F.struct((-e["c"]).alias("k"), e["feature"], e["c"]))
    )
    against = F.array_sort(
        F.transform(F.filter(entries, lambda e: e["c"] < 0), lambda e: F.struct(e["c"].alias("k"), e["feature"], e["c"]))
    )

    def strongest(found: Column) -> Column:
        return F.transform(
            F.slice(found, 1, top_k),
            lambda e: F.struct(label_of(e["feature"]).alias("factor"), e["c"].alias("contribution")),
        )

    return df.withColumns({"top_positive": strongest(towards), "top_negative": strongest(against)})


def driver_json(top_positive: str = "top_positive", k: int = 3) -> Column:
    """JSON list of the strongest factors, as stored with a prediction."""
    return F.to_json(F.transform(F.slice(top_positive, 1, k), lambda e: e["factor"]))


def factor_table(df: DataFrame, key: str = ID) -> DataFrame:
    """Both factor lists as rows with a direction; one pass, no union of two scans."""
    sides = F.array(
        F.struct(F.lit("raises").alias("direction"), F.col("top_positive").alias("f")),
        F.struct(F.lit("lowers").alias("direction"), F.col("top_negative").alias("f")),
    )
    return df.select(key, F.inline(sides)).select(key, "direction", F.inline("f"))
