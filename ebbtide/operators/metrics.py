"""Classification metrics and curves as aggregates over the distinct scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.numeric import count_of, exact_avg, rounded_total
from ebbtide.operators.ordered import exact_quantiles, with_running_totals

_TINY = 2.220446049250313e-16  # log loss clips probabilities to [_TINY, 1 - _TINY]


def score_counts(df: DataFrame, score: str, label: str, by: list[str] = ()) -> DataFrame:
    """One row per distinct score: positives and negatives. Hot scores combine map-side."""
    return df.groupBy(*by, score).agg(
        count_of(F.col(label) == 1).alias("pos"), count_of(F.col(label) != 1).alias("neg")
    )


def with_cumulative(counts: DataFrame, score: str, by: list[str] = ()) -> DataFrame:
    """Positives and negatives at or above each score (``tp``, ``fp``)."""
    totals = {"tp": F.col("pos"), "fp": F.col("neg")}
    return with_running_totals(counts, [F.desc(score)], totals, list(by))


def threshold_metrics(df: DataFrame, score: str, label: str, threshold: float = 0.5, by: list[str] = ()) -> DataFrame:
    """Confusion counts and the metrics at one threshold; 0 where a denominator is empty."""
    hit, truth = F.col(score) >= threshold, F.col(label) == 1
    p = F.greatest(F.lit(_TINY), F.least(F.lit(1 - _TINY), F.col(score)))
    loss = -F.when(truth, F.ln(p)).otherwise(F.ln(1 - p))
    counts = df.groupBy(*by).agg(
        count_of(hit & truth).alias("tp"),
        count_of(hit & ~truth).alias("fp"),
        count_of(~hit & truth).alias("fn"),
        count_of(~hit & ~truth).alias("tn"),
        F.count("*").alias("n"),
        rounded_total(F.avg(loss), 4).alias("log_loss"),
        rounded_total(F.avg((F.col(score) - F.col(label)) * (F.col(score) - F.col(label))), 4).alias("brier"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by,
        F.lit(float(threshold)).alias("threshold"),
        "tp", "fp", "fn", "tn", "n",
        (tp + fn).alias("positives"),
        rounded_total(ratio(tp + tn, F.col("n")), 4).alias("accuracy"),
        rounded_total(ratio(tp, tp + fp), 4).alias("precision"),
        rounded_total(ratio(tp, tp + fn), 4).alias("recall"),
        rounded_total(ratio(2 * tp, 2 * tp + fp + fn), 4).alias("f1"),
        "log_loss", "brier",
    )


def ranking_metrics(df: DataFrame, score: str, label: str, by: list[str] = ()) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step sum) from one cumulative pass."""
    points = with_cumulative(score_counts(df, score, label, by), score, by)
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    pairs = neg * (tp - pos) + neg * pos / 2
    return (
        points.groupBy(*by)
        .agg(
            F.sum(pairs).alias("_pairs"),
            F.sum(pos * tp / (tp + fp)).alias("_steps"),
            F.sum(pos).alias("_p"),
            F.sum(neg).alias("_n"),
        )
        .select(
            *by,
            rounded_total(F.try_divide("_pairs", F.col("_p") * F.col("_n")), 4).alias("roc_auc"),
            rounded_total(F.try_divide("_steps", "_p"), 4).alias("pr_auc"),
        )
    )


def curves(df: DataFrame, score: str, label: str) -> DataFrame:
    """ROC and precision-recall point per threshold."""
    points = with_cumulative(score_counts(df, score, label), score, ())
    sizes = df.agg(count_of(F.col(label) == 1).alias("p"), count_of(F.col(label) != 1).alias("n"))
    size = sizes.select(F.struct("p", "n")).scalar()
    return points.withColumn("_s", size).select(
        F.col(score).alias("threshold"),
        "tp", "fp",
        rounded_total(F.try_divide("tp", F.col("_s.p")), 6).alias("tpr"),
        rounded_total(F.try_divide("fp", F.col("_s.n")), 6).alias("fpr"),
        rounded_total(F.try_divide("tp", F.col("tp") + F.col("fp")), 6).alias("precision"),
    )


def reliability(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean prediction against observed rate in equal-frequency bins; empty bins are left out."""
    probs = [i / bins for i in range(bins + 1)]
    keyed = df.select(F.lit(score).alias("field"), F.col(score).alias("v"))
    edges = exact_quantiles(keyed, ["field"], "v", probs).select("edges").scalar()
    p = F.col(score)
    inner = F.slice("_edges", 2, bins - 1)
    return (
        df.withColumn("_edges", edges)
        .withColumn("bin", F.size(F.filter(inner, lambda e: e < p)))
        .groupBy("bin")
        .agg(
            F.count("*").alias("n"),
            rounded_total(exact_avg(score), 4).alias("mean_predicted"),
            rounded_total(exact_avg(label), 4).alias("observed_rate"),
        )
    )


def classification_metrics(
    df: DataFrame, score: str, label: str, threshold: float = 0.5, by: list[str] = ()
) -> DataFrame:
    """The whole metric suite, one row per group."""
    at = threshold_metrics(df, score, label, threshold, by)
    ranked = ranking_metrics(df, score, label, by)
    if by:
        return at.join(ranked, list(by))
    pair = ranked.select(F.struct("roc_auc", "pr_auc")).scalar()
    return at.withColumn("_r", pair).select("*", F.col("_r.roc_auc").alias("roc_auc"), F.col("_r.pr_auc").alias("pr_auc")).drop("_r")


def best_by(table: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Name of the row that is smallest in ``order`` (for example Brier score, then log loss)."""
    return table.agg(F.min_by(name, F.struct(*order, name)).alias("selected"))


def passes_gate(runs: DataFrame, min_roc_auc: float, max_brier: float) -> DataFrame:
    """Promotion gate on recorded metrics; missing metrics fail."""
    ok = F.coalesce(F.col("roc_auc"), F.lit(0.0)) >= min_roc_auc
    ok = ok & (F.coalesce(F.col("brier"), F.lit(1.0)) <= max_brier)
    return runs.withColumns({"gate_passed": ok, "stage": F.when(ok, "production").otherwise("staging")})
