"""Population stability index of features and predictions, one pass per feature type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.functions.numeric import as_col, count_of, number_or_null, rounded
from ebbtide.operators.ordered import approx_quantiles, exact_quantiles
from ebbtide.session import written
from ebbtide.vocab import MONITOR_CATEGORICAL, MONITOR_NUMERIC

_FLOOR = 1e-6  # shares are lifted to at least this, without renormalising
REFERENCE, CURRENT = "reference", "current"


def psi_band(psi: Column | str) -> Column:
    psi = as_col(psi)
    return F.when(psi < 0.1, "stable").when(psi < 0.25, "moderate").otherwise("significant")


def _counts(df: DataFrame, entries: list[Column], side: str) -> DataFrame:
    """Rows per (feature, value) on both sides: unpivot, combine map-side, one shuffle."""
    return (
        df.filter(F.col(side).isin(REFERENCE, CURRENT))
        .select(side, F.inline(F.array(*entries)))
        .groupBy("feature", "value")
        .agg(count_of(F.col(side) == REFERENCE).alias("ref"), count_of(F.col(side) == CURRENT).alias("cur"))
    )


def _psi(cells: DataFrame) -> DataFrame:
    """PSI per feature from the counts per cell; a cell empty on both sides adds nothing."""
    sizes = cells.groupBy("feature").agg(F.sum("ref").alias("ref_n"), F.sum("cur").alias("cur_n"))
    r = F.greatest(F.lit(_FLOOR), F.try_divide("ref", "ref_n"))
    c = F.greatest(F.lit(_FLOOR), F.try_divide("cur", "cur_n"))
    empty = (F.col("ref_n") == 0) | (F.col("cur_n") == 0)
    return (
        cells.join(F.broadcast(sizes), "feature")  # one row per monitored feature
        .groupBy("feature")
        .agg(F.sum(F.when(empty, 0.0).otherwise((c - r) * F.ln(c / r))).alias("psi"))
    )


def _cuts(edges: DataFrame, counts: DataFrame) -> DataFrame:
    """Inner bin edges of each feature from its quantiles and the reference's counts (feature, value, ref)."""
    weighted = F.col("value") * F.col("ref")
    spans = counts.groupBy("feature").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), (F.sum(weighted) / F.sum("ref")).alias("mean")
    )
    unique = F.array_distinct("edges")
    return (
        edges.join(spans, "feature")
        .withColumn("e", unique)
        .select(
            "feature",  # a reference with fewer than two cells is split at its mean
            F.when(F.size("e") < 3, F.array("mean")).otherwise(F.slice("e", 2, F.size("e") - 2)).alias("cuts"),
        )
    )


def psi_numeric(
    df: DataFrame, features: list[str], side: str = "side", bins: int = 10, exact: bool = True
) -> DataFrame:
    """PSI over quantile bins of the reference rows. ``exact=False`` takes one-pass sketches."""
    entries = [F.struct(F.lit(f).alias("feature"), number_or_null(f).alias("value")) for f in features]
    # Kept once: the quantiles and the bins both read these (feature, value) counts.
    counts = written(_counts(df, entries, side).filter("value is not null"), "psi-counts")
    probs = [i / bins for i in range(bins + 1)]
    if exact:
        edges = exact_quantiles(counts, ["feature"], "value", probs, weight="ref")
    else:
        reference = df.filter(F.col(side) == REFERENCE).select(F.inline(F.array(*entries)))
        edges = approx_quantiles(reference, ["feature"], "value", probs)
    cuts = _cuts(edges, counts.filter("ref > 0"))
    value = F.col("value")
    inside = F.coalesce(F.size(F.filter("cuts", lambda e: e <= value)), F.lit(0))
    binned = (
        counts.join(F.broadcast(cuts), "feature", "left")  # one row per monitored feature
        .groupBy("feature", inside.alias("bin"))
        .agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    )
    # A feature without any number on either side has index 0.
    listed = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return listed.join(_psi(binned), "feature", "left").withColumn("psi", F.coalesce("psi", F.lit(0.0)))


def psi_categorical(df: DataFrame, features: list[str], side: str = "side") -> DataFrame:
    """PSI over categories; null is a category of its own."""
    entries = [
        F.struct(F.lit(f).alias("feature"), F.coalesce(F.col(f).cast("string"), F.lit("nan")).alias("value"))
        for f in features
    ]
    return _psi(_counts(df, entries, side))


def feature_drift(
    df: DataFrame, numeric: list[str] = MONITOR_NUMERIC, categorical: list[str] = MONITOR_CATEGORICAL,
    side: str = "side", cfg: Settings = DEFAULTS,
) -> DataFrame:
    """feature, type, psi, band, drifted. The flag compares the unrounded index."""
    parts = [
        psi_numeric(df, numeric, side).withColumn("type", F.lit("numeric")),
        psi_categorical(df, categorical, side).withColumn("type", F.lit("categorical")),
    ]
    return parts[0].unionByName(parts[1]).select(
        "feature", "type", rounded("psi", 4).alias("psi"), psi_band("psi").alias("band"),
        (F.col("psi") > cfg.psi_drifted_above).alias("drifted"),
    )


def drift_summary(features: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Counts, rounded share and the drifted features by index; one row."""
    hits = F.filter(
        F.array_sort(  # one entry per monitored feature
            F.collect_list(F.struct((-F.col("psi")).alias("k"), "feature", "drifted"))
        ),
        lambda e: e["drifted"],
    )
    return features.agg(
        F.lit(cfg.psi_drifted_above).alias("threshold"),
        F.count("*").alias("n_features"),
        F.count_if("drifted").alias("n_drifted"),
        rounded(F.count_if("drifted") / F.count("*"), 3).alias("share_drifted"),
        F.array_join(F.transform(hits, lambda e: e["feature"]), ",").alias("drifted_features"),
    )


def prediction_drift(df: DataFrame, score: str = "churn_probability", side: str = "side", cfg: Settings = DEFAULTS) -> DataFrame:
    return psi_numeric(df, [score], side).select(
        rounded("psi", 4).alias("psi"), psi_band("psi").alias("band"),
        (F.col("psi") > cfg.psi_drifted_above).alias("drifted"), F.lit(cfg.psi_drifted_above).alias("threshold"),
    )


def drift_report(
    df: DataFrame, score: str | None = "churn_probability", side: str = "side", scenario: str = "reference-vs-current",
    cfg: Settings = DEFAULTS,
) -> DataFrame:
    """One row: status, feature summary, prediction index. The share is compared after rounding.

    The score is measured in the same pass as the numeric features.
    """
    numeric = [*MONITOR_NUMERIC, score] if score else MONITOR_NUMERIC
    return report_of(feature_drift(df, numeric, side=side, cfg=cfg), score, scenario, cfg)


def report_of(features: DataFrame, score: str | None, scenario: str, cfg: Settings = DEFAULTS) -> DataFrame:
    """The report over the measured features, the score among them."""
    measured = written(features, "drift")  # one row per feature
    is_score = F.col("feature") == (score or "")
    predicted = measured.filter(is_score).select(F.struct("psi", "drifted")).scalar()
    retrain = (F.col("share_drifted") > cfg.max_drifted_share) | F.coalesce(F.col("_p.drifted"), F.lit(False))
    return (
        drift_summary(measured.filter(~is_score), cfg)
        .withColumn("_p", predicted)
        .withColumns(
            {
                "scenario": F.lit(scenario),
                "status": F.when(retrain, "RETRAINING_REQUIRED").otherwise("STABLE"),
                "prediction_psi": F.col("_p.psi"),
            }
        )
        .drop("_p")
    )
