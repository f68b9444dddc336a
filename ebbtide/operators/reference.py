"""Stored profiles of reference rows: a drift run reads the current rows once, and the reference rows not at all.

A profile is a small table: for each monitored feature its type, the inner bin edges of a number, and the count of each bin or
category. Profiles over the same edges add up, so a reference that grows by days is the sum of the days' profiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.functions.numeric import number_or_null, rounded
from ebbtide.operators.drift import _cuts, _psi, psi_band, report_of
from ebbtide.operators.ordered import exact_quantiles
from ebbtide.session import written
from ebbtide.vocab import MONITOR_CATEGORICAL, MONITOR_NUMERIC

PROFILE = "feature string, type string, cuts array<double>, cell string, n long"
_CELL = ["feature", "type", "cell"]


def _category(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("nan"))


def _bin(value: Column, cuts: Column) -> Column:
    """Bin of a number: how many inner edges it has reached; all numbers of a feature without edges share one bin."""
    return F.when(value.isNotNull(), F.coalesce(F.size(F.filter(cuts, lambda e: e <= value)), F.lit(0)).cast("string"))


def profile_of(
    reference: DataFrame, numeric: list[str] = MONITOR_NUMERIC, categorical: list[str] = MONITOR_CATEGORICAL, bins: int = 10
) -> DataFrame:
    """Profile of reference rows, with exact quantile edges. A feature without values has one row with count 0."""
    spark = reference.sparkSession
    numbers = [F.struct(F.lit(f).alias("feature"), number_or_null(f).alias("value")) for f in numeric]
    counts = reference.select(F.inline(F.array(*numbers))).filter("value is not null").groupBy("feature", "value").agg(F.count("*").alias("ref"))
    counts = written(counts, "profile-counts")
    edges = exact_quantiles(counts, ["feature"], "value", [i / bins for i in range(bins + 1)], weight="ref")
    cuts = written(_cuts(edges, counts), "profile-cuts")  # one row per monitored feature
    binned = counts.join(F.broadcast(cuts), "feature").groupBy("feature", "cuts", _bin(F.col("value"), F.col("cuts")).alias("cell")).agg(F.sum("ref").alias("n"))
    listed = spark.createDataFrame([(f,) for f in numeric], "feature string")
    filled = listed.join(binned, "feature", "left").select("feature", F.lit("numeric").alias("type"), "cuts", "cell", F.coalesce("n", F.lit(0)).alias("n"))
    no_cuts = F.lit(None).cast("array<double>").alias("cuts")
    texts = [F.struct(F.lit(f).alias("feature"), F.lit("categorical").alias("type"), no_cuts, _category(f).alias("cell")) for f in categorical]
    kinds = spark.createDataFrame([(f, "categorical", None, None, 0) for f in categorical], PROFILE)
    counted = reference.select(F.inline(F.array(*texts))).groupBy("feature", "type", "cuts", "cell").agg(F.count("*").alias("n"))
    return filled.unionByName(counted).unionByName(kinds)


def counted_by(profile: DataFrame, rows: DataFrame) -> DataFrame:
    """Profile of other rows in the bins of ``profile``: one pass, one combined count. The edges (a row per monitored feature) are
    read first and become part of the plan."""
    features = profile.groupBy("feature", "type").agg(F.first("cuts", ignorenulls=True).alias("cuts")).collect()
    spark, cells = rows.sparkSession, []
    for r in features:
        literal = F.array(*[F.lit(c) for c in r["cuts"] or []]).cast("array<double>")
        cuts = literal if r["cuts"] is not None else F.lit(None).cast("array<double>")
        cell = _bin(number_or_null(r["feature"]), cuts) if r["type"] == "numeric" else _category(r["feature"])
        cells.append(F.struct(F.lit(r["feature"]).alias("feature"), F.lit(r["type"]).alias("type"), cell.alias("cell")))
    if not cells:
        return spark.createDataFrame([], PROFILE)
    counts = rows.select(F.inline(F.array(*cells))).filter("cell is not null").groupBy(*_CELL).agg(F.count("*").alias("n"))
    edges = spark.createDataFrame([(r["feature"], r["type"], r["cuts"]) for r in features], "feature string, type string, cuts array<double>")
    return edges.join(counts, ["feature", "type"], "left").select("feature", "type", "cuts", "cell", F.coalesce("n", F.lit(0)).alias("n"))


def merged(*profiles: DataFrame) -> DataFrame:
    """The sum of profiles over the same edges; other edges are an error when it is read."""
    every = profiles[0]
    for p in profiles[1:]:
        every = every.unionByName(p)
    same = F.assert_true(F.min("cuts").eqNullSafe(F.max("cuts")), "profiles have different edges")
    edges = every.groupBy("feature", "type").agg(F.max("cuts").alias("cuts"), same.alias("_same")).filter("_same is null").drop("_same")
    counts = every.groupBy(*_CELL).agg(F.sum("n").alias("n"))
    return counts.join(edges, ["feature", "type"]).select("feature", "type", "cuts", "cell", "n")


def drift_against(profile: DataFrame, current: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """feature, type, psi, band, drifted of the current rows against a stored profile; equal to ``drift.feature_drift`` over both."""
    sides = [
        frame.select(*_CELL, F.col("n").alias("ref") if k == 0 else F.lit(0).alias("ref"), F.col("n").alias("cur") if k else F.lit(0).alias("cur"))
        for k, frame in enumerate((profile, written(counted_by(profile, current), "profile-current")))
    ]
    cells = sides[0].unionByName(sides[1]).withColumn("feature", F.struct("feature", "type")).groupBy("feature", "cell").agg(
        F.sum("ref").alias("ref"), F.sum("cur").alias("cur")
    )
    return _psi(cells).select(
        "feature.feature", "feature.type", rounded("psi", 4).alias("psi"), psi_band("psi").alias("band"), (F.col("psi") > cfg.psi_drifted_above).alias("drifted")
    )


def report_against(profile: DataFrame, current: DataFrame, score: str | None = "churn_probability", scenario: str = "stored-profile", cfg: Settings = DEFAULTS) -> DataFrame:
    """The drift report of the current rows; ``profile`` holds the score as one of its numbers."""
    return report_of(drift_against(profile, current, cfg), score, scenario, cfg)
