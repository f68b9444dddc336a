"""Churn-rate tables, numeric summaries, histograms and box-plot statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.numeric import banded, count_of, exact_avg, rounded, rounded_total
from ebbtide.functions.risk import at_risk
from ebbtide.operators.ordered import exact_quantiles
from ebbtide.vocab import CATEGORICAL, TARGET, TENURE_BANDS


def _rates() -> list[Column]:
    return [
        F.count("*").alias("n_customers"),
        F.sum(TARGET).cast("long").alias("n_churned"),
        rounded_total(F.sum(TARGET) / F.count("*"), 4).alias("churn_rate"),
    ]


def overall_churn(clean: DataFrame) -> DataFrame:
    return clean.agg(*_rates()).withColumn("n_retained", F.col("n_customers") - F.col("n_churned"))


def churn_by(clean: DataFrame, by: Column | str) -> DataFrame:
    return clean.groupBy(by).agg(*_rates())


def churn_by_every_category(clean: DataFrame, columns: list[str] = CATEGORICAL) -> DataFrame:
    """All category tables at once: one scan, one shuffle, long format."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns])
    return clean.select(TARGET, F.inline(pairs)).groupBy("field", "value").agg(*_rates())


def churn_by_tenure_band(clean: DataFrame) -> DataFrame:
    band = banded("tenure", TENURE_BANDS, above_zero_from=-0.1)
    return churn_by(clean.withColumn("tenure_band", band).filter("tenure_band is not null"), "tenure_band")


def churn_by_charge_band(clean: DataFrame, bands: int = 5) -> DataFrame:
    """Equal-frequency bands with exact edges; repeated edges are merged."""
    probs = [i / bands for i in range(bands + 1)]
    keyed = clean.select(F.lit("MonthlyCharges").alias("field"), F.col("MonthlyCharges").alias("v"))
    edges = exact_quantiles(keyed, ["field"], "v", probs).select(F.array_distinct("edges").alias("e")).scalar()
    charge = F.col("MonthlyCharges")
    banded_rows = clean.filter(charge.isNotNull()).withColumn("_edges", edges).withColumn(
        "charge_band", F.greatest(F.lit(1), F.size(F.filter("_edges", lambda e: e < charge)))
    )
    return (
        banded_rows.withColumns(
            {"lower": F.element_at("_edges", F.col("charge_band")), "upper": F.element_at("_edges", F.col("charge_band") + 1)}
        )
        .groupBy("charge_band", "lower", "upper")
        .agg(*_rates())
    )


def numeric_long(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("v")) for c in columns])
    return df.select(*keep, F.inline(pairs))


def numeric_summary_by_churn(clean: DataFrame, columns=("tenure", "MonthlyCharges", "TotalCharges")) -> DataFrame:
    """Mean and exact median per outcome in long format."""
    long = numeric_long(clean, list(columns), [TARGET])
    means = long.groupBy(TARGET, "field").agg(rounded_total(exact_avg("v"), 2).alias("mean"))
    medians = exact_quantiles(long, [TARGET, "field"], "v", [0.5])
    return means.join(medians, [TARGET, "field"]).select(
        TARGET, "field", "mean", rounded(F.element_at("edges", 1), 2).alias("median")
    )


def correlations(clean: DataFrame, columns=("tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen", TARGET)) -> DataFrame:
    """Pearson matrix in long format from one pass."""
    typed = clean.select(*[F.col(c).cast("double").alias(c) for c in columns])
    cells = typed.agg(
        F.array(
            *[
                F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), rounded_total(F.corr(a, b), 3).alias("r"))
                for a in columns
                for b in columns
            ]
        ).alias("cells")
    )
    return cells.select(F.inline("cells"))


def dashboard_kpis(valued: DataFrame) -> DataFrame:
    return valued.agg(
        F.count("*").alias("total_customers"),
        F.sum(TARGET).cast("long").alias("churned_customers"),
        rounded_total(F.sum(TARGET) / F.count("*"), 4).alias("churn_rate"),
        count_of(at_risk("risk_level")).alias("high_risk_customers"),
        rounded_total(F.sum(F.col("revenue_at_risk").cast("decimal(18,6)")), 2).alias("total_revenue_at_risk"),
        rounded_total(exact_avg("churn_probability"), 4).alias("average_churn_probability"),
        *[count_of(F.col("risk_level") == name).alias(f"n_{name.lower()}") for name in ("LOW", "MEDIUM", "HIGH", "CRITICAL")],
    )


def histogram(df: DataFrame, column: str, bins: int, by: str) -> DataFrame:
    """Equal-width bins over each group's own range; the last bin is closed.

    ``by`` has few values (outcomes, levels): their ranges fit in one map.
    """
    v = F.col(column)
    rows = df.filter(v.isNotNull())
    ranges = (
        rows.groupBy(by)
        .agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count("*").alias("n")).alias("r"))
        .agg(F.map_from_entries(F.collect_list(F.struct(by, "r"))).alias("ranges"))
        .scalar()
    )
    ranged = rows.withColumn("_r", F.element_at(ranges, F.col(by)))
    flat = F.col("_r.lo") == F.col("_r.hi")
    lo = F.when(flat, F.col("_r.lo") - 0.5).otherwise(F.col("_r.lo")).cast("double")
    width = F.when(flat, F.lit(1.0)).otherwise(F.col("_r.hi") - F.col("_r.lo")) / bins
    at = F.floor((v - F.col("lower")) / F.col("width")).cast("int")
    return (
        ranged.withColumns({"lower": lo, "width": width})
        .withColumn("bin", F.least(F.lit(bins - 1), at))
        .groupBy(by, "bin", "lower", "width", F.col("_r.n").alias("rows"))
        .agg(F.count("*").alias("n"))
        .select(
            by, "bin", "n",
            rounded(F.col("lower") + F.col("bin") * F.col("width"), 4).alias("bin_start"),
            rounded(F.col("n") / (F.col("rows") * F.col("width")), 6).alias("density"),
        )
    )


def box_statistics(df: DataFrame, column: str, by: str = TARGET) -> DataFrame:
    """Quartiles, whiskers (last data within 1.5 IQR) and outlier count per group."""
    long = df.select(by, F.col(column).cast("double").alias("v")).filter("v is not null")
    quartiles = exact_quantiles(long, [by], "v", [0.25, 0.5, 0.75])
    box = quartiles.agg(F.map_from_entries(F.collect_list(F.struct(by, "edges"))).alias("m")).scalar()
    q = F.col("_q")
    low, high = q[0] - 1.5 * (q[2] - q[0]), q[2] + 1.5 * (q[2] - q[0])
    inside = F.col("v").between(low, high)
    return (
        long.withColumn("_q", F.element_at(box, F.col(by)))
        .groupBy(by, "_q")
        .agg(
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            count_of(~inside).alias("n_outliers"),
        )
        .select(
            by, rounded(q[0], 4).alias("q1"), rounded(q[1], 4).alias("median"), rounded(q[2], 4).alias("q3"),
            "whisker_low", "whisker_high", "n_outliers",
        )
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))
