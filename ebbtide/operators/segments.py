"""Cluster profiles, labels and the choice of k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.numeric import exact_avg, rounded, rounded_total
from ebbtide.operators.explore import numeric_long
from ebbtide.operators.ordered import exact_quantiles
from ebbtide.vocab import ID, TARGET


def profile_clusters(df: DataFrame) -> DataFrame:
    """Profile per cluster; value and risk labels compare the cluster mean with the overall median."""
    medians = exact_quantiles(
        numeric_long(df, ["MonthlyCharges", "churn_probability"], []), ["field"], "v", [0.5]
    )
    median_of = medians.agg(
        F.map_from_entries(F.collect_list(F.struct("field", F.element_at("edges", 1).alias("m")))).alias("m")
    ).scalar()
    rows = df.agg(F.count("*").alias("n")).scalar()
    means = df.groupBy("cluster").agg(
        F.count("*").alias("size"),
        exact_avg("tenure").alias("tenure"),
        exact_avg("MonthlyCharges").alias("monthly"),
        exact_avg("TotalCharges").alias("total"),
        exact_avg("service_adoption_score").alias("adoption"),
        exact_avg("churn_probability").alias("p"),
        exact_avg(TARGET).alias("churned"),
    )
    value = F.when(F.col("monthly") >= F.element_at("_m", F.lit("MonthlyCharges")), "High-value").otherwise("Low-value")
    risk = F.when(F.col("p") >= F.element_at("_m", F.lit("churn_probability")), "high-risk").otherwise("low-risk")
    return means.withColumn("_m", median_of).select(
        "cluster",
        "size",
        rounded_total(F.col("size") / rows * 100, 1).alias("pct"),
        rounded("tenure", 1).alias("avg_tenure"),
        rounded("monthly", 2).alias("avg_monthly_charges"),
        rounded("total", 2).alias("avg_total_charges"),
        rounded("adoption", 3).alias("avg_service_adoption"),
        rounded("p", 4).alias("avg_churn_probability"),
        rounded("churned", 4).alias("actual_churn_rate"),
        F.concat_ws("/", value, risk).alias("label"),
    )


def segment_table(clustered: DataFrame, profile: DataFrame) -> DataFrame:
    """Customer, cluster, label, probability. The profile has one row per cluster."""
    labels = profile.select("cluster", F.col("label").alias("segment_label"))
    return clustered.join(F.broadcast(labels), "cluster").select(
        ID, "cluster", "segment_label", rounded("churn_probability", 4).alias("churn_probability")
    )


def suggest_k(table: DataFrame) -> DataFrame:
    """k with the highest silhouette; the smaller k on a tie."""
    return table.agg(F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("k"))
