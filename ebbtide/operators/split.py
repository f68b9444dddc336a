"""Stratified train/validation/test split and the statistics fitted on the train rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.functions.numeric import exact_avg, rounded_total
from ebbtide.operators.explore import numeric_long
from ebbtide.operators.ordered import exact_quantiles, with_running_totals
from ebbtide.vocab import ID, NUMERIC, TARGET

_HEX_DIGITS = 8


def draw(key: Column, seed: int) -> Column:
    """A reproducible pseudo-random hex string per row, the same in every engine."""
    return F.md5(F.concat(key.cast("string"), F.lit(str(seed))))


def _hex_bound(share: float) -> str:
    return f"{min(round(share * 16**_HEX_DIGITS), 16**_HEX_DIGITS - 1):0{_HEX_DIGITS}x}"


def split_by_hash(df: DataFrame, key: str = ID, cfg: Settings = DEFAULTS) -> DataFrame:
    """Row-wise split: no shuffle, stable as rows arrive, sizes and label shares as expected values."""
    h = F.substring(draw(F.col(key), cfg.seed), 1, _HEX_DIGITS)
    return df.withColumn(
        "split",
        F.when(h < _hex_bound(cfg.train_share), "train")
        .when(h < _hex_bound(cfg.train_share + cfg.validation_share), "val")
        .otherwise("test"),
    )


def split_exact(df: DataFrame, key: str = ID, label: str = TARGET, cfg: Settings = DEFAULTS) -> DataFrame:
    """Split with exact shares of every label, from a global rank per label."""
    drawn = df.withColumn("_draw", draw(F.col(key), cfg.seed))
    ranked = with_running_totals(drawn, [F.col("_draw"), F.col(key)], {"_rank": F.lit(1)}, within=[label])
    test = F.floor(F.col("_rank_all") * cfg.test_share + 0.5)
    val = F.floor(F.col("_rank_all") * cfg.validation_share + 0.5)
    rank = F.col("_rank")
    return ranked.withColumn(
        "split", F.when(rank <= test, "test").when(rank <= test + val, "val").otherwise("train")
    ).drop("_draw", "_rank", "_rank_all")


def split_summary(df: DataFrame, label: str = TARGET) -> DataFrame:
    return df.groupBy("split").agg(
        F.count("*").alias("n"), rounded_total(F.sum(label) / F.count("*"), 4).alias("churn_rate")
    )


def overlapping_ids(df: DataFrame, key: str = ID) -> DataFrame:
    """Ids that occur in more than one split; empty for a leak-free split."""
    return df.groupBy(key).agg(F.count_distinct("split").alias("n_splits")).filter("n_splits > 1")


def scaling_statistics(df: DataFrame, columns: list[str] = NUMERIC) -> DataFrame:
    """Median for imputing, then mean and population deviation after imputing, per feature,
    fitted on the train rows only."""
    train = numeric_long(df.filter("split = 'train'"), columns, [])
    medians = exact_quantiles(train, ["field"], "v", [0.5]).select(
        "field", F.element_at("edges", 1).alias("median")
    )
    filled = train.join(F.broadcast(medians), "field").withColumn("v", F.coalesce("v", "median"))  # one row per feature
    return filled.groupBy("field", "median").agg(
        exact_avg("v").alias("mean"), F.stddev_pop("v").alias("stddev")
    )


def standardised(df: DataFrame, columns: list[str], suffix: str = "_z") -> DataFrame:
    """Z-scores over all rows (population deviation); constant columns become 0."""
    facts = df.agg(
        F.struct(
            *[exact_avg(c).alias(f"m_{c}") for c in columns],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
        ).alias("f")
    ).scalar()
    with_facts = df.withColumn("_f", facts)
    return with_facts.withColumns(
        {
            f"{c}{suffix}": F.coalesce(
                F.try_divide(F.col(c) - F.col(f"_f.m_{c}"), F.nullif(F.col(f"_f.s_{c}"), F.lit(0.0))), F.lit(0.0)
            )
            for c in columns
        }
    ).drop("_f")
