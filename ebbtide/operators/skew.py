"""Equi-join of a skewed row table with a table that has few rows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heavy_keys(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """Keys that alone hold more than one partition's fair share, at most ``parts`` of them, and how many
    shares (``_shares``).

    Counts are combined before the shuffle, so a hot key travels as one row per task.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("n")).scalar()
    return counts.filter(F.col("_n") * F.lit(parts) > total).select(
        key, F.ceil(F.col("_n") * F.lit(parts) / total).cast("int").alias("_shares")
    )


def spread_join(
    rows: DataFrame, lookup: DataFrame, key: str, spread_by: Column, how: str = "inner"
) -> DataFrame:
    """Join where a key of ``rows`` may hold a large share of them.

    Rows of a heavy key are spread by a hash of ``spread_by`` over as many tasks as the key has
    partitions' shares, so that no task gets more than about one share of it; only the lookup rows of heavy keys are repeated. The list of heavy keys is at most one per shuffle
    partition, which is why it may be broadcast. All other keys join as usual.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(heavy_keys(rows, key, parts).withColumn("_hot", F.lit(True)))
    spread = F.col("_hot") | F.col(key).isNull()  # a null key meets nothing, so it may lie anywhere
    salted = rows.join(hot, key, "left").withColumn(
        "_salt", F.when(spread, F.pmod(F.xxhash64(spread_by), F.coalesce("_shares", F.lit(parts)))).otherwise(0).cast("int")
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.col("_shares") - 1)).otherwise(F.array(F.lit(0)))
    repeated = lookup.join(hot, key, "left").withColumn("_salt", F.explode(copies))
    return salted.drop("_hot", "_shares").join(repeated.drop("_hot", "_shares"), [key, "_salt"], how).drop("_salt")
