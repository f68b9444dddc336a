"""Connected components by label passing and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.session import written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (its component's smallest node) for every node of ``edges`` (``a``, ``b``: long).

    Labels move along edges and from label to label, so rounds grow with the logarithm of the longest path. Every step is an
    aggregate or a join with one row for each node on one side; each round is written, and only a count reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both, "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("label").alias("seen"))
        near = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("near"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        moved = labels.join(near, "node").join(far, "label").select("node", F.least("near", "far", "label").alias("next"), "label")
        moved = written(moved, "labels")
        stable = moved.filter("next < label").isEmpty()
        labels = moved.select("node", F.col("next").alias("label"))
        if stable:
            return labels
