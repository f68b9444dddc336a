"""A bounded sample of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Up to ``most`` labelled documents (``text``, ``label``), by the smallest hashes of their ids: the same at every run.

    Rows without an id or a label don't count; of contradicting labels the smaller holds.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.min(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("_id", F.lit(5)), "_id").limit(most)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "_id").select("text", "label").orderBy(F.xxhash64("text"), "label").limit(most)
