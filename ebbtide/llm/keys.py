"""Keys by which a decision on a row finds the row again, though ids may be null or repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def row_keys(id_col: str, text_col: str) -> dict[str, Column]:
    """Columns without nulls in which rows agree that have the same id, or none, and the same text (null: empty)."""
    return {**id_keys(F.col(id_col).cast("long")), "_key": text_key(text_col)}


def packed(docs: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``docs`` as one struct ``row`` beside its keys, so that keys never meet columns of the same name; ``unpacked`` undoes it."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(c.alias(n) for n, c in keys.items()))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def id_keys(number: Column) -> dict[str, Column]:
    return {"_id": F.coalesce(number, F.lit(0)), "_none": number.isNull()}
