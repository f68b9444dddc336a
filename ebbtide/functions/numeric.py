"""Rounding, safe casts and small column builders."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c: Column | str, digits: int) -> Column:
    """Half-up rounding of one row's value, through a compact decimal."""
    return F.round(as_col(c).cast("decimal(18,6)"), digits).cast("double")


def rounded_total(c: Column | str, digits: int) -> Column:
    """Half-up rounding of an aggregate, which may exceed the compact decimal."""
    return F.round(as_col(c).cast("decimal(38,6)"), digits).cast("double")


def exact_sum(c: Column | str) -> Column:
    """A sum that does not depend on task order: added as decimals, returned as double."""
    return F.sum(as_col(c).cast("decimal(18,6)")).cast("double")


def exact_avg(c: Column | str) -> Column:
    c = as_col(c)
    return exact_sum(c) / F.nullif(F.count(c), F.lit(0))


def number_or_null(c: Column | str) -> Column:
    """Numeric value of a text or numeric column; anything else becomes null."""
    return F.trim(as_col(c).cast("string")).try_cast("double")


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def count_of(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def added(columns) -> Column:
    return reduce(add, columns)


def banded(c: Column | str, bands, above_zero_from: float = -1, other=None) -> Column:
    """Right-closed bands ``(previous, upper] -> label``; outside values get ``other``."""
    c = as_col(c)
    expr = F.when(c <= above_zero_from, F.lit(other))
    for upper, label in bands:
        expr = expr.when(c <= upper, F.lit(label))
    return expr.otherwise(F.lit(other))


def looked_up(c: Column | str, mapping: dict, default) -> Column:
    """Literal map lookup with a default (small fixed maps only)."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), as_col(c)), F.lit(default))
