"""The bounded running sum of a customer's events: p <- min(1, max(0, p + delta)).

Each event is the map x -> min(hi, max(lo, x + d)); such maps compose into maps of the same
form. So a customer's history can be cut into slices of the global (customer, time) order,
folded slice by slice in parallel, and the slices folded again: a customer who holds a third of
all events is spread over a third of the tasks, and no task ever holds a whole history.

Amounts are integers in units of 1e-9, so every grouping of the composition gives equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.risk import event_delta
from ebbtide.operators.ordered import _PART, _SLOT, range_count, range_numbered
from ebbtide.operators.skew import spread_join
from ebbtide.session import counted, written

UNIT = 1_000_000_000
_MAP = ["_d", "_lo", "_hi"]
_IDENTITY = (0, 0, UNIT)


def prefix_maps(
    owner: np.ndarray, d: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None, first=None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Composition of all maps up to each row, restarted where the owner changes.

    ``first`` continues the first owner's run from an earlier batch. Doubling steps keep it
    vectorised: after step s each row has absorbed its 2**s predecessors.
    """
    n = len(d)
    d = d.astype(np.int64)
    lo = np.zeros(n, np.int64) if lo is None else lo.astype(np.int64)
    hi = np.full(n, UNIT, np.int64) if hi is None else hi.astype(np.int64)

    def after(rows, fd, flo, fhi):
        return (
            fd + d[rows],
            np.minimum(hi[rows], np.maximum(lo[rows], flo + d[rows])),
            np.minimum(hi[rows], np.maximum(lo[rows], fhi + d[rows])),
        )

    starts = np.empty(n, bool)
    starts[0], starts[1:] = True, owner[1:] != owner[:-1]
    offset = np.arange(n) - np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    if first is not None:
        d[0], lo[0], hi[0] = after(0, *first)
    step, longest = 1, int(offset.max())
    while step <= longest:
        rows = np.nonzero(offset >= step)[0]
        d[rows], lo[rows], hi[rows] = after(rows, d[rows - step], lo[rows - step], hi[rows - step])
        step *= 2
    return d, lo, hi


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by owner: replace each row's map by the composition up to it, and add the
    composition before it. State between batches is one map, so memory does not grow with the
    partition."""
    last_owner, last = None, None
    for pdf in batches:
        if pdf.empty:
            continue
        owner = pdf["customer_id"].to_numpy()
        carried = last if last is not None and owner[0] == last_owner else None
        composed = prefix_maps(owner, *(pdf[c].to_numpy() for c in _MAP), carried)
        fresh = np.empty(len(pdf), bool)
        fresh[0], fresh[1:] = True, owner[1:] != owner[:-1]
        for name, values, identity in zip(_MAP, composed, _IDENTITY):
            before = np.where(fresh, identity, np.concatenate(([identity], values[:-1])))
            if carried is not None:
                before[0] = carried[_MAP.index(name)]
            pdf[f"{name}_before"], pdf[name] = before, values
        last_owner, last = owner[-1], tuple(int(v[-1]) for v in composed)
        yield pdf


def _composed(rows: DataFrame) -> DataFrame:
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]
    return rows.mapInPandas(_scan, ", ".join([*fields, *[f"{m}_before long" for m in _MAP]]))


def _scanned(events: DataFrame, order: list[str], parts: int | None) -> DataFrame:
    """Events in ranges of the global (customer, order) order with the maps composed within each
    range; the range shuffle, the scan and the write are one job."""
    known = events.filter(F.col("customer_id").isNotNull()).withColumns(
        {
            "_d": (event_delta("event_type") * F.lit(UNIT)).cast("long"),
            "_lo": F.lit(0).cast("long"),
            "_hi": F.lit(UNIT).cast("long"),
        }
    )
    source, rows = counted(known, "events")
    keys = [F.col("customer_id"), *[F.col(c) for c in order]]
    return written(_composed(range_numbered(source, keys, parts or range_count(source, rows))), "risk-scan")


def _slices(scanned: DataFrame) -> DataFrame:
    """One row per (customer, range): the map of the slice, and of all the customer's earlier
    slices. A customer has at most one slice per range, so even the busiest one is small here."""
    maps = scanned.groupBy("customer_id", _PART).agg(
        *[F.max_by(m, _SLOT).alias(m) for m in _MAP], F.count("*").alias("n")
    )
    return _composed(maps.repartition("customer_id").sortWithinPartitions("customer_id", _PART))


def _opened(start: DataFrame) -> DataFrame:
    return start.withColumn("_p0", (F.col("churn_probability").cast("decimal(18,9)") * UNIT).cast("long"))


def _apply(p: Column, suffix: str = "") -> Column:
    return F.least(F.col(f"_hi{suffix}"), F.greatest(F.col(f"_lo{suffix}"), p + F.col(f"_d{suffix}")))


def _as_probability(units: Column) -> Column:
    return (units.cast("decimal(18,0)") / UNIT).cast("decimal(18,9)")


def risk_path(
    events: DataFrame, start: DataFrame, order: list[str] = ("timestamp", "event_id"), parts: int | None = None
) -> DataFrame:
    """Each event of a known customer with the probability before and after it.

    ``start`` holds customer_id, churn_probability and whatever columns should be carried along.
    Events of unknown customers do not appear; see :func:`unknown_customer_events`.
    """
    scanned = _scanned(events, order, parts)
    carried = [c for c in start.columns if c not in ("customer_id", "churn_probability")]
    entry = (
        _slices(scanned)
        .join(_opened(start), "customer_id")
        .select("customer_id", _PART, *carried, _apply(F.col("_p0"), "_before").alias("_entry"))
    )
    # Joined per (customer, range): a busy customer's events stay spread over many tasks.
    return scanned.join(entry, ["customer_id", _PART]).select(
        *events.columns,
        *carried,
        _as_probability(_apply(F.col("_entry"), "_before")).alias("previous_probability"),
        _as_probability(_apply(F.col("_entry"))).alias("new_probability"),
    )


def final_risk(
    events: DataFrame, start: DataFrame, order: list[str] = ("timestamp", "event_id"), parts: int | None = None
) -> DataFrame:
    """Probability of every customer after all its events; without events the start value.

    Only the slice maps are brought together per customer, never the events.
    """
    narrow = events.select(*dict.fromkeys(["customer_id", "event_type", *order]))
    whole = (
        _slices(_scanned(narrow, order, parts))
        .groupBy("customer_id")
        .agg(*[F.max_by(m, _PART).alias(m) for m in _MAP], F.sum("n").cast("long").alias("n_events"))
    )
    p = F.when(F.col("_d").isNull(), F.col("_p0")).otherwise(_apply(F.col("_p0")))
    return (
        _opened(start)
        .join(whole, "customer_id", "left")
        .withColumns({"current_probability": _as_probability(p), "n_events": F.coalesce("n_events", F.lit(0))})
        .drop("_p0", *_MAP)
    )


def unknown_customer_events(events: DataFrame, start: DataFrame) -> DataFrame:
    """Events whose customer is not scored: the reject side output."""
    known = start.select("customer_id")
    if events.isStreaming:
        return events.join(known, "customer_id", "left_anti")
    return spread_join(events, known, "customer_id", F.col("event_id"), how="left_anti")
