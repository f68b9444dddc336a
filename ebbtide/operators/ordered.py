"""Global order without an unbounded single-task window: rank, NTILE, running totals, quantiles.

A window without PARTITION BY moves every row to one task. Instead the rows are range-partitioned
on the full sort key (so equal values of a hot key spread over tasks through the tie-break),
numbered inside their range, and shifted by the small table of range sizes, at every size alike.

The input is written once to the shared scratch folder before anything else, and counted by the tasks that write it: the
range sampling and the sort then read narrow written rows instead of recomputing their source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ebbtide.session import counted, written

RANGE_ROWS = 10_000_000  # most rows per range
_SLOT = "_slot"
_PART = "_part"
_ROW = "_row"
_OFFSET_BITS = 33  # layout of monotonically_increasing_id


def range_count(df: DataFrame, rows: int) -> int:
    """Ranges for this many rows: the session's shuffle partitions, and more when rows demand it."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANGE_ROWS))


def range_numbered(df: DataFrame, order: list[Column], parts: int) -> DataFrame:
    """Rows range-partitioned and sorted on ``order`` with their range number ``_part`` and their
    position ``_slot`` in it.

    The sampled range bounds may differ between two evaluations, so the numbering is only
    meaningful once it is written down: see :func:`range_sorted`.
    """
    return (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn(_PART, F.shiftright("_mid", _OFFSET_BITS).cast("int"))
        .withColumn(_SLOT, F.col("_mid").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1)))
        .drop("_mid")
    )


def range_sorted(df: DataFrame, order: list[Column], parts: int) -> DataFrame:
    """:func:`range_numbered`, written once to the shared scratch folder."""
    return written(range_numbered(df, order, parts), "ordered")


def _range_starts(sizes: DataFrame, totals: list[str], within: list[str]) -> DataFrame:
    """Per range, the totals of all earlier ranges and of the whole group: one row per range (and
    group)."""
    whole = W.partitionBy(*within)
    before = whole.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    return sizes.select(
        *within,
        _PART,
        *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(f"_{t}_before") for t in totals],
        *[F.sum(t).over(whole).alias(f"{t}_all") for t in totals],
    )


def with_ranks(df: DataFrame, ranks: dict[str, list[Column]], total: str | None = None) -> DataFrame:
    """1-based global row numbers, one per named order, and optionally the row count.

    Every order must end in a unique tie-break. Rows are written once with a number of their own; what is range-partitioned
    and sorted for an order are that number and the order's columns, and the ranks come back by a join on the number.
    """
    source, rows = counted(df.withColumn(_ROW, F.monotonically_increasing_id()), "ranked")
    out = source
    for k, (name, order) in enumerate(ranks.items()):
        placed = written(range_numbered(source, order, range_count(source, rows)).select(_ROW, _PART, _SLOT), "ordered")
        sizes = placed.groupBy(_PART).agg(F.count("*").alias("n"))
        starts = _range_starts(sizes, ["n"], [])  # one row per range: bounded by the partition count
        number = (F.col("_n_before") + F.col(_SLOT) + 1).alias(name)
        whole = [F.col("n_all").alias(total)] if total and not k else []
        out = out.join(placed.join(F.broadcast(starts), _PART).select(_ROW, number, *whole), _ROW)
    kept = [*df.columns, *([total] if total else []), *ranks]
    return out.select(*(F.col(f"`{c}`") for c in kept))


def with_rank(df: DataFrame, order: list[Column], name: str = "rank", total: str | None = None) -> DataFrame:
    return with_ranks(df, {name: order}, total)


def tile_of(rank: Column, rows: Column, tiles: int) -> Column:
    """NTILE number from a 1-based rank: the first ``rows % tiles`` tiles hold one row more."""
    size = F.floor(rows / F.lit(tiles)).cast("long")
    larger = F.pmod(rows, F.lit(tiles))
    in_larger = larger * (size + 1)
    return (
        F.when(rank <= in_larger, F.ceil(rank / (size + 1)))
        .otherwise(larger + F.ceil((rank - in_larger) / F.nullif(size, F.lit(0))))
        .cast("int")
    )


def with_ntiles(df: DataFrame, tiles: int, orders: dict[str, list[Column]]) -> DataFrame:
    """NTILE numbers over all rows, one per named order."""
    ranked = with_ranks(df, {f"_rank_{n}": order for n, order in orders.items()}, "_rows")
    return ranked.withColumns(
        {n: tile_of(F.col(f"_rank_{n}"), F.col("_rows"), tiles) for n in orders}
    ).drop("_rows", *[f"_rank_{n}" for n in orders])


def with_running_totals(
    df: DataFrame, order: list[Column], totals: dict[str, Column], within: list[str] = (), rows: int | None = None
) -> DataFrame:
    """Inclusive running totals of ``totals`` in ``order`` per group of ``within``, and the group's
    whole totals as ``<name>_all``.

    ``within`` groups may be few and large: the range partitioning cuts through them, and no join
    is on the group alone. Pass ``rows`` when ``df`` is a written table with that many rows.
    """
    within = list(within)
    if rows is None:
        df, rows = counted(df, "running")
    amounts = df.withColumns({f"_x_{t}": c for t, c in totals.items()})
    placed = range_sorted(amounts, [*[F.col(c) for c in within], *order], range_count(df, rows))
    sizes = placed.groupBy(*within, _PART).agg(*[F.sum(f"_x_{t}").alias(t) for t in totals])
    starts = _range_starts(sizes, list(totals), within)
    local = W.partitionBy(*within, _PART).orderBy(_SLOT).rowsBetween(W.unboundedPreceding, 0)
    return (
        placed.withColumns({t: F.sum(f"_x_{t}").over(local) for t in totals})
        .join(starts, [*within, _PART])
        .withColumns({t: F.col(t) + F.col(f"_{t}_before") for t in totals})
        .drop(_PART, _SLOT, *[f"_x_{t}" for t in totals], *[f"_{t}_before" for t in totals])
    )


def exact_quantiles(
    df: DataFrame, group: list[str], value: str, probs: list[float], weight: str | None = None
) -> DataFrame:
    """Exact linearly interpolated quantiles per group as an array column ``edges``.

    The rows are first reduced to one per (group, value), so a hot value costs one row; the
    order statistics are then found through running counts, never by collecting a group. With
    ``weight`` the input is such a reduced and written table already.
    """
    if weight is None:
        known = df.filter(F.col(value).isNotNull())
        counts, rows = counted(known.groupBy(*group, value).agg(F.count("*").alias("_n")), "quantiles")
    else:
        counts = df.filter(F.col(value).isNotNull() & (F.col(weight) > 0)).select(
            *group, value, F.col(weight).alias("_n")
        )
        rows = counts.count()
    running = with_running_totals(counts, [F.col(value)], {"_upto": F.col("_n")}, group, rows)
    asked = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    # A row answers a position when its run of equal values covers floor or ceil of it.
    first, last = F.col("_upto") - F.col("_n"), F.col("_upto") - 1

    def covered(q):
        at = q["p"] * (F.col("_upto_all") - 1)
        return F.floor(at).between(first, last) | F.ceil(at).between(first, last)

    hits = running.select(*group, value, F.col("_upto_all").alias("_rows"), F.inline(F.filter(asked, covered)))
    found = hits.groupBy(*group, "i", "p", "_rows").agg(
        F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi")
    )
    at = F.col("p") * (F.col("_rows") - 1)
    point = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (at - F.floor(at))
    return found.groupBy(*group).agg(  # one entry per probability
        F.transform(F.array_sort(F.collect_list(F.struct("i", point.alias("q")))), lambda e: e["q"]).alias("edges")
    )


def approx_quantiles(
    df: DataFrame, group: list[str], value: str, probs: list[float], accuracy: int = 10000
) -> DataFrame:
    """One-pass mergeable alternative to :func:`exact_quantiles`; rank error 1/accuracy."""
    return df.groupBy(*group).agg(F.percentile_approx(value, list(probs), accuracy).alias("edges"))


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Top-n report: every task keeps n rows, then n rows are merged."""
    return df.orderBy(*order).limit(n)
