"""Vector code compression by product quantisation with exact integer arithmetic (operator 13).

Components are whole numbers. Squared distances need dot products of whole numbers, which float64 BLAS adds exactly only below
2^53: numbers are broken into limbs so short that every limb product's sum stays below that, limb products are multiplied as
matrices, and the sums are put together again in int64. Codebooks therefore never depend on the order of the rows, the number
of tasks or the machine.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.session import written

#: Totals are handed from tasks to Spark in limbs of so many bits, so that sums over up to 2^23 tasks stay in a long.
TOTAL_BITS = 40


def most(width: int) -> int:
    """Whole numbers up to this size go through limbs, as no squared distance of vectors of ``width`` then leaves int64; larger
    ones go through Python's integers."""
    return math.isqrt(((1 << 63) - 1) // (4 * width))


def limb_bits(width: int) -> int:
    """Bits of a limb such that ``width`` products of two limbs add up to less than 2^53."""
    return (52 - max(0, (width - 1).bit_length())) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Whole numbers as float64 limbs, lowest first: all but the last, which has the sign, are in [0, 2^bits)."""
    found = []
    while np.abs(values).max(initial=0) >= 1 << bits:
        found.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
    return [*found, values.astype(np.float64)]


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of each row of ``a`` with each row of ``b`` (int64, of values up to ``most``)."""
    bits = limb_bits(a.shape[1])
    total = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            total += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest entry (the first of equally near ones) and its squared distance, exact."""
    if rows.dtype == object or entries.dtype == object:
        apart = np.stack([((rows - e) ** 2).sum(1) for e in entries], 1)
    else:
        apart = (rows * rows).sum(1)[:, None] - 2 * dots(rows, entries) + (entries * entries).sum(1)[None, :]
    code = apart.argmin(1)
    return code, np.take_along_axis(apart, code[:, None], 1)[:, 0]


def _whole(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The batch's vectors as whole numbers; Python's integers if any is beyond ``most``."""
    values = np.floor(4096 * batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, width)
    if np.abs(values).max(initial=0) <= most(width):
        return values.astype(np.int64)
    return np.array([[int(x) for x in row] for row in values.tolist()], object).reshape(-1, width)


def _split(values: np.ndarray, parts: int) -> list[np.ndarray]:
    """Equal consecutive parts; a width that ``parts`` does not divide is filled up with zeros."""
    missing = -values.shape[1] % parts
    if missing:
        values = np.concatenate((values, np.zeros((len(values), missing), values.dtype)), 1)
    return np.split(values, parts, 1)


def _blocks(batches: Iterator[pa.RecordBatch], width: int, rows: int = 1 << 14) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            part = batch.slice(k, rows)
            yield part, _whole(part, width)


def total_limbs(total: int) -> list[int]:
    """``total`` as limbs of ``TOTAL_BITS`` bits, lowest first; the last one has the sign."""
    found = []
    while abs(total) >= 1 << TOTAL_BITS:
        found.append(total & ((1 << TOTAL_BITS) - 1))
        total >>= TOTAL_BITS
    return [*found, total]


def sum_batches(books: list[np.ndarray], width: int):
    """A task's sums of the parts nearest to each entry, by part position, entry, place and limb; place -1 has their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = len(books)
        sums = np.zeros((parts, *books[0].shape), object)
        counts = np.zeros((parts, len(books[0])), np.int64)
        for _, whole in _blocks(batches, width):
            for p, own in enumerate(_split(whole, parts)):
                code, _ = nearest(own, books[p])
                order = np.argsort(code, kind="stable")
                used, first = np.unique(code[order], return_index=True)
                sums[p, used] += np.add.reduceat(own[order], first, axis=0).astype(object)
                counts[p] += np.bincount(code, minlength=len(books[p]))
        found = [(p, e, -1, 0, int(counts[p, e])) for p, e in np.argwhere(counts).tolist()]
        for p, e, place in np.argwhere(sums != 0).tolist():
            found += [(p, e, place, k, limb) for k, limb in enumerate(total_limbs(sums[p, e, place]))]
        columns = list(zip(*found, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "place", "k", "total"])

    return run


def code_batches(books: list[np.ndarray], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, whole in _blocks(batches, width):
            found = [nearest(own, books[p]) for p, own in enumerate(_split(whole, len(books)))]
            codes = np.stack([c for c, _ in found], 1).astype(np.uint8)
            digits = codes.tobytes().hex()
            step = 2 * len(books)
            code = pa.array([digits[k : k + step] for k in range(0, len(digits), step)], pa.string())
            error = pa.array([x if x < 1 << 63 else None for x in sum(d for _, d in found).tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], code, error], ["vec_id", "label", "code", "error"])

    return run


def sound(vector: Column) -> Column:
    """Neither null nor empty, and without null or non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def fit_codebooks(rows: DataFrame, *, parts: int = 8, entries: int = 16, rounds: int = 6) -> list[np.ndarray]:
    """Codebooks of ``rows`` (``vec_id``, ``vector``: sound, of one width), one for each part.

    They start as the parts of the ``entries`` rows of smallest ids (null last, then by components). A round sums the parts by
    their nearest entry in every task and over all tasks; the driver gets a row for each part position, entry and place
    (and limb, where totals are long), whatever the number of rows.
    """
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).toArrow()
    width = len(first["vector"][0])
    books = _split(_whole(first.combine_chunks().to_batches()[0], width), parts)
    for _ in range(rounds):
        summed = rows.select("vector").mapInArrow(sum_batches(books, width), "part long, entry long, place long, k long, total long")
        totals: dict[tuple[int, int, int], int] = {}
        for r in summed.groupBy("part", "entry", "place", "k").agg(F.sum("total").alias("total")).collect():
            key = r["part"], r["entry"], r["place"]
            totals[key] = totals.get(key, 0) + (r["total"] << TOTAL_BITS * r["k"])
        new = [b.astype(object) for b in books]
        for (p, e, place), n in totals.items():
            if place < 0:
                new[p][e] = [totals.get((p, e, at), 0) // n for at in range(new[p].shape[1])]
        books = [b.astype(np.int64) if max(map(abs, b.ravel().tolist())) <= most(width) else b for b in new]
    return books


def compressed(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6
) -> DataFrame:
    """One row per sound row of ``vectors``: ``vec_id``, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    A component ``x`` counts as ``floor(4096 * x)``. Vectors that are null or empty, or hold null or non-finite components, are
    dropped, as are vectors of another width than the one with the smallest id; a width that ``parts`` does not divide is filled up
    with zeros. ``code`` has two hexadecimal digits a part, ``error`` is the sum of squared distances, null if no long holds it,
    ``label_error`` its sum over equal labels, nulls together. Rows that repeat an id or a vector count each; fewer rows than
    ``entries`` give as many entries; an empty table gives an empty result; other columns are not read. Errors are summed by
    label before they are shuffled and written before they are joined back, so that a label may have any share of the rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a part's code is a byte: 1 to 256 entries")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.filter(sound(F.col("vector")))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(F.size("vector")).first()
    if first is None:
        nothing = rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return nothing.withColumn("codebooks_sha256", F.lit(""))
    rows = rows.filter(F.size("vector") == first[0])
    books = fit_codebooks(rows, parts=parts, entries=entries, rounds=rounds)
    digest = hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()
    kind = rows.schema["label"].dataType.simpleString()
    coded = written(rows.mapInArrow(code_batches(books, first[0]), f"vec_id long, label {kind}, code string, error long"), "vector-codes")
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("whole"))
    fits = F.when(F.col("whole") <= F.lit(str((1 << 63) - 1)).cast("decimal(38,0)"), F.col("whole")).cast("long")
    sums = written(sums.select("of_label", fits.alias("label_error")), "label-errors")
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
