"""Toxicity by a factorization machine over hashed terms (operator 12).

A text's terms are its distinct words in lower case and the words' first letters, hashed into a fixed number of cells. The
score is the logistic function of a constant, a weight for each term, and an interaction for each pair of terms: the product of
the terms' factor vectors. An insult and the mention of a group can so count together for more, or less, than the two alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.text import blocks, coded, flat, hashed, split_words
from ebbtide.session import written

#: Fixed value: punctuation that is cut off both ends of a word.
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”‘’„…¡¿–—"
PREFIXES = (3, 4, 5)


@dataclass
class Machine:
    """Constant, and for every known cell its weight and factors; a cell that is not in ``cells`` counts nothing."""

    bits: int
    constant: float
    cells: np.ndarray  # ascending
    weights: np.ndarray
    factors: np.ndarray  # (cells, width)

    def odds(self, terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log odds of texts; ``starts``: where each text's distinct terms start."""
        if not len(self.cells):
            return np.full(len(starts) - 1, self.constant)
        place = np.minimum(np.searchsorted(self.cells, terms), len(self.cells) - 1)
        known = self.cells[place] == terms
        starts = np.concatenate(([0], np.cumsum(known)))[starts]
        return self.constant + _pairs(self.weights, self.factors, place[known], starts)[0]


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums over the slices of ``values`` (slices may be empty)."""
    found = np.zeros((len(starts) - 1, *values.shape[1:]))
    some = np.flatnonzero(np.diff(starts))
    if len(some):
        found[some] = np.add.reduceat(values, starts[:-1][some], axis=0)
    return found


def _pairs(weights: np.ndarray, factors: np.ndarray, at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and interactions of each text's terms, and each text's sum of factors.

    All pairs at once: the square of the sum less the sum of the squares, halved.
    """
    own = factors[at]
    whole = _sums(own, starts)
    both = ((whole**2).sum(1) - _sums((own**2).sum(1), starts)) / 2
    return _sums(weights[at], starts) + both, whole


def terms_of(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct cells of all texts (no nulls), and where each text's cells start."""
    ids, offsets, vocabulary = split_words(pc.utf8_lower(texts))
    n = len(offsets) - 1
    if not len(ids):
        return np.empty(0, np.int64), np.zeros(n + 1, np.int64)
    words = pc.utf8_trim(vocabulary, EDGES)
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    mask = np.uint64((1 << bits) - 1)
    kinds = [np.where(sizes > 0, (hashed(words) & mask).astype(np.int64), -1)]
    for size in PREFIXES:  # a prefix is a term of its own, other than the word of the same letters
        codes, starts = coded(pc.binary_join_element_wise(pc.utf8_slice_codeunits(words, 0, size), "~", ""))
        kinds.append(np.where(sizes > size, (hashed(starts) & mask).astype(np.int64)[codes], -1))
    text = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    once = _distinct(text * len(vocabulary) + ids)
    text, ids = np.divmod(once, len(vocabulary))
    found = _distinct(np.concatenate([(text << bits | k[ids])[k[ids] >= 0] for k in kinds]))
    return found & ((1 << bits) - 1), np.searchsorted(found >> bits, np.arange(n + 1))


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def telling(rows: DataFrame, least: int, least_gain: float) -> DataFrame:
    """Cells of ``least`` texts or more of ``rows`` (``label``, ``terms``) whose presence tells something about the label: a
    log-likelihood ratio (G squared) of ``least_gain`` or more."""
    both = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).first()
    n, ones = both["n"], both["ones"] or 0
    if not 0 < ones < n:
        return rows.select(F.explode("terms").alias("cell")).limit(0)
    cells = rows.select("label", F.explode("terms").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("seen"), F.sum("label").alias("hits"))
    seen, hits = F.col("seen"), F.col("hits")

    def gain(count: Column, expected: Column) -> Column:
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    found = gain(hits, seen * (ones / n)) + gain(seen - hits, seen * ((n - ones) / n))
    found += gain(ones - hits, (n - seen) * (ones / n)) + gain(n - seen - ones + hits, (n - seen) * ((n - ones) / n))
    return cells.filter((seen >= least) & (seen < n) & (2 * found >= least_gain)).select("cell")


def told_batches(cells: np.ndarray):
    """Rows with the terms in ``cells`` (ascending) only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, starts = flat(batch["terms"])
            keep = np.isin(terms.to_numpy(zero_copy_only=False), cells)
            starts = np.concatenate(([0], np.cumsum(keep)))[starts]
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), terms.filter(pa.array(keep)))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], lists], ["id", "label", "terms"])

    return run


def fit(
    terms: np.ndarray, starts: np.ndarray, labels: np.ndarray, bits: int, *, width: int = 8, epochs: int = 12, batch: int = 256,
    rate: float = 0.02, decay: float = 0.02, seed: int = 3,
) -> Machine:
    """Weights and factors of least logistic loss, by Adam on small batches with decoupled decay.

    Labels of one kind only give a machine of a constant; no labels at all the odds of 1 to 10,000.
    """
    share = np.clip(labels.mean() if len(labels) else 0.0, 1e-4, 1 - 1e-4)
    constant = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        return Machine(bits, constant, np.empty(0, np.int64), np.empty(0), np.empty((0, width)))
    cells, at = np.unique(terms, return_inverse=True)
    rng = np.random.default_rng(seed)
    # one row a cell: its weight, then its factors
    theta = np.concatenate((np.zeros((len(cells), 1)), rng.normal(0, 0.01, (len(cells), width))), 1)
    mean, square, own, step = np.zeros_like(theta), np.zeros_like(theta), np.zeros(2), 0
    for epoch in range(epochs):
        speed = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for rows in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // batch)):
            step += 1
            sizes = np.diff(starts)[rows]
            ends = np.concatenate(([0], np.cumsum(sizes)))
            mine = at[np.repeat(starts[rows] - ends[:-1], sizes) + np.arange(ends[-1])]
            odds, whole = _pairs(theta[:, 0], theta[:, 1:], mine, ends)
            miss = 1 / (1 + np.exp(-np.clip(constant + odds, -30, 30))) - labels[rows]
            each = np.repeat(miss, sizes)[:, None] / len(rows)
            slope = np.concatenate((each, each * (np.repeat(whole, sizes, axis=0) - theta[mine, 1:])), 1)
            used, inverse = np.unique(mine, return_inverse=True)
            total = np.stack([np.bincount(inverse, slope[:, k], len(used)) for k in range(width + 1)], 1)
            mean *= 0.9
            square *= 0.999
            mean[used] += 0.1 * total
            square[used] += 0.001 * total**2
            theta *= 1 - speed * decay
            theta -= speed * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            own = own * (0.9, 0.999) + np.array((0.1, 0.001)) * (miss.mean(), miss.mean() ** 2)
            constant -= speed * (own[0] / (1 - 0.9**step)) / (np.sqrt(own[1] / (1 - 0.999**step)) + 1e-8)
    return Machine(bits, constant, cells, theta[:, 0], theta[:, 1:])


def _learns(id_col: str, parts: int, held: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("long").cast("string")), F.lit(parts)) != held, F.lit(True))


def term_batches(bits: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", block_bytes):
            terms, starts = terms_of(block["text"], bits)
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(terms, pa.int32()))
            yield pa.RecordBatch.from_arrays([block["id"], block["label"], lists], ["id", "label", "terms"])

    return run


def fit_machine(
    docs: DataFrame, labels: DataFrame, *, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", most_docs: int = 20_000,
    bits: int = 18, least: int = 4, least_gain: float = 10.8, parts: int = 4, held: int = 2, block_bytes: int = 4 << 20, **options,
) -> Machine:
    """The machine of up to ``most_docs`` labelled documents, those with the smallest hashes of their ids.

    Ids whose crc32 (of their decimal text) leaves ``held`` when divided by ``parts`` are held out and never learnt from. Rows
    without an id or a label don't count; of contradicting labels the larger holds, and of rows that share an id the one whose
    terms come first. Terms are found and counted in tasks; what reaches the driver are the telling terms, which ``least`` chosen
    documents have and whose ``gain`` is not chance, of each chosen document.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & _learns(id_col, parts, held))
    known = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("id", F.lit(12)), "id").limit(most_docs)  # at most most_docs rows: broadcast
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    found = texts.select("id", "label", "text").mapInArrow(term_batches(bits, block_bytes), "id long, label int, terms array<int>")
    rows = written(found.groupBy("id").agg(F.min(F.struct("terms", "label")).alias("one")).select("id", "one.*"), "toxic-terms")
    cells = np.sort(telling(rows, least, least_gain).toArrow()["cell"].to_numpy())  # at most 2^bits
    told = rows.mapInArrow(told_batches(cells), "id long, label int, terms array<int>").orderBy("id").toArrow()
    lists = told["terms"].combine_chunks()
    starts = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
    return fit(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), starts, told["label"].to_numpy().astype(float), bits, **options)


def score_batches(machine: Machine, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", block_bytes):
            odds = machine.odds(*terms_of(block["text"], machine.bits))
            yield pa.RecordBatch.from_arrays([block["doc_id"], block["held_out"], pa.array(1 / (1 + np.exp(-np.clip(odds, -40, 40))))], ["doc_id", "held_out", "score"])

    return run


def toxicity(
    docs: DataFrame, machine: Machine, *, id_col: str = "doc_id", text_col: str = "text", least: float = 0.3, parts: int = 4, held: int = 2,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``least`` on).

    Only the text counts. A null text counts as empty, and a text without known terms has the constant's score. Rows that repeat an
    id or a text stay rows of their own; a row without an id is not held out. An empty table gives an empty result; other
    columns are not read, whatever their names. Whole texts are read block by block, a very long one alone, and no row is shuffled.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (~_learns(id_col, parts, held)).alias("held_out"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(score_batches(machine, block_bytes), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= least).cast("int"))
