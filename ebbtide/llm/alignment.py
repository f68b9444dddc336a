"""Alignment of two tokenizers' tokens by merge paths (operator 11).

Tokens of tokenizer A and tokenizer B end at byte offsets of the same text. Merging the two ascending lists of ends walks a
path through the grid of A and B tokens, and every step of it that reaches a new offset is a pair of overlapping tokens.
Diagonals at equal distances cut the path into pieces of equal work: a binary search on each diagonal finds where the path
crosses it, so that no piece needs what another has found, be it inside a text of a word or in the midst of a very long one.
The pieces are walked side by side. Offsets where both lists end close a group; what a piece leaves open goes on in the next.

Texts are cut into units, which both tokenizers encode alone as in their text; each distinct unit of a block is encoded and
merged once. Blocks count their id pairs by documents, Spark adds up the counts of all blocks, and the counts come back to the
blocks, whose documents hold places in the block's list of pairs.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.bpe import pack, unpack
from ebbtide.llm.pieces import Pieces
from ebbtide.llm.text import blocks
from ebbtide.llm.tokens import Vocabulary
from ebbtide.session import written

CUT = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
    "starts array<long>, places binary, times binary, pairs array<long>, docs array<long>"
)
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
FAR = np.iinfo(np.int64).max


def crossings(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path of two ascending lists crosses every ``work``-th diagonal: how many of each list lie before it.

    On a diagonal ``i + j`` is fixed; the search finds the least ``i`` whose next A end lies behind the B end that came last.
    Equal ends come A first.
    """
    diagonal = np.arange(0, len(a) + len(b), work)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        open_ = low < high
        before = np.zeros(len(low), bool)
        before[open_] = a[middle[open_]] <= b[diagonal[open_] - 1 - middle[open_]]
        low = np.where(open_ & before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    return low, diagonal - low


def overlaps(a: np.ndarray, b: np.ndarray, work: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping tokens in the order of the text: their places in A and in B, and whether both end there (a group's end).

    ``a`` and ``b`` are ascending ends over the same bytes, so that their last ends are equal.
    """
    i, j = crossings(a, b, work)
    left, right, closed, some = (np.zeros((work, len(i)), kind) for kind in (np.int64, np.int64, bool, bool))
    a_ends, b_ends = np.append(a, FAR), np.append(b, FAR)
    last = np.concatenate(([-1], a))  # of an A end already passed
    for k in range(work):
        x, y = a_ends[i], b_ends[j]
        takes_a = x <= y
        left[k], right[k], closed[k] = i, j, x == y
        # a B end that equals the A end before it is no new offset, and behind the last ends there is nothing
        some[k] = np.where(takes_a, x < FAR, y != last[i])
        i = np.minimum(i + (takes_a & (x < FAR)), len(a))
        j = np.minimum(j + ~takes_a, len(b))
    kept = some.T.ravel()  # the pieces one after another
    return left.T.ravel()[kept], right.T.ravel()[kept], closed.T.ravel()[kept]


@dataclass
class Units:
    """Tokens of distinct units: ids and where each unit's start, in A and in B; and the units of every text."""

    a: np.ndarray
    a_starts: np.ndarray
    b: np.ndarray
    b_starts: np.ndarray
    at: np.ndarray
    offsets: np.ndarray


def _units(vocabulary: Vocabulary, pieces: Pieces, texts: pa.Array) -> Units:
    """Both tokenizers' tokens of texts (neither null nor empty) with a blank before; an irregular text is one unit."""
    regular = vocabulary.regular(texts) if pieces.apart else np.zeros(len(texts), bool)
    at, offsets, strings, spaced = vocabulary.keys(texts.filter(pa.array(regular)), blank_first=True)
    a, a_starts = vocabulary.encode_keys(strings, spaced)
    b, b_starts = pieces.encode_keys(strings, spaced)
    if regular.all():
        return Units(a, a_starts, b, b_starts, at, offsets)
    others = texts.filter(pa.array(~regular)).to_pylist()
    whole_a = [np.array(e.ids, np.uint32) for e in vocabulary.library.encode_batch([" " + x for x in others], add_special_tokens=False)]
    whole_b = pieces.encode(others)
    # what is not the text's bytes has no tokens in A, and so, as it differs from B, none at all
    whole_a = [x if b"".join(vocabulary.pieces.take(pa.array(x)).to_pylist()) == b" " + t.encode() else x[:0] for x, t in zip(whole_a, others, strict=True)]
    parts, alone = iter(np.split(at, offsets[1:-1]) if regular.any() else []), iter(range(len(strings), len(strings) + len(others)))
    each = [next(parts) if fits else np.array([next(alone)], np.int32) for fits in regular.tolist()]
    joined = [np.concatenate((s, s[-1] + np.cumsum([len(x) for x in own]))).astype(np.int64) for s, own in ((a_starts, whole_a), (b_starts, whole_b))]
    sizes = np.concatenate(([0], np.cumsum([len(x) for x in each]))).astype(np.int64)
    return Units(np.concatenate([a, *whole_a]), joined[0], np.concatenate([b, *whole_b]), joined[1], np.concatenate(each), sizes)


def _bytes(table: pa.Array, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The joined bytes of tokens, and where each token's start, with the end of the last."""
    taken = table.take(pa.array(ids.astype(np.int64)))
    ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
    return memoryview(taken.buffers()[2] or b"") if len(ids) else memoryview(b""), ends


def _agreeing(u: Units, a_bytes, b_bytes) -> np.ndarray:
    """Units whose A and B tokens have the same bytes, one at least."""
    (a, a_ends), (b, b_ends) = a_bytes, b_bytes
    a_cuts, b_cuts = a_ends[u.a_starts], b_ends[u.b_starts]
    good = (np.diff(a_cuts) == np.diff(b_cuts)) & (np.diff(a_cuts) > 0)
    if a_cuts[-1] == b_cuts[-1] and np.array_equal(a_cuts, b_cuts) and a[: a_cuts[-1]] == b[: b_cuts[-1]]:
        return good
    for k in np.flatnonzero(good).tolist():
        good[k] = a[a_cuts[k] : a_cuts[k + 1]] == b[b_cuts[k] : b_cuts[k + 1]]
    return good


def _kept(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of good units, where each unit's start, and their ends in the bytes of good units."""
    keep = np.repeat(good, np.diff(starts))
    return ids[keep], np.concatenate(([0], np.cumsum(np.diff(starts) * good))).astype(np.int64), np.cumsum(np.diff(ends)[keep])


def _summed(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]]


class Block:
    """The aligned units of one block of texts."""

    def __init__(self, vocabulary: Vocabulary, pieces: Pieces, texts: pa.Array, numbers: pa.Array, work: int):
        u = _units(vocabulary, pieces, texts)
        a_bytes, b_bytes = _bytes(vocabulary.pieces, u.a), _bytes(pieces.bytes, u.b)
        good = _agreeing(u, a_bytes, b_bytes)
        a, a_starts, a_ends = _kept(u.a, u.a_starts, a_bytes[1], good)
        b, b_starts, b_ends = _kept(u.b, u.b_starts, b_bytes[1], good)
        left, right, closed = overlaps(a_ends, b_ends, work)
        group = np.cumsum(closed) - closed  # groups over all pieces: one that a piece leaves open goes on in the next
        self.at, self.offsets = u.at, u.offsets
        self.valid = _summed(~good[u.at], u.offsets) == 0
        link_starts = np.searchsorted(left, a_starts)
        self.link_starts = link_starts
        pair = a[left].astype(np.int64) << 32 | b[right]
        self.pairs, self.pair = np.unique(pair, return_inverse=True)
        group_starts = np.concatenate(([0], np.cumsum(closed)))[link_starts]
        self.counts = [np.diff(a_starts), np.diff(b_starts), np.diff(group_starts), np.diff(link_starts)]
        self.strings, self.string_ends = _groups(a, b, left, right, group, a_starts, b_starts, numbers)

    def sums(self) -> list[np.ndarray]:
        """Per text: A tokens, B tokens, groups, links; zeros where the tokenizers' bytes differ from the text's."""
        return [_summed(x[self.at], self.offsets) * self.valid for x in self.counts]

    def digests(self) -> list[str]:
        """Per text the hash of its groups, '' for a text without tokens."""
        strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.string_ends) - 1, [None, pa.py_buffer(self.string_ends), self.strings])
        taken = strings.take(pa.array(self.at))
        data = memoryview(taken.buffers()[2] or b"") if len(self.at) else memoryview(b"")
        ends = np.frombuffer(taken.buffers()[1], np.int64)[self.offsets].tolist() if len(self.at) else [0] * len(self.offsets)
        return [  # without the last group's closing mark
            hashlib.sha256(data[a : b - 1]).hexdigest() if fits and b > a else "" for fits, a, b in zip(self.valid.tolist(), ends[:-1], ends[1:], strict=True)
        ]

    def linked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's distinct pairs as ascending places in ``pairs``, where each text's start, and how many links each has."""
        n = len(self.offsets) - 1
        text = np.repeat(np.arange(n), np.diff(self.offsets))
        keys, times = _counted(text[self.valid[text]] * np.int64(len(self.link_starts)) + self.at[self.valid[text]], None)
        text, unit = np.divmod(keys, len(self.link_starts))
        sizes = np.diff(self.link_starts)[unit]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        links = np.repeat(self.link_starts[unit] - ends[:-1], sizes) + np.arange(ends[-1])
        keys, times = _counted(np.repeat(text, sizes) * np.int64(max(1, len(self.pairs))) + self.pair[links], np.repeat(times, sizes))
        text, place = np.divmod(keys, max(1, len(self.pairs)))
        return place, np.searchsorted(text, np.arange(n + 1)), times


def _counted(keys: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys and their numbers or sums of weights."""
    if not len(keys):
        return keys, np.empty(0, np.int64)
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.diff(np.append(first, len(keys))) if weights is None else np.add.reduceat(weights, first)


def number_table(size: int) -> pa.Array:
    """Every id in decimal digits before a comma, a bar and a semicolon."""
    return pa.array([f"{i}{mark}".encode() for i in range(size) for mark in ",|;"], pa.large_binary())


def _groups(a, b, left, right, group, a_starts, b_starts, numbers: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """Units' groups as text ``a1,a2|b1;`` and so on, one after another, and where each unit's begins, with the end of the last."""
    if not len(a):
        return pa.py_buffer(b""), np.zeros(len(a_starts), np.int64)
    of_a, of_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    of_a[left], of_b[right] = group, group
    n = int(group[-1]) + 1
    a_size, b_size = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
    a_at = np.arange(len(a)) + (np.cumsum(b_size) - b_size)[of_a]  # a group's A ids, then its B ids
    b_at = np.arange(len(b)) + np.cumsum(a_size)[of_b]
    ends = lambda of: np.append(of[1:] != of[:-1], True)
    row = np.empty(len(a) + len(b), np.int64)
    row[a_at] = a.astype(np.int64) * 3 + ends(of_a)
    row[b_at] = b.astype(np.int64) * 3 + 2 * ends(of_b)
    taken = numbers.take(pa.array(row))
    bounds = np.frombuffer(taken.buffers()[1], np.int64)[: len(row) + 1]
    return taken.buffers()[2], np.ascontiguousarray(bounds[a_starts + b_starts])


def align_batches(vocabulary_path: str, pieces_path: str, block_bytes: int, work: int, row_places: int, row_pairs: int):
    """Rows of documents, with their places in the block's list of pairs, and rows of parts of that list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, pieces = Vocabulary.load(vocabulary_path, True), Pieces.load(pieces_path)
        numbers = number_table(max(vocabulary.size, pieces.size))
        for block in blocks(batches, "text", block_bytes):
            name = int.from_bytes(os.urandom(8), "little") >> 1
            lengths = np.array([len(x) > 0 for x in block["text"].to_pylist()], bool)
            found = Block(vocabulary, pieces, block["text"].filter(pa.array(lengths)), numbers, work)
            sums = [_placed(x, lengths, 0) for x in found.sums()]
            digests = np.full(len(lengths), "", object)
            digests[lengths] = found.digests()
            places, starts, times = found.linked()
            starts = np.concatenate(([0], np.cumsum(_placed(np.diff(starts), lengths, 0))))
            docs = np.bincount(places, minlength=len(found.pairs))
            for k in range(0, len(found.pairs), row_pairs):
                yield _row(block=name, pairs=found.pairs[k : k + row_pairs], docs=docs[k : k + row_pairs])
            start = 0
            while start < len(lengths):
                stop = max(start + 1, int(np.searchsorted(starts, starts[start] + row_places, side="right")) - 1)
                stop = min(stop, len(lengths))
                own = slice(int(starts[start]), int(starts[stop]))
                yield _row(
                    block=name, doc_ids=block["doc_id"].slice(start, stop - start).to_pylist(), n_a=sums[0][start:stop], n_b=sums[1][start:stop],
                    n_groups=sums[2][start:stop], n_links=sums[3][start:stop], groups_sha256=digests[start:stop].tolist(),
                    starts=starts[start : stop + 1] - starts[start], places=pack(places[own]), times=pack(times[own]),
                )
                start = stop
            del found, places, times
            pa.default_memory_pool().release_unused()

    return run


def _placed(values: np.ndarray, where: np.ndarray, other) -> np.ndarray:
    full = np.full(len(where), other, np.int64)
    full[where] = values
    return full


def _row(**values) -> pa.RecordBatch:
    kinds = {
        "block": pa.int64(), "doc_ids": pa.list_(pa.int64()), **{n: pa.list_(pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")},
        "groups_sha256": pa.list_(pa.string()), "starts": pa.list_(pa.int64()), "places": pa.binary(), "times": pa.binary(),
        "pairs": pa.list_(pa.int64()), "docs": pa.list_(pa.int64()),
    }
    return pa.RecordBatch.from_arrays([pa.array([values.get(n)], k) for n, k in kinds.items()], list(kinds))


def judge_block(documents: pa.Table, entries: pa.Table) -> pa.Table:
    """The documents of one block, with what the corpus-wide counts of its pairs say."""
    order = np.argsort(entries["pair"].to_numpy())
    n, best = entries["n"].to_numpy()[order], entries["best"].to_numpy()[order].astype(np.int64)
    schema = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in ALIGNED.split(", ")])
    parts = []
    for row in documents.to_pylist():
        places, times, starts = unpack(row["places"]).astype(np.int64), unpack(row["times"]).astype(np.int64), np.array(row["starts"])
        if len(places) and places.max() >= len(n):
            raise ValueError("a block's list of pairs is incomplete")
        columns = [row[c] for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
        columns += [_summed(times * best[places], starts), _summed(times * n[places], starts), row["groups_sha256"]]
        parts.append(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema))
    return pa.concat_tables(parts) if parts else schema.empty_table()


def aligned_blocks(
    docs: DataFrame, vocabulary_path: str, pieces_path: str, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8 << 20,
    work: int = 64, row_places: int = 1 << 20, row_pairs: int = 1 << 16,
) -> DataFrame:
    """Align the texts; written once, as blocks are named at random."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(align_batches(vocabulary_path, pieces_path, block_bytes, work, row_places, row_pairs), CUT), "aligned")


def pair_counts(cut: DataFrame) -> DataFrame:
    """Every linked id pair (``pair``: A id, then B id in the low 32 bits) with ``n``, the documents that hold it linked, and
    whether no other pair of its A id has more."""
    listed = cut.filter("pairs is not null").select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select("x.*")
    counts = written(listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("n")), "pair-counts")
    a = F.shiftright("pair", 32)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))  # one row for each id of A's vocabulary at most
    return counts.withColumn("a", a).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, vocabulary_path: str, pieces_path: str, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``,
    ``groups_sha256``.

    A encodes a blank and the text, B the text (it puts the blank before itself); strings of special tokens are ordinary text. A
    text that is null or empty, or whose tokens' bytes differ from those of a blank and the text, has no tokens: zeros and an empty
    hash. Rows that repeat an id or a text count as documents each; an empty table gives an empty result; other columns are not
    read, whatever their names. A very long text is a block alone, whose merge is cut like any other. A pair that every document
    holds comes once from each block. What moves are lists of pairs and packed places, never texts.
    """
    cut = aligned_blocks(docs, vocabulary_path, pieces_path, **options)
    entries = cut.filter("pairs is not null").select(F.col("block").alias("of_block"), F.explode("pairs").alias("pair")).join(pair_counts(cut), "pair")
    documents = cut.filter("doc_ids is not null").drop("pairs", "docs")
    return documents.groupBy("block").cogroup(entries.groupBy("of_block")).applyInArrow(judge_block, ALIGNED)
