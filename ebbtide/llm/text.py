"""Helpers that the corpus operators share inside their tasks: blocks of rows, words, shingles, signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def blocks(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` (null: empty) holds up to ``most_bytes``, one row at least."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        batch = batch.set_column(at, column, pc.fill_null(batch.column(at), ""))
        ends = np.cumsum(pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """The items of all lists and where each list starts, with the end of the last."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten(), offsets - offsets[0]


def coded(items: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Every item as its place in the array of distinct items."""
    both = items.dictionary_encode()
    return both.indices.to_numpy(zero_copy_only=False), both.dictionary


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words (runs without ``[\\x20\\x09-\\x0D]``) as places in the block's vocabulary; where each text's words start; the vocabulary."""
    items, offsets = flat(pc.ascii_split_whitespace(texts))
    ids, vocabulary = coded(items)
    blank = pc.index(vocabulary, "").as_py()
    if blank >= 0:
        keep = ids != blank
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        ids = ids[keep]
    return ids, offsets, vocabulary


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(vocabulary: pa.Array) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, vocabulary.cast(pa.binary()).to_pylist()), np.uint64, len(vocabulary))


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word shingles.

    A text of fewer than ``size`` words, but one at least, has one shingle of all its words; a text without words has none.
    """
    ids, offsets, vocabulary = split_words(texts)
    words = hashed(vocabulary)[ids] if len(ids) else np.empty(0, np.uint64)
    counts = np.diff(offsets)
    places = len(words) - size + 1
    multiplier = np.uint64(0x9E3779B97F4A7C15)
    chains = np.empty(0, np.uint64)
    if places > 0:
        chains = words[:places].copy()
        for k in range(1, size):
            chains = mixed(chains * multiplier + words[k : k + places])
    found = []
    for start, n in zip(offsets[:-1].tolist(), counts.tolist(), strict=True):
        if n >= size:
            chain = np.sort(chains[start : start + n - size + 1])
            found.append(chain[np.concatenate(([True], chain[1:] != chain[:-1]))])
        elif n:
            one = words[start : start + 1].copy()
            for k in range(1, n):
                one = mixed(one * multiplier + words[start + k : start + k + 1])
            found.append(mixed(one + np.uint64(n)))
        else:
            found.append(np.empty(0, np.uint64))
    return found


def minhash(values: np.ndarray, masks: np.ndarray, factors: np.ndarray, step: int = 1 << 15) -> np.ndarray:
    """Minwise signature of a non-empty set, one 32-bit value for each (mask, factor)."""
    best = np.full(len(masks), 0xFFFFFFFF, np.uint64)
    for k in range(0, len(values), step):
        part = ((values[None, k : k + step] ^ masks[:, None]) * factors[:, None]) >> np.uint64(32)
        np.minimum(best, part.min(axis=1), out=best)
    return best.astype(np.uint32)


def draws(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks and odd factors of ``n`` hash functions."""
    rng = np.random.default_rng(seed)
    top = np.iinfo(np.uint64).max
    return rng.integers(0, top, n, np.uint64), rng.integers(0, top, n, np.uint64) | np.uint64(1)
