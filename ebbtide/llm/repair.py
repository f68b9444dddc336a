"""Token files compressed by Re-Pair grammars, with random access to documents (operator 5).

``rounds`` (inside words, over documents) is the level of compression: any number gives files that decode alike.
``write_tokens`` deals the documents into ranges of ascending id and encodes each range block by block. A block is a shard
of the file format: one Parquet row with its documents, its grammar and its symbols. The grammar is found by Re-Pair:
frequent neighbouring ids are replaced by a nonterminal again and again, first inside the block's distinct words (counted
as often as the block uses them), then over the documents. No pair reaches over the end of a document, so every document
is a slice of symbols that is decoded alone. ``read_tokens`` reads whole files or the documents asked for.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.text import blocks
from ebbtide.llm.tokens import Vocabulary, spread

FORMAT = (
    "range long, block long, first_id long, last_id long, first_key long, n_tokens long, n_terminals long, doc_ids array<long>, keys array<long>, "
    "token_starts array<long>, symbol_starts array<long>, rules binary, lengths binary, symbols binary"
)


class Grammar:
    """Rules of one block: nonterminal ``n_terminals + k`` stands for the pair ``rules[k]``."""

    def __init__(self, n_terminals: int):
        self.n_terminals = n_terminals
        self.rules = np.empty((0, 2), np.uint32)

    def replace(self, symbols: np.ndarray, last: np.ndarray, weights: np.ndarray | None, least: int, most: int, rounds: int):
        """Replace pairs that occur ``least`` times or more, up to ``most`` kinds a round, until none is left or the rounds
        are over. ``last`` marks the ends that no pair may reach over; ``weights`` says how often each symbol counts."""
        for _ in range(rounds):
            if len(symbols) < 2:
                break
            keys = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
            open_ = ~last[:-1]
            found, counts = _counted(keys[open_], None if weights is None else weights[:-1][open_])
            often = np.flatnonzero(counts >= least)
            if not len(often):
                break
            if len(often) > most:
                often = np.sort(often[np.argsort(-counts[often], kind="stable")[:most]])
            chosen = found[often]
            pairs = np.stack((chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)), 1).astype(np.uint32)
            base = self.n_terminals + len(self.rules)
            heads = np.zeros(base, bool)
            tails = np.zeros(base, bool)
            heads[pairs[:, 0]] = True
            tails[pairs[:, 1]] = True
            at = np.flatnonzero(heads[symbols[:-1]] & tails[symbols[1:]] & open_)
            place = np.minimum(np.searchsorted(chosen, keys[at]), len(chosen) - 1)
            hit = chosen[place] == keys[at]
            at, place = at[hit], place[hit]
            fresh = np.concatenate(([True], np.diff(at) != 1))  # of overlapping pairs every second one, from the left
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            take = (np.arange(len(at)) - run) % 2 == 0
            at, place = at[take], place[take]
            self.rules = np.concatenate((self.rules, pairs))
            symbols[at] = base + place
            last[at] = last[at + 1]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, last = symbols[keep], last[keep]
            weights = None if weights is None else weights[keep]
        return symbols, last

    def expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """What each symbol stands for, as ids and where each symbol's ids start."""
        terminals = np.arange(self.n_terminals, dtype=np.uint32)
        ids = np.concatenate((terminals, self.rules.reshape(-1)))
        starts = np.concatenate((np.arange(self.n_terminals), self.n_terminals + 2 * np.arange(len(self.rules) + 1))).astype(np.int64)
        flat, offsets = self.rules.reshape(-1), 2 * np.arange(len(self.rules) + 1, dtype=np.int64)
        while len(flat) and flat.max() >= self.n_terminals:
            flat, offsets = spread(ids, starts, flat.astype(np.int64), offsets)
        return np.concatenate((terminals, flat)), np.concatenate((np.arange(self.n_terminals), self.n_terminals + offsets)).astype(np.int64)


def _counted(keys: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, np.empty(0, np.int64)
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(np.append(first, len(keys))) if weights is None else np.add.reduceat(weights, first)
    return keys[first], counts


def compress(units, n_terminals: int, end_id: int, least: int = 8, most: int = 8192, rounds: tuple[int, int] = (3, 2)):
    """A block's grammar and symbols, and where each document's symbols and tokens start; an end id closes each document."""
    ids, starts, at, offsets = units
    grammar = Grammar(n_terminals)
    sizes = np.diff(starts)
    used = np.bincount(at, minlength=len(sizes))
    last = np.zeros(len(ids), bool)
    last[starts[1:][sizes > 0] - 1] = True
    token_starts = np.concatenate(([0], np.cumsum(sizes[at])))[offsets] + np.arange(len(offsets))
    symbols, last = grammar.replace(ids.copy(), last, np.repeat(used, sizes), least, most, rounds[0])
    kept = np.zeros(len(sizes) + 1, np.int64)  # a unit without ids stays one without symbols
    kept[1:][sizes > 0] = np.flatnonzero(last) + 1
    kept = np.maximum.accumulate(kept)
    # every document gets one more place, of a unit that is the end id alone
    symbols, kept = np.append(symbols, np.uint32(end_id)).astype(np.uint32), np.append(kept, kept[-1] + 1)
    at = np.insert(at.astype(np.int64), offsets[1:], len(sizes))
    symbols, ends = spread(symbols, kept, at, offsets + np.arange(len(offsets)))
    last = np.zeros(len(symbols), bool)
    last[ends[1:] - 1] = True
    symbols, last = grammar.replace(symbols.copy(), last, None, least, most, rounds[1])
    return grammar, symbols, np.concatenate(([0], np.flatnonzero(last) + 1)), token_starts


def encode_batches(vocabulary_path: str, block_bytes: int, end_id: int, least: int, most: int, rounds: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.load(vocabulary_path)
        range_ = TaskContext.get().partitionId()
        for nth, block in enumerate(blocks(batches, "text", block_bytes)):
            grammar, symbols, starts, tokens = compress(vocabulary.units(block["text"]), vocabulary.size, end_id, least, most, rounds)
            lengths = np.diff(grammar.expansions()[1])[vocabulary.size :]
            ids, keys = block["doc_id"].to_pylist(), block["key"].to_pylist()
            row = [range_, nth, ids[0], ids[-1], keys[0], int(tokens[-1]), vocabulary.size, ids, keys, tokens, starts]
            row += [x.tobytes() for x in (grammar.rules.astype("<u4"), lengths.astype("<u4"), symbols.astype("<u4"))]
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int64())] * 4 + [pa.binary()] * 3
            names = [x.split()[0] for x in FORMAT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

    return run


def write_tokens(
    docs: DataFrame, folder: str, vocabulary_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
    block_bytes: int = 12 << 20, least: int = 8, most: int = 8192, rounds: tuple[int, int] = (3, 2),
) -> None:
    """Encode the whole texts (null: empty), append ``end_id`` to each and write them in ascending id (nulls first).

    Rows that repeat an id follow each other in the order of a hash of their texts. An empty table gives files without rows.
    Every task encodes a range of ids, block by block; a lost task is done again from the input alone. The ranges are split
    by id and text hash, so that an id which many rows share does not meet in one task.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    ordered = keyed.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key")
    ordered.mapInArrow(encode_batches(vocabulary_path, block_bytes, end_id, least, most, rounds), FORMAT).write.option("compression", "zstd").parquet(folder)


def decode_batches(wanted: list[int] | None, with_tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                picked = range(len(row["doc_ids"])) if wanted is None else [k for k, x in enumerate(row["doc_ids"]) if x in set(wanted)]
                if not len(picked):
                    continue
                grammar = Grammar(row["n_terminals"])
                grammar.rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
                table, starts = grammar.expansions()
                if not np.array_equal(np.diff(starts)[grammar.n_terminals :], np.frombuffer(row["lengths"], "<u4")):
                    raise ValueError("stored expansion lengths do not fit the rules")
                symbols, bounds = np.frombuffer(row["symbols"], "<u4"), np.array(row["symbol_starts"])
                if wanted is not None:
                    symbols = np.concatenate([symbols[bounds[k] : bounds[k + 1]] for k in picked])
                    bounds = np.concatenate(([0], np.cumsum([bounds[k + 1] - bounds[k] for k in picked])))
                ids, ends = spread(table, starts, symbols.astype(np.int64), bounds)
                data, ends = memoryview(ids.astype("<u4").tobytes()), ends.tolist()
                columns = [
                    pa.array([row["doc_ids"][k] for k in picked], pa.int64()),
                    pa.array([row["keys"][k] for k in picked], pa.int64()),
                    pa.array([row["range"]] * len(picked), pa.int64()),
                    pa.array([row["block"]] * len(picked), pa.int64()),
                    pa.array([row["token_starts"][k] for k in picked], pa.int64()),
                    pa.array(np.diff(ends), pa.int64()),
                    pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.int64()),
                ]
                names = ["doc_id", "key", "range", "block", "in_block", "n_tokens", "ids_crc32"]
                if with_tokens:
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def read_tokens(spark: SparkSession, folder: str, *, wanted: list[int] | None = None, with_tokens: bool = True) -> DataFrame:
    """Documents of the files: ``doc_id``, ``start`` (tokens of all documents before), ``n_tokens``, ``ids_crc32``, ``ids``.

    ``wanted`` reads these documents only: the files' statistics skip blocks without them, and in the other blocks only their
    symbols are expanded. The running total has one row for each block of the files; a block is known by the number of its range
    and its number in the range, as blocks may start with equal rows.
    """
    rows = spark.read.schema(FORMAT).parquet(folder)
    order = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_key", "range", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.select("range", "block", "first_id", "first_key", "n_tokens").select("range", "block", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("before"))
    if wanted is not None:
        near = [F.coalesce(F.col("first_id") <= x, F.lit(True)) & (F.col("last_id") >= x) for x in wanted]
        rows = rows.filter(functools.reduce(Column.__or__, near, F.lit(False)))
    schema = "doc_id long, key long, range long, block long, in_block long, n_tokens long, ids_crc32 long"
    found = rows.mapInArrow(decode_batches(wanted, with_tokens), schema + (", ids array<int>" if with_tokens else ""))
    joined = found.join(before, ["range", "block"])
    kept = ["doc_id", (F.col("before") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32"]
    return joined.select(*kept, *(["ids"] if with_tokens else []))
