"""BPE encoding and decoding by a distinct-word table (operator 2).

1. ``word_blocks`` splits the texts into words and stores, block by block, each document as places in the block's list of
   distinct words, and the lists themselves dealt by a hash of the word.
2. ``word_table`` brings every list entry of a word to one task, which encodes each distinct word once.
3. ``encoded`` joins the ids back by block and place, and decodes through the id-to-piece table of the vocabulary.

Documents are never shuffled as text: what moves are places (as compressed bytes) and lists of distinct words.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.text import blocks
from ebbtide.llm.tokens import Vocabulary, spread
from ebbtide.session import scratch_path

BLOCKS = "block string, bucket int, words binary, widths binary, ranks binary, doc_ids array<long>, starts array<long>, places binary"
ENTRIES = "block string, ranks binary, sizes binary, ids binary"


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers as compressed byte planes."""
    data = values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").reshape(-1)


def pack_words(words: list[str]) -> tuple[bytes, bytes]:
    """Words as their compressed UTF-8 bytes and their numbers of bytes."""
    data = [w.encode() for w in words]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(data)), pack(np.fromiter(map(len, data), np.int64, len(data)))


def unpack_words(data: bytes, widths: bytes) -> list[bytes]:
    joined, ends = zstandard.ZstdDecompressor().decompress(data), np.cumsum(unpack(widths), dtype=np.int64).tolist()
    return [joined[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def split_batches(vocabulary_path: str, block_bytes: int, row_places: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.load(vocabulary_path)
        for block in blocks(batches, "text", block_bytes):
            at, offsets, words = vocabulary.words(block["text"])
            by_use = np.argsort(-np.bincount(at, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[by_use] = np.arange(len(words))
            words = [words[k] for k in by_use.tolist()]
            name = uuid.uuid4().hex
            dealt = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), np.int64, len(words))
            order = np.argsort(dealt, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(dealt[order])) + 1) if len(order) else []:
                packed, widths = pack_words([words[k] for k in own.tolist()])
                yield _row(name, bucket=int(dealt[own[0]]), words=packed, widths=widths, ranks=pack(np.diff(own, prepend=0)))
            start, doc_ids = 0, block["doc_id"].to_pylist()
            while start < len(doc_ids):
                stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + row_places, side="right")) - 1)
                yield _row(
                    name, doc_ids=doc_ids[start:stop], starts=(offsets[start : stop + 1] - offsets[start]).tolist(),
                    places=pack(rank[at[offsets[start] : offsets[stop]]]),
                )
                start = stop
            del at, words, rank, dealt, order
            pa.default_memory_pool().release_unused()

    return run


def _row(block, bucket=None, words=None, widths=None, ranks=None, doc_ids=None, starts=None, places=None) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    values = [block, bucket, words, widths, ranks, doc_ids, starts, places]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds, strict=True)], [x.split()[0] for x in BLOCKS.split(", ")])


def word_batches(vocabulary_path: str):
    """Encode each word of the task's lists once; a word is in the lists of one task only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.load(vocabulary_path)
        known: dict[bytes, bytes] = {}
        for batch in batches:
            lists = [unpack_words(*x) for x in zip(batch["words"].to_pylist(), batch["widths"].to_pylist(), strict=True)]
            new = list({w: None for words in lists for w in words if w not in known})
            ids, starts = vocabulary.encode_words([w.decode() for w in new])
            data, cuts = ids.astype("<u4").tobytes(), (4 * starts).tolist()
            known |= {w: data[a:b] for w, a, b in zip(new, cuts[:-1], cuts[1:], strict=True)}
            found = [[known[w] for w in words] for words in lists]
            sizes = [pack(np.fromiter(map(len, x), np.int64, len(x)) // 4) for x in found]
            ids = [pack(np.frombuffer(b"".join(x), "<u4")) for x in found]
            yield pa.RecordBatch.from_arrays([batch["block"], batch["ranks"], pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())], ["block", "ranks", "sizes", "ids"])

    return run


def join_block(vocabulary_path: str, keep_ids: bool, keep_text: bool):
    """The documents of one block, with the ids of its words."""

    def run(documents: pa.Table, entries: pa.Table) -> pa.Table:
        vocabulary = Vocabulary.load(vocabulary_path)
        lists = [(np.cumsum(unpack(r["ranks"]), dtype=np.int64), unpack(r["sizes"]), unpack(r["ids"])) for r in entries.to_pylist()]
        table = _table(lists)
        parts = [
            _documents(vocabulary, row, *spread(*table, unpack(row["places"]).astype(np.int64), np.array(row["starts"])), keep_ids, keep_text)
            for row in documents.to_pylist()
        ]
        return pa.Table.from_batches(parts, None if parts else _nothing(keep_ids, keep_text).schema)

    return run


def _table(lists) -> tuple[np.ndarray, np.ndarray]:
    """A block's words as ids and where each word's ids start, in order of rank."""
    if not lists:
        return np.empty(0, np.uint32), np.zeros(1, np.int64)
    ranks, sizes, ids = (np.concatenate(x) for x in zip(*lists, strict=True))
    if not np.array_equal(np.sort(ranks), np.arange(len(ranks))):
        raise ValueError("a block's word lists are incomplete")
    order = np.argsort(ranks)
    starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return spread(ids, starts, order, np.arange(len(order) + 1))


def _documents(vocabulary, row, ids, ends, keep_ids, keep_text) -> pa.RecordBatch:
    data, cuts = memoryview(ids.astype("<u4").tobytes()), (4 * ends).tolist()
    texts = vocabulary.decode(ids, ends)
    columns = {
        "doc_id": pa.array(row["doc_ids"], pa.int64()),
        "n_tokens": pa.array(np.diff(ends), pa.int64()),
        "ids_sha256": pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.string()),
        "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
    }
    if keep_ids:
        columns["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
    if keep_text:
        columns["decoded"] = pa.array([x.decode() for x in texts], pa.string())
    return pa.RecordBatch.from_pydict(columns)


def _nothing(keep_ids: bool, keep_text: bool) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    kinds |= {"ids": pa.list_(pa.int32())} if keep_ids else {}
    kinds |= {"decoded": pa.string()} if keep_text else {}
    return pa.RecordBatch.from_pydict({k: [] for k in kinds}, pa.schema(list(kinds.items())))


def word_blocks(docs: DataFrame, vocabulary_path: str, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 14 << 20, row_places: int = 1 << 19) -> DataFrame:
    """Split the texts; written once, as blocks are named at random, and bucketed by block, so that the documents need no
    shuffle when the ids come back. The table's name is given up at once; its files stay in the scratch folder."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cut = rows.mapInArrow(split_batches(vocabulary_path, block_bytes, row_places, buckets), BLOCKS)
    name = f"bpe_blocks_{uuid.uuid4().hex}"
    cut.write.bucketBy(buckets, "block").option("path", scratch_path(spark, "bpe-blocks")).format("parquet").saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def word_table(cut: DataFrame, vocabulary_path: str) -> DataFrame:
    """The ids of every block's words; the lists are dealt by word, so that no word is encoded twice."""
    lists = cut.filter("bucket is not null").select("block", "bucket", "words", "widths", "ranks")
    return lists.repartition("bucket").drop("bucket").mapInArrow(word_batches(vocabulary_path), ENTRIES)


def encode_decode(docs: DataFrame, vocabulary_path: str, *, keep_ids: bool = False, keep_text: bool = False, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``ids``
    (array of int) and ``decoded`` (the text of the ids).

    A null text counts as empty: no ids, hashes of nothing. Rows that repeat an id or a text stay rows of their own. An
    empty table gives an empty result; other columns are not read, whatever their names. A very long text is a block alone.
    """
    cut = word_blocks(docs, vocabulary_path, **options)
    entries = word_table(cut, vocabulary_path)
    documents = cut.filter("doc_ids is not null").select("block", "doc_ids", "starts", "places")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * keep_ids + ", decoded string" * keep_text
    both = documents.groupBy("block").cogroup(entries.groupBy("block"))
    return both.applyInArrow(join_block(vocabulary_path, keep_ids, keep_text), schema)
