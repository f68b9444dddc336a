"""Exact deduplication by content-defined chunk recipes (operator 8).

Every text is cut where a rolling hash of its normalised bytes says so. The distinct chunks are moved once, to check that
no two of them share an identifier; from then on a document is its recipe, the ordered list of its chunk identifiers, and
documents are equal when their recipes are. If two chunks do share an identifier, all identifiers are drawn again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.keys import packed, unpacked
from ebbtide.llm.text import blocks
from ebbtide.session import written

#: Fixed value: the characters that normalisation deletes.
BLANKS = b" \t\n\x0b\x0c\r"
CLASH = b"clash"  # stands among the identifiers of a block that gave one identifier to two chunks
RECIPES = "row long, doc_id long, n_points long, text_sha256 string, recipe binary, id binary, chunk binary"


def identifier(chunk: bytes, seed: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk, seed)


def cuts_of(data: np.ndarray, window: int, bits: int) -> np.ndarray:
    """Places after which the rolling hash of the last ``window`` bytes has ``bits`` zero bits."""
    if len(data) < window:
        return np.empty(0, np.int64)
    value = np.zeros(len(data) - window + 1, np.uint32)
    wide = data.astype(np.uint32) + np.uint32(1)
    for k in range(window):
        value *= np.uint32(0x2C1B3C6D)
        value += wide[k : len(data) - window + 1 + k]
    value ^= value >> np.uint32(15)
    value *= np.uint32(0x85EBCA6B)
    return np.flatnonzero(value >> np.uint32(32 - bits) == 0) + window


def chunk_batches(seed: int, block_bytes: int, window: int, bits: int, least: int, most: int):
    """A recipe row for each document, and a row for each chunk that the block has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", block_bytes):
            texts = block["text"].cast(pa.binary()).to_pylist()
            bare = [x.translate(None, BLANKS) for x in texts]
            joined = b"".join(bare)
            cuts = cuts_of(np.frombuffer(joined, np.uint8), window, bits)
            ends = np.cumsum([len(x) for x in bare])
            chunks: dict[bytes, bytes] = {}
            recipes = []
            for end, text in zip(ends.tolist(), bare, strict=True):
                start = end - len(text)
                places = (cuts[np.searchsorted(cuts, start + least) : np.searchsorted(cuts, end)] - start).tolist()
                recipe, at = [], 0
                for place in [*places, len(text)]:
                    while place - at > most:
                        recipe.append(text[at : at + most])
                        at += most
                    if place - at >= least or place == len(text) > at:
                        recipe.append(text[at:place])
                        at = place
                own = [identifier(x, seed) for x in recipe]
                if any(chunks.setdefault(i, x) != x for i, x in zip(own, recipe, strict=True)):
                    chunks[CLASH] = b""
                recipes.append(b"".join(own))
            n, m = len(recipes), len(chunks)
            columns = [
                block["row"], block["doc_id"],
                pa.array([len(x.decode()) for x in texts], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in bare], pa.string()),
                pa.array(recipes, pa.binary()),
            ]
            columns = [pa.concat_arrays([x, pa.nulls(m, x.type)]) for x in columns]
            columns += [pa.array([None] * n + [*x], pa.binary()) for x in (chunks, chunks.values())]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in RECIPES.split(", ")])

    return run


def recipes_of(docs: DataFrame, *, block_bytes: int, window: int, bits: int, least: int, most: int) -> DataFrame:
    """Recipes over verified chunk identifiers."""
    seed = 0
    while True:
        cut = written(docs.mapInArrow(chunk_batches(seed, block_bytes, window, bits, least, most), RECIPES), "chunks")
        distinct = cut.filter("id is not null").select("id", "chunk").distinct()
        shared = distinct.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("id")).alias("size")).filter("n > 1 or size < 16")
        if shared.isEmpty():
            return cut.filter("row is not null").select("row", "doc_id", "n_points", "text_sha256", "recipe")
        seed += 1


def exact_copies(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4 << 20, window: int = 16,
    bits: int = 10, least: int = 256, most: int = 8192,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical without blanks (``[\\x20\\x09-\\x0D]``); null counts as empty, and empty texts are equal.
    Of a group the longest original text (code points) stays, of those the one with the smallest id (null last), of rows that
    repeat even that one. Groups are counted before they are shuffled, so that a group may hold any share of the rows; chunks of
    very long texts move on their own. An empty table gives an empty result; no other column is read.
    """
    options = {"block_bytes": block_bytes, "window": window, "bits": bits, "least": least, "most": most}
    return _decided(docs, id_col, text_col, options).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _decided(docs: DataFrame, id_col: str, text_col: str, options: dict) -> DataFrame:
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    recipes = recipes_of(rows, **options)
    rank = F.struct("n_points", (-F.col("doc_id")).alias("before"), (-F.col("row")).alias("first"))
    groups = written(recipes.groupBy("recipe").agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
    return recipes.join(groups, "recipe").select(
        "doc_id", (-F.col("best.before")).alias("keep_id"), "group_size", (F.col("row") == -F.col("best.first")).alias("kept"), "text_sha256", "n_points"
    )


def without_copies(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4 << 20, window: int = 16,
    bits: int = 10, least: int = 256, most: int = 8192,
) -> DataFrame:
    """The rows of ``docs`` that stay by ``exact_copies``, with all their columns; of rows that agree in id, length and text
    without blanks any one stays."""
    options = {"block_bytes": block_bytes, "window": window, "bits": bits, "least": least, "most": most}
    text, number = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).cast("long")
    keys = {"_id": F.coalesce(number, F.lit(0)), "_none": number.isNull(), "_length": F.length(text), "_sha": F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""), 256)}
    staying = _decided(docs, id_col, text_col, options).filter("kept")
    staying = staying.select(
        F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"), F.col("n_points").cast("int").alias("_length"), F.col("text_sha256").alias("_sha")
    )
    matched = packed(docs, keys).join(staying, list(keys), "left_semi")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_id"))
    return unpacked(matched.withColumn("nth", nth).filter("nth = 1"))
