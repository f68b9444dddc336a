"""Near duplicates by a chosen-path join on word shingles (operator 10).

Documents with the same shingle set are one member. A run splits the members on a sampled coordinate of their minwise
signature, that is on a shared token of their sets; buckets that stay large are split again on further coordinates, drawn
by the bucket's path, and the members of a small bucket are compared by brute force on sketches. Runs repeat until a pair at
the threshold is found with the target recall. Members that sketches connect form a candidate family; the families' sets
are then compared exactly, in blocks, which counts all links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.components import components
from ebbtide.llm.keys import id_keys, packed, row_keys, unpacked
from ebbtide.llm.text import blocks, draws, minhash, mixed, shingle_sets
from ebbtide.session import written

SIGNED = "row long, doc_id long, key long, digest binary, n_shingles long, signature binary, sketch binary"


def runs_for(recall: float, threshold: float, depth: int) -> int:
    """Runs after which a pair at the threshold is missed with probability ``1 - recall`` at most.

    A run's first split keeps a pair together with probability ``threshold``. Each of up to ``depth`` later splits has two
    children: a pair that gets through the levels below with ``p`` gets through one more with ``1 - (1 - threshold * p)^2``.
    """
    p = 1.0
    for _ in range(depth):
        p = 1 - (1 - threshold * p) ** 2
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold * p)))


def sketch_misses(threshold: float, slack: float, width: int) -> float:
    """Probability that the sketches of a pair at the threshold agree in too few of their ``width`` bytes."""
    same, least = threshold + (1 - threshold) / 256, int((threshold - slack) * width)
    return sum(math.comb(width, k) * same**k * (1 - same) ** (width - k) for k in range(least))


def sign_batches(size: int, width: int, seed: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, factors = draws(seed, width)
        for block in blocks(batches, "text", block_bytes):
            sets = shingle_sets(block["text"], size)
            signatures = [minhash(x, masks, factors) if len(x) else None for x in sets]
            columns = [
                pa.array([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets], pa.binary()),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array([None if x is None else x.tobytes() for x in signatures], pa.binary()),
                pa.array([None if x is None else (x & 255).astype(np.uint8).tobytes() for x in signatures], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([block["row"], block["doc_id"], block["key"], *columns], [x.split()[0] for x in SIGNED.split(", ")])

    return run


def split_batches(coordinates: list[int]):
    """First level: a bucket for each run and value of the run's coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = _matrix(batch["signature"], np.uint32)
            for k, c in enumerate(coordinates):
                keys = mixed(np.uint64(k + 1) << np.uint64(40) ^ table[:, c].astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch["node"]], ["bucket", "node"])

    return run


def resplit_batches(children: int):
    """Next level: each bucket draws its coordinates by its path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = _matrix(batch["signature"], np.uint32)
            path = batch["bucket"].to_numpy().view(np.uint64)
            rows = np.arange(len(path))
            for k in range(children):
                drawn = mixed(path + np.uint64(k + 1))
                value = table[rows, (drawn % np.uint64(table.shape[1])).astype(np.int64)]
                keys = mixed(drawn ^ value.astype(np.uint64) << np.uint64(17))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch["node"]], ["bucket", "node"])

    return run


def brute_batches(least: float):
    """Small buckets, sorted: connect each member to the first of those that its sketch reaches within the bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, ["bucket"]):
            _, starts = _bounds(batch, ["bucket"])
            sizes = np.diff(starts)
            node, sketch = batch["node"].to_numpy(), _matrix(batch["sketch"], np.uint8)
            most = int(least * sketch.shape[1])
            for size in np.unique(sizes).tolist():
                first = starts[:-1][sizes == size]
                step = max(1, (1 << 18) // size**2)
                for k in range(0, len(first), step):
                    at = first[k : k + step, None] + np.arange(size)
                    s = sketch[at]
                    near = np.zeros((len(at), size, size), bool)
                    for i in range(size):
                        near[:, i, i:] = (s[:, i : i + 1] == s[:, i:]).sum(2) >= most
                    a, b = _spanning(near, node[at])
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _spanning(near: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group's matrix of pairs, an edge from every member to its component's first member."""
    size = near.shape[1]
    near |= near.transpose(0, 2, 1)
    label = np.broadcast_to(np.arange(size), near.shape[:2]).copy()
    while True:
        reached = np.where(near, label[:, None, :], size).min(2)
        reached = np.take_along_axis(np.minimum(reached, label), np.minimum(reached, label), 1)
        if np.array_equal(reached, label):
            break
        label = reached
    moved = label != np.arange(size)
    return node[moved], np.take_along_axis(node, label, 1)[moved]


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1) if len(column) else np.empty((0, 1), kind)


def _bounds(batch: pa.RecordBatch, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    table = np.stack([batch[k].to_numpy() for k in keys], 1)
    first = np.concatenate(([True], (table[1:] != table[:-1]).any(1)))
    starts = np.flatnonzero(first)
    return table[starts], np.append(starts, len(table))


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows that never cut a group in two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        _, starts = _bounds(batch, keys)
        if held and (len(starts) > 2 or any(held[-1][k][held[-1].num_rows - 1] != batch[k][0] for k in keys)):
            same = all(held[-1][k][held[-1].num_rows - 1] == batch[k][0] for k in keys)
            stop = int(starts[1]) if same else 0
            yield pa.concat_batches([*held, batch.slice(0, stop)])
            held, batch = [], batch.slice(stop)
            _, starts = _bounds(batch, keys) if batch.num_rows else (None, np.zeros(1, np.int64))
        if len(starts) > 2:
            yield batch.slice(0, int(starts[-2]))
            batch = batch.slice(int(starts[-2]))
        if batch.num_rows:
            held.append(batch)
    if held:
        yield pa.concat_batches(held)


def set_batches(size: int, block_bytes: int):
    """The members' shingle sets, from the text of one document of each: where several rows agree in id and text, a task
    takes the first of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken: set[int] = set()

        def fresh(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in rows:
                nodes = batch["node"].to_pylist()
                first = {n: k for k, n in reversed(list(enumerate(nodes))) if n not in taken}
                taken.update(first)
                yield batch.take(pa.array(sorted(first.values()), pa.int64())) if len(first) < len(nodes) else batch

        for block in blocks(fresh(batches), "text", block_bytes):
            sets = shingle_sets(block["text"], size)
            own = [len(x) > 0 and xxhash.xxh3_128_digest(x.tobytes()) == d for x, d in zip(sets, block["digest"].to_pylist(), strict=True)]
            kept = block.filter(pa.array(own))
            data = pa.array([x.tobytes() for x, y in zip(sets, own, strict=True) if y], pa.binary())
            names = ["node", "family", "tiles", "tile", "copies"]
            yield pa.RecordBatch.from_arrays([*(kept[n] for n in names), data], [*names, "shingles"])

    return run


def link_batches(threshold: float):
    """Exact similarities within a tile of a family, or between two tiles: links of every member, and spanning edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, ["family", "low", "high"]):
            keys, starts = _bounds(batch, ["family", "low", "high"])
            node, tile, copies = (batch[c].to_numpy() for c in ("node", "tile", "copies"))
            sets = [np.frombuffer(x, np.uint64) for x in batch["shingles"].to_pylist()]
            found = []
            for (_, low, high), a, b in zip(keys.tolist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                _, one = np.unique(node[a:b], return_index=True)
                one += a
                near = _near([sets[k] for k in one.tolist()], threshold)
                np.fill_diagonal(near, False)
                if low != high:
                    near &= tile[one][:, None] != tile[one][None, :]
                links = near @ copies[one]
                edge_a, edge_b = _spanning(near[None] | np.eye(len(one), dtype=bool)[None], node[one][None])
                to = dict(zip(edge_a.tolist(), edge_b.tolist(), strict=True))
                found += [(n, int(x), to.get(n)) for n, x in zip(node[one].tolist(), links.tolist(), strict=True) if x]
            columns = list(zip(*found, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "to"])

    return run


def _near(sets: list[np.ndarray], threshold: float, step: int = 1 << 13) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of ``threshold`` or more; shingles of one set only are left out."""
    sizes = np.array([len(x) for x in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.concatenate(([True], values[1:] != values[:-1]))
    place = np.cumsum(fresh) - 1
    shared = np.bincount(place)[place] > 1
    _, place = np.unique(place[shared], return_inverse=True)
    owner = owner[shared]
    common = np.zeros((len(sets), len(sets)))
    cuts = np.searchsorted(place, np.arange(0, (place[-1] if len(place) else -1) + 1 + step, step))
    for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        table = np.zeros((len(sets), step), np.float32)
        table[owner[a:b], place[a:b] - k * step] = 1
        common += table @ table.T
    return common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9


def _sorted(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def candidate_edges(members: DataFrame, *, threshold: float, recall: float, leaf: int, slack: float, width: int, depth: int) -> DataFrame:
    """Edges that connect the members of each candidate family (``node``, ``signature``, ``sketch``)."""
    lost = sketch_misses(threshold, slack, width)
    runs = runs_for(recall + lost, threshold, depth) if recall + lost < 1 else width + 1
    if runs > width:
        raise ValueError(f"signatures of width {width} cannot reach recall {recall} at threshold {threshold}: take a lower recall or a larger width")
    coordinates = np.random.default_rng(runs).permutation(width)[:runs].tolist()
    level = members.select("node", "signature").mapInArrow(split_batches(coordinates), "bucket long, node long")
    found = None
    for k in range(depth + 1):
        level = written(level, "buckets")
        sizes = level.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("pivot")).filter("n > 1")
        shared = written(level.join(written(sizes, "sizes"), "bucket"), "shared")
        small = shared.filter(F.col("n") <= leaf).join(members.select("node", "sketch"), "node").select("bucket", "node", "sketch")
        edges = _sorted(small, "bucket").mapInArrow(brute_batches(threshold - slack), "a long, b long")
        large = shared.filter(F.col("n") > leaf)
        done = large.isEmpty()
        if k == depth and not done:  # what no coordinate splits is one family, to be compared in tiles
            edges = edges.union(large.filter("node <> pivot").select("node", "pivot"))
        edges = written(edges.distinct(), "candidates")
        found = edges if found is None else found.unionByName(edges)
        if done or k == depth:
            return found
        level = large.join(members.select("node", "signature"), "node").select("bucket", "node", "signature").mapInArrow(resplit_batches(2), "bucket long, node long").distinct()


def near_copies(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.8, recall: float = 0.9999,
    leaf: int = 2048, tile: int = 192, width: int = 64, slack: float = 0.2, depth: int = 8, seed: int = 7, block_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id`` (smallest id of its class, or null if it has none), ``n_links``.

    Two documents are linked when the sets of their ``size``-word shingles have a Jaccard similarity of ``threshold`` or more;
    classes are the components of the links. Words are runs without ``[\\x20\\x09-\\x0D]``; fewer words than ``size`` are one
    shingle, and a text without words (null, empty) has no links and is a class alone. ``n_links`` counts the other rows that a row
    is linked to, copies included, though copies are one member in all comparisons. Ids may repeat or be null, in any share of
    the rows: their rows count apart, and texts are found again by id and text hash. An
    empty table gives an empty result; no other column is read. Any share of the rows may be copies: they are counted before
    they are shuffled. A large family is compared tile by tile, each in a task of its own, and no pair leaves its task.
    """
    classed = _classed(docs, id_col, text_col, size, threshold, recall, leaf, tile, width, slack, depth, seed, block_bytes)
    return classed.select("doc_id", "class_id", "n_links")


def _classed(
    docs: DataFrame, id_col: str, text_col: str, size: int, threshold: float, recall: float, leaf: int, tile: int, width: int, slack: float,
    depth: int, seed: int, block_bytes: int,
) -> DataFrame:
    """Rows with the hash of their text, and the ``label`` of their class, null without words."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("key", F.xxhash64("text"))
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "key", "text")
    signed = written(rows.mapInArrow(sign_batches(size, width, seed, block_bytes), SIGNED), "signed")
    sets = signed.filter("digest is not null").groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    sets = written(sets, "members")
    heads = sets.select(F.col("node").alias("row"), "copies", "least")
    members = written(signed.join(heads, "row").select(F.col("row").alias("node"), "doc_id", "key", "digest", "signature", "sketch", "copies"), "heads")
    edges = candidate_edges(members, threshold=threshold, recall=recall, leaf=leaf, slack=slack, width=width, depth=depth)
    families = components(edges).withColumnRenamed("label", "family")
    tiles = families.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("long").alias("tiles"))
    placed = families.join(tiles, "family").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    sought = placed.join(members.select("node", "digest", "copies", F.col("doc_id").alias("of"), F.col("key").alias("of_key")), "node")
    own = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    found = texts.join(sought, own).select("text", "digest", "node", "family", "tiles", "tile", "copies").mapInArrow(
        set_batches(size, block_bytes), "node long, family long, tiles long, tile long, copies long, shingles binary"
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    pairs = found.withColumn("other", other).withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
    links = _sorted(pairs.select("family", "low", "high", "node", "tile", "copies", "shingles"), "family", "low", "high")
    links = written(links.mapInArrow(link_batches(threshold), "node long, links long, to long"), "links")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(links.filter("to is not null").select(F.col("node").alias("a"), F.col("to").alias("b")))
    known = sets.join(counts, "node", "left").join(classes, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = known.groupBy("label").agg(F.min("least").alias("class_id"))
    linked = known.join(ids, "label").select("digest", "label", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    joined = signed.select("doc_id", "key", "digest").join(linked, "digest", "left")
    return joined.select(
        "doc_id", "key", "label", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links")
    )


def one_of_each_class(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.8, recall: float = 0.9999,
    leaf: int = 2048, tile: int = 192, width: int = 64, slack: float = 0.2, depth: int = 8, seed: int = 7, block_bytes: int = 4 << 20,
) -> DataFrame:
    """One row of each class, with all its columns: the one with the smallest id (null last), of those the one with the smallest
    text hash, of rows that agree in both any one. Every row without words is a class alone and stays."""
    keys = row_keys(id_col, text_col)
    classed = _classed(docs, id_col, text_col, size, threshold, recall, leaf, tile, width, slack, depth, seed, block_bytes)
    first = F.min(F.struct("_none", "_id", F.col("key").alias("_key"))).alias("first")
    staying = classed.filter("label is not null").withColumns(id_keys(F.col("doc_id"))).groupBy("label").agg(first).select("first.*")
    worded = F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    single = packed(docs.filter(worded), keys).join(staying, list(keys), "left_semi").dropDuplicates(list(keys))
    return unpacked(single).unionByName(docs.filter(~worded))
