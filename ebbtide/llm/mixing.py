"""Mixing sources to target weights by iterative proportional fitting (operator 3).

Token weights of the cells (source, language, topic) are raked until the weighted corpus has the target shares of every
source, language and topic. Documents are then sampled by calibrated probabilities: in proportion to their cell's weight,
with 1 as the most, so that the expected tokens are the wanted part of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.keys import id_keys, packed, row_keys, text_key, unpacked
from ebbtide.llm.text import blocks, hashed, split_words
from ebbtide.llm.text import mixed as mixed_bits
from ebbtide.session import written

SIDES = ("lang", "topic")
#: Vectors are stored as multiples of 1 / SCALE in two bytes; float64 sums of a batch and int64 sums of all rows are exact.
SCALE = float(1 << 14)


def _vectors(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of damped word counts by hash, and the number of words."""
    ids, offsets, vocabulary = split_words(texts)
    n = len(offsets) - 1
    cell = (hashed(vocabulary) % np.uint64(width)).astype(np.int64)[ids] if len(ids) else np.empty(0, np.int64)
    counts = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * width + cell, minlength=n * width).reshape(n, width)
    rows = np.sqrt(counts.astype(np.float64))
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12), np.diff(offsets)


def vector_batches(width: int, block_bytes: int):
    """Unit vectors of the texts with words, as whole multiples of 1 / ``SCALE``, so that sums don't depend on their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", block_bytes):
            rows, words = _vectors(block["text"], width)
            whole = np.round(rows[words > 0] * SCALE).astype("<i2")
            vectors = pa.array([x.tobytes() for x in whole], pa.binary())
            yield pa.RecordBatch.from_arrays([block["h"].filter(pa.array(words > 0)), vectors], ["h", "vector"])

    return run


def _unpacked(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch["vector"].to_pylist()), "<i2").reshape(-1, width).astype(np.float64)


def _near(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Rounded cosines, so that ties don't hang on the last bits of a sum."""
    return np.round(rows / SCALE @ centres.T, 9)


def seed_batches(centres: np.ndarray, most: int):
    """A task's ``most`` rows of the largest weighted draws: a row's chance is in proportion to its distance from the nearest
    centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: set[tuple[float, bytes]] = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = np.maximum(1 - _near(_unpacked(batch, centres.shape[1]), centres).max(1, initial=0.0), 0)
            h = batch["h"].to_numpy().view(np.uint64)
            u = ((mixed_bits(h + np.uint64(len(centres) + 1) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
            draw = np.where(apart > 1e-6, np.log(u) / np.maximum(apart, 1e-6), -np.inf)
            for k in np.argsort(-draw, kind="stable")[: 4 * most].tolist():
                if draw[k] > -np.inf:
                    best.add((float(draw[k]), batch["vector"][k].as_py()))
            best = set(sorted(best, reverse=True)[: 4 * most])
        found = sorted(best, reverse=True)
        yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.float64()), pa.array([v for _, v in found], pa.binary())], ["draw", "vector"])

    return run


def sum_batches(centres: np.ndarray):
    """A task's sums of the vectors nearest to each centre; cell -1 has their number, and the sum of their rounded cosines is
    the last topic's, in millionths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, close = np.zeros(centres.shape, np.int64), np.zeros(len(centres), np.int64), 0
        for batch in batches:
            rows = _unpacked(batch, centres.shape[1])
            if not len(rows):
                continue
            near = _near(rows, centres)
            nearest = near.argmax(1)
            sums += ((nearest[None, :] == np.arange(len(centres))[:, None]).astype(np.float64) @ rows).astype(np.int64)
            counts += np.bincount(nearest, minlength=len(centres))
            close += int(np.round(near.max(1) * 1e6).sum())
        topic, cell = np.nonzero(sums)
        used = np.flatnonzero(counts)
        columns = [np.concatenate((topic, used, [len(centres)])), np.concatenate((cell, np.full(len(used) + 1, -1))), np.concatenate((sums[topic, cell], counts[used], [close]))]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["topic", "cell", "total"])

    return run


def _round(vectors: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """All rows' sums and numbers by their nearest centre, and the sum of their cosines in millionths."""
    found = vectors.mapInArrow(sum_batches(centres), "topic long, cell long, total long").groupBy("topic", "cell").agg(F.sum("total").alias("total")).toArrow()
    topic, cell, total = (found[c].to_numpy() for c in ("topic", "cell", "total"))
    sums, counts = np.zeros(centres.shape), np.zeros(len(centres), np.int64)
    inner = cell >= 0
    sums[topic[inner], cell[inner]] = total[inner]
    own = ~inner & (topic < len(centres))
    counts[topic[own]] = total[own]
    return sums, counts, int(total[topic == len(centres)].sum())


def _moved(sums: np.ndarray, centres: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.where(size > 0, sums / np.maximum(size, 1e-12), centres)  # a centre without rows stays


def _reduced(candidates: np.ndarray, weights: np.ndarray, topics: int, rounds: int = 50) -> np.ndarray:
    """``topics`` centres of weighted candidates: each next start is the candidate of the largest weight times distance, then rounds
    of k-means among the candidates."""
    centres = candidates[:0]
    while len(centres) < topics:
        far = np.maximum(1 - np.round(candidates @ centres.T, 9).max(1, initial=0.0), 0)
        if far.max() <= 1e-6:
            break
        centres = np.concatenate((centres, candidates[[int((far * weights).argmax())]]))
    for _ in range(rounds):
        nearest = np.round(candidates @ centres.T, 9).argmax(1)
        moved = _moved((nearest[None, :] == np.arange(len(centres))[:, None]) * weights[None, :] @ candidates, centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def fit_topics(
    docs: DataFrame, *, topics: int = 12, width: int = 256, rounds: int = 25, passes: int = 4, least_gain: float = 1e-4, id_col: str = "doc_id",
    text_col: str = "text", block_bytes: int = 4 << 20,
) -> np.ndarray:
    """Centres of word-count vectors by spherical k-means over all rows with a word, each row counted.

    The vectors are written once. Starts are found in a few ``passes`` over all rows (k-means||): each draws 4 * ``topics``
    distinct rows by their distance from those drawn before; then every row is counted at the nearest one, and the driver reduces
    these few weighted candidates to ``topics``. The draws depend on ids and texts alone. In a round each task sums its vectors by
    their nearest centre, which Spark adds up, so that only the sums reach the driver. Rounds end when the mean cosine grows by
    less than ``least_gain``. Fewer distinct vectors than ``topics`` give as many centres as there are; a table without words has
    one, of zeros. A very long text is read in a block alone; other columns are not read.
    """
    h = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))
    texts = docs.select(h.alias("h"), F.col(text_col).alias("text")).filter("text is not null")
    vectors = written(texts.mapInArrow(vector_batches(width, block_bytes), "h long, vector binary"), "vectors")
    drawn = np.zeros((0, width))
    for _ in range(passes):
        seeds = vectors.mapInArrow(seed_batches(drawn, topics), "draw double, vector binary").distinct().orderBy(F.desc("draw"), F.desc("vector")).limit(4 * topics).collect()
        if not seeds:
            break
        new = np.unique(np.stack([np.frombuffer(r["vector"], "<i2") for r in seeds]), axis=0).astype(np.float64)
        drawn = np.concatenate((drawn, new / np.linalg.norm(new, axis=1, keepdims=True)))
    if not len(drawn):
        return np.zeros((1, width))
    centres = _reduced(drawn, _round(vectors, drawn)[1].astype(np.float64), topics)
    before = None
    for _ in range(rounds):
        sums, counts, close = _round(vectors, centres)
        centres = _moved(sums, centres)
        if before is not None and close - before <= least_gain * 1e6 * counts.sum():
            break
        before = close
    return centres


def topic_batches(centres: np.ndarray, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", block_bytes):
            rows, words = _vectors(block["text"], centres.shape[1])
            topic = np.where(words > 0, np.round(rows @ centres.T, 9).argmax(1), -1)
            columns = [block[n] for n in ("doc_id", "key", "source", "lang")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(topic.astype(np.int64)), pa.array(words.astype(np.int64))], ["doc_id", "key", "source", "lang", "topic", "n_tokens"])

    return run


def tempered(cells: DataFrame, power: float) -> dict[str, DataFrame]:
    """Target shares by a power below 1, which lifts what is rare: of sources and of languages their own shares of tokens to
    that power, of topics the shares within each language to that power, so that topics never contradict languages."""
    spark = cells.sparkSession
    sources = cells.groupBy("source").agg(F.sum("mass").cast("double").alias("own")).filter("own > 0")
    whole = sources.agg(F.sum(F.pow("own", F.lit(power)))).first()[0] or 1.0
    found = {"source": sources.select("source", (F.pow("own", F.lit(power)) / F.lit(whole)).alias("target"))}
    pairs = cells.groupBy("lang", "topic").agg(F.sum("mass").cast("double").alias("own")).filter("own > 0").collect()
    by_lang: dict = {}
    for r in pairs:
        by_lang.setdefault(r["lang"], {})[r["topic"]] = r["own"]
    langs = {x: sum(t.values()) ** power for x, t in by_lang.items()}
    total = sum(langs.values()) or 1.0
    topics: dict = {}
    for x, own in by_lang.items():
        damped = {t: v**power for t, v in own.items()}
        for t, v in damped.items():
            topics[t] = topics.get(t, 0.0) + langs[x] / total * v / sum(damped.values())
    found["lang"] = spark.createDataFrame([(x, v / total) for x, v in sorted(langs.items())], "lang string, target double")
    found["topic"] = spark.createDataFrame(sorted(topics.items()), "topic long, target double")
    return found


def rake(cells: DataFrame, targets: dict[str, DataFrame], *, rounds: int = 100, tolerance: float = 1e-6) -> DataFrame:
    """``cells`` (source, lang, topic, mass) with the raked ``weight`` of a token.

    There is a row for each source, with its languages and topics; a round scales every source within its row, then
    languages and topics in turn. Only the sums by language and topic, which are few, reach the driver. A category without
    tokens or without a target gets no weight. Rounds end when all shares are within ``tolerance`` of their targets; if the
    targets contradict each other, which no weights can meet, they end when the largest miss no longer shrinks, with the
    sources' shares exact.
    """
    total = cells.agg(F.sum("mass")).first()[0]
    if not total:
        return cells.withColumn("weight", F.lit(0.0))
    share = (F.col("mass") / F.lit(float(total))).alias("share")
    rows = cells.filter("mass > 0").groupBy("source").agg(F.collect_list(F.struct("lang", "topic", share)).alias("cells"))
    rows = written(rows.join(targets["source"], "source"), "rake")
    wanted = {c: {r[c]: r["target"] for r in targets[c].collect()} for c in SIDES}
    factors = {c: {k: 1.0 for k in wanted[c]} for c in SIDES}

    def looked_up(c: str, cell: Column) -> Column:
        table = F.create_map(*(F.lit(x) for pair in factors[c].items() for x in pair))
        return F.coalesce(F.element_at(table, cell[c]), F.lit(0.0))

    def scaled() -> DataFrame:
        def of(cell: Column) -> Column:
            return cell["share"] * looked_up("lang", cell) * looked_up("topic", cell)

        mass = F.aggregate("cells", F.lit(0.0), lambda sum_, cell: sum_ + of(cell))
        lift = F.when(mass > 0, F.col("target") / mass).otherwise(0.0)
        return rows.withColumn("lift", lift).select("source", "lift", F.explode("cells").alias("cell"))

    misses: list[float] = []
    for _ in range(rounds):
        mass = F.col("lift") * F.col("cell.share") * looked_up("lang", F.col("cell")) * looked_up("topic", F.col("cell"))
        sums = scaled().groupBy("cell.lang", "cell.topic").agg(F.sum(mass).alias("x")).collect()
        table = {(r["lang"], r["topic"]): r["x"] for r in sums if r["x"]}
        misses.append(_fitted(table, wanted, factors))
        if misses[-1] < tolerance or len(misses) > 5 and misses[-1] > 0.99 * misses[-6]:
            break
    done = scaled().select("source", "cell.*", (F.col("lift") * looked_up("lang", F.col("cell")) * looked_up("topic", F.col("cell"))).alias("weight"))
    return cells.join(written(done.drop("share"), "raked"), ["source", "lang", "topic"], "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))


def _fitted(table: dict, wanted: dict, factors: dict, rounds: int = 20) -> float:
    """Scale languages and topics in turn to their targets; the largest relative miss before that."""
    worst = 0.0
    for k in range(rounds):
        for i, c in enumerate(SIDES):
            sums: dict = {}
            for key, x in table.items():
                sums[key[i]] = sums.get(key[i], 0.0) + x
            lifts = {v: wanted[c][v] / x for v, x in sums.items() if v in wanted[c]}
            if not k:
                worst = max([worst, *(abs(1 / x - 1) for x in lifts.values())])
            for v, x in lifts.items():
                factors[c][v] *= x
            table = {key: x * lifts.get(key[i], 1.0) for key, x in table.items()}
    return worst


def scale_for(cells: DataFrame, part: float) -> float:
    """The factor with which probabilities ``min(1, factor * weight)`` keep ``part`` of the tokens in expectation.

    If ``part`` is more than all cells with weight hold, everything that has weight is kept.
    """
    total = float(cells.agg(F.sum("mass")).first()[0] or 0)
    factor = part
    while True:
        full = F.col("weight") * F.lit(factor) >= 1
        sums = cells.agg(
            F.sum(F.when(full, F.col("mass")).otherwise(0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("mass") * F.col("weight"))).alias("rest")
        ).first()
        rest = sums["rest"] or 0.0
        if rest <= 1e-12 * max(total, 1):
            return factor
        better = (part * total - float(sums["full"] or 0)) / rest
        if better <= factor * (1 + 1e-12):
            return factor
        factor = better


def mixture(
    docs: DataFrame, centres: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
    power: float = 0.8, part: float = 0.9, seed: int = 1, targets: dict[str, DataFrame] | None = None, block_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``source``, ``lang``, ``topic``, ``n_tokens`` (words), raked ``weight``,
    ``probability`` and ``kept``.

    ``targets`` has a table (category, ``target``) for each of source, lang and topic; by default shares are tempered by
    ``power``. Null sources and languages are the category ''. A text without words (null, empty) has topic -1, no tokens and is
    not kept; a category without target has weight 0. Every row has a draw of its own, by ``seed``, id, text hash, source, language
    and a number among the rows that agree in all of these, which are counted before they are shuffled. An empty table gives an
    empty result. Cells are summed before the shuffle, however large a source is.
    """
    drawn = _drawn(docs, centres, id_col, text_col, source_col, lang_col, power, part, seed, targets, block_bytes)
    return drawn.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "kept")


def _cell_keys(source_col: str, lang_col: str) -> dict[str, Column]:
    return {n: F.coalesce(F.col(c).cast("string"), F.lit("")) for n, c in (("_source", source_col), ("_lang", lang_col))}


def _drawn(
    docs: DataFrame, centres: np.ndarray, id_col: str, text_col: str, source_col: str, lang_col: str, power: float, part: float, seed: int,
    targets: dict[str, DataFrame] | None, block_bytes: int,
) -> DataFrame:
    cell = _cell_keys(source_col, lang_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("key"), cell["_source"].alias("source"), cell["_lang"].alias("lang"),
        F.col(text_col).alias("text"),
    )
    sized = written(rows.mapInArrow(topic_batches(centres, block_bytes), "doc_id long, key long, source string, lang string, topic long, n_tokens long"), "topics")
    cells = written(sized.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("mass")), "cells")
    targets = targets or tempered(cells, power)
    raked = written(rake(cells, targets), "cells")
    chance = F.least(F.lit(1.0), F.col("weight") * F.lit(scale_for(raked, part)))
    equal = sized.groupBy("doc_id", "key", "source", "lang", "topic", "n_tokens").agg(F.count(F.lit(1)).alias("equals"))
    numbered = equal.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("equals"))))
    draw = F.shiftrightunsigned(F.xxhash64(F.struct("doc_id", "key", "source", "lang", "nth"), F.lit(seed)), 11) / F.lit(float(1 << 53))
    joined = numbered.join(raked.drop("mass"), ["source", "lang", "topic"]).withColumn("probability", chance)
    return joined.withColumn("kept", draw < F.col("probability"))


def mixed(
    docs: DataFrame, centres: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
    power: float = 0.8, part: float = 0.9, seed: int = 1, targets: dict[str, DataFrame] | None = None, block_bytes: int = 4 << 20,
) -> DataFrame:
    """The sampled rows of ``docs``, with all their columns: as many as ``mixture`` keeps of those that agree in id, text, source
    and language. Only where some but not all of such rows are kept are they brought together and numbered."""
    keys = {**row_keys(id_col, text_col), **_cell_keys(source_col, lang_col)}
    drawn = _drawn(docs, centres, id_col, text_col, source_col, lang_col, power, part, seed, targets, block_bytes)
    named = drawn.withColumns(id_keys(F.col("doc_id"))).withColumnsRenamed({"key": "_key", "source": "_source", "lang": "_lang"})
    counts = written(named.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"), F.count_if("kept").alias("_kept")).filter("_kept > 0"), "drawn")
    keyed = packed(docs, keys)
    whole = keyed.join(counts.filter("_kept = _all"), list(keys), "left_semi")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_id"))
    some = keyed.join(counts.filter("_kept < _all"), list(keys)).withColumn("nth", nth).filter("nth <= _kept")
    return unpacked(whole.select("row").unionAll(some.select("row")))
