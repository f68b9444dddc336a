"""Event topics: JSON-lines folders with line offsets, and Kafka."""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ebbtide.sources.commits import created, jvm_path
from ebbtide.sources.topic_stream import TopicSource

EVENT = "customer_id string, event_type string, timestamp string, value double, is_simulated boolean"
#: Hidden from readers of the topic by its first letter.
INDEX = "_offsets"
RISK_UPDATE = (
    "customer_id string, event_type string, timestamp string, previous_probability double, new_probability double, "
    "risk_change double, previous_risk_level string, new_risk_level string, revenue_at_risk double, "
    "recommended_action string, model_version string, is_simulated boolean"
)


def envelope(fields: str) -> str:
    return f"key string, value struct<{_typed(fields)}>"


def _typed(fields: str) -> str:
    return ", ".join(": ".join(f.strip().split(" ")) for f in fields.split(","))


def messages(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows as topic messages: one JSON text ``{"key", "value"}`` per row (batch or stream)."""
    return df.select(F.to_json(F.struct(F.col(key).alias("key"), F.struct(*df.columns).alias("value"))).alias("value"))


def delivery(path: str) -> str:
    """A new subfolder of a topic; names sort in order of delivery."""
    return f"{path}/{datetime.now(timezone.utc):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:8]}"


def produce(df: DataFrame, path: str, key: str = "customer_id") -> None:
    """Append rows to a topic folder; the order of ``df`` is the order of the offsets."""
    messages(df, key).write.text(delivery(path))


def purge(spark: SparkSession, path: str) -> None:
    """Empty a topic before a fresh run."""
    spark.createDataFrame([], "value string").write.mode("overwrite").text(path)


def _text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.options(recursiveFileLookup=True, lineSep="\n").text(paths)


def _filled() -> Column:
    return F.col("value").rlike(r"\S")


# --- offset index: a row per delivered file with its first offset and its numbers of lines ---------------
@dataclass(frozen=True)
class Delivered:
    """One file of a topic. Lines ``first`` to ``first + n - 1`` are in it, ``filled`` of them not blank; ``blocks`` holds the
    first byte and the number of lines of each range in which the file was counted."""

    file: str
    first: int
    n: int
    filled: int
    blocks: list[list[int]]


def _indexed(spark: SparkSession, path: str) -> tuple[list[Delivered], int]:
    """Indexed files in order of their offsets, and how many index entries there are."""
    folder, system = jvm_path(spark, f"{path}/{INDEX}")
    if not system.exists(folder):
        return [], 0
    names = sorted(str(x.getPath()) for x in system.listStatus(folder) if x.getPath().getName().isdigit())
    if not names:
        return [], 0
    rows = spark.read.schema("file string, first long, n long, filled long, blocks array<array<long>>").json(names).orderBy("first", "file").collect()
    return [Delivered(*r) for r in rows], len(names)


def offset_index(spark: SparkSession, path: str) -> list[Delivered]:
    """The topic's files in order of offsets. Only files that were delivered since the last call are read, to count their lines.

    Offsets never change once they are given out: new files, in order of their names, follow all indexed ones. An entry of the
    index is a file that is created only if it is absent, so of two readers that index the same files one starts again. Files of
    a writer that has not finished are not listed. The driver holds a row for each file, as it does for any scan.
    """
    while True:
        known, entries = _indexed(spark, path)
        seen = {d.file for d in known}
        fresh = sorted(f for f in _text(spark, path).inputFiles() if f not in seen)
        if not fresh:
            return known
        counts = (
            _text(spark, [unquote(f) for f in fresh])
            .groupBy(F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("start"))
            .agg(F.count("*").alias("n"), F.count_if(_filled()).alias("filled"))
        )
        found = defaultdict(list)
        for r in counts.collect():  # a row for each block of a new file, as its scan has
            found[r["file"]].append((r["start"], r["n"], r["filled"]))
        first, added = known[-1].first + known[-1].n if known else 0, []
        for file in fresh:
            blocks = sorted(found[file])
            added.append(Delivered(file, first, sum(b[1] for b in blocks), sum(b[2] for b in blocks), [list(b[:2]) for b in blocks]))
            first += added[-1].n
        if created(spark, f"{path}/{INDEX}/{entries:012d}", "\n".join(json.dumps(asdict(d)) for d in added)):
            return known + added


def _lines(spark: SparkSession, files: list[Delivered]) -> DataFrame:
    """Lines of these files with their offsets. A file's blocks are counted first, then lines are placed within their block."""
    if not files:
        return spark.createDataFrame([], "offset long, value string")
    lines = _text(spark, [unquote(d.file) for d in files]).select(
        "value", F.input_file_name().alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_mid")
    )
    place = ["_file", "_block"]
    blocks = lines.groupBy(*place).agg(F.count("*").alias("_n"), F.min("_mid").alias("_first"))
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)  # one row per block of a file
    starts = spark.createDataFrame([(d.file, d.first) for d in files], "_name string, _start long")
    placed = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(starts, F.col("_file") == F.col("_name"))
    return lines.join(placed, place).select((F.col("_start") + F.col("_before") + F.col("_mid") - F.col("_first")).alias("offset"), "value")


def read_topic(spark: SparkSession, path: str, fields: str, from_offset: int = 0, until: int | None = None) -> DataFrame:
    """Messages from ``from_offset`` on, up to ``until`` (without it): offset, key, value columns. Only the files that hold such
    offsets are read. Blank lines keep their offset but are skipped; a message may be an envelope or a bare value."""
    asked = [d for d in offset_index(spark, path) if d.n and d.first + d.n > from_offset and (until is None or d.first < until)]
    return _messages_of(_lines(spark, asked).filter((F.col("offset") >= from_offset) & (F.lit(until is None) | (F.col("offset") < (until or 0)))), fields)


def _messages_of(lines: DataFrame, fields: str) -> DataFrame:
    wrapped, bare = F.from_json("value", envelope(fields)), F.from_json("value", fields)
    return lines.filter(_filled()).select(
        "offset", wrapped["key"].alias("key"), F.coalesce(wrapped["value"], bare).alias("v")
    ).select("offset", "key", "v.*")


def topic_count(spark: SparkSession, path: str) -> DataFrame:
    """Messages that are not blank, from the index: nothing that was counted before is read again."""
    return spark.createDataFrame([(sum(d.filled for d in offset_index(spark, path)),)], "n long")


def latest(spark: SparkSession, path: str, fields: str, n: int = 20) -> DataFrame:
    """The last n messages, newest first, from the last files that hold so many."""
    asked, held = [], 0
    for d in reversed(offset_index(spark, path)):
        if held >= n:
            break
        asked.append(d)
        held += d.filled
    return _messages_of(_lines(spark, [d for d in asked if d.n]), fields).orderBy(F.desc("offset")).limit(n)


def committed_offset(spark: SparkSession, path: str, reader: str) -> int:
    """The offset up to which ``reader`` has committed, 0 for a new one."""
    folder, system = jvm_path(spark, f"{path}/{INDEX}/{reader}")
    return max((int(x.getPath().getName()) for x in system.listStatus(folder)), default=0) if system.exists(folder) else 0


def process_new(
    spark: SparkSession, path: str, fields: str, reader: str, handle: Callable[[DataFrame, int, int], None], most: int = 5_000_000
) -> int:
    """Hand everything a reader has not yet committed to ``handle(messages, first, end)``, in runs of about ``most`` offsets that end
    with a file, and commit each run after it. Returns the new offset.

    A run that fails is handed over again with the same bounds as long as no file was added behind it, so ``handle`` should write
    by ``first``. Committing is creating a file of the offset's name, which survives a restart.
    """
    while True:
        first = committed_offset(spark, path, reader)
        ahead = [d for d in offset_index(spark, path) if d.first + d.n > first]
        if not ahead:
            return first
        end = next((d.first + d.n for d in ahead if d.first + d.n - first >= most), ahead[-1].first + ahead[-1].n)
        handle(read_topic(spark, path, fields, first, end), first, end)
        created(spark, f"{path}/{INDEX}/{reader}/{end:020d}", "")


def stream_topic(spark: SparkSession, path: str, fields: str, files_per_trigger: int = 100) -> DataFrame:
    """A topic folder as a stream; progress is kept by the query's checkpoint."""
    return (
        spark.readStream.schema(envelope(fields))
        .options(maxFilesPerTrigger=files_per_trigger, recursiveFileLookup=True)
        .json(path)
        .select("key", "value.*")
    )


def stream_from(spark: SparkSession, path: str, fields: str, from_offset: int = 0) -> DataFrame:
    """A topic as a stream of offset, key and value columns. A new query starts at ``from_offset``, one with a checkpoint where it
    ended; files before that are not opened. Later deliveries are seen once :func:`offset_index` has been called on them."""
    offset_index(spark, path)
    spark.dataSource.register(TopicSource)
    place, system = jvm_path(spark, f"{path}/{INDEX}")
    folder = system.makeQualified(place).toUri().toString()
    return _messages_of(spark.readStream.format("topic").options(index=folder, from_offset=from_offset).load(), fields)


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, fields: str, starting: str = "earliest", per_trigger: int = 5_000_000
) -> DataFrame:
    """A Kafka topic as a stream; needs the connector package on the cluster."""
    raw = (
        spark.readStream.format("kafka")
        .options(
            **{
                "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
                "maxOffsetsPerTrigger": str(per_trigger),
            }
        )
        .load()
    )
    value = F.from_json(F.col("value").cast("string"), fields).alias("v")
    return raw.select("offset", F.col("key").cast("string").alias("key"), value).select("offset", "key", "v.*")


def to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str, key: str = "customer_id"):
    """A streaming frame to a Kafka topic, keyed by customer."""
    rows = df.select(F.col(key).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
    return rows.writeStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    )
