"""A streaming source over a topic's offset index: a query starts at any offset and reads only the blocks that hold its range."""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

_CHUNK = 4 << 20
_ROWS = 10_000
LINES = pa.schema([("offset", pa.int64()), ("value", pa.string())])


def lines_from(file: pa.NativeFile, start: int, end: int | None) -> Iterator[bytes]:
    """Lines that begin after ``start`` (from it on if it is 0) and not after ``end``, the ranges Spark's text reader deals out."""
    file.seek(start)
    at, rest, skip = start, b"", start > 0
    while True:
        chunk = file.read(_CHUNK)
        *whole, rest = (rest + chunk).split(b"\n")
        for line in whole if chunk else [*whole, *([rest] if rest else [])]:
            if not skip:
                if end is not None and at > end:
                    return
                yield line
            skip, at = False, at + len(line) + 1
        if not chunk or (end is not None and at > end):
            return


@dataclass
class Block(InputPartition):
    """A byte range of a file, the offset of its first line, and the offsets asked for."""

    file: str
    start: int
    end: int | None
    first: int
    low: int
    high: int


class TopicReader(DataSourceStreamReader):
    """Offsets of the stream are offsets of the topic. Deliveries count once they are in the index; its entries never change, so
    each is read once. A micro-batch takes all that is indexed: its tasks are blocks of files, whose lines are streamed."""

    def __init__(self, index: str, from_offset: int):
        self.index, self.from_offset, self.entries = index, from_offset, {}

    def initialOffset(self) -> dict:
        return {"offset": self.from_offset}

    def _blocks(self) -> list[tuple[int, int, str, int, int | None]]:
        """First offset, lines, file, first and last byte of every block, in order of offsets."""
        system, folder = pyarrow.fs.FileSystem.from_uri(self.index)
        for entry in system.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True)):
            if entry.base_name.isdigit() and entry.base_name not in self.entries:
                with system.open_input_stream(entry.path) as file:
                    self.entries[entry.base_name] = [json.loads(x) for x in file.read().splitlines()]
        found = []
        for name in sorted(self.entries):
            for d in self.entries[name]:
                first, ends = d["first"], [start for start, _ in d["blocks"][1:]] + [None]
                for (start, n), end in zip(d["blocks"], ends):
                    found.append((first, n, d["file"], start, end))
                    first += n
        return found

    def latestOffset(self) -> dict:
        blocks = self._blocks()
        return {"offset": max(self.from_offset, blocks[-1][0] + blocks[-1][1] if blocks else 0)}

    def partitions(self, start: dict, end: dict) -> list[Block]:
        low, high, blocks = start["offset"], end["offset"], self._blocks()
        begin = max(0, bisect_right([b[0] for b in blocks], low) - 1)
        return [Block(f, a, z, first, low, high) for first, n, f, a, z in blocks[begin:] if first < high and first + n > low]

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        system, path = pyarrow.fs.FileSystem.from_uri(partition.file)
        offsets, values = [], []

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array(offsets, pa.int64()), pa.array(values, pa.string())], schema=LINES)

        with system.open_input_file(path) as file:
            for offset, line in enumerate(lines_from(file, partition.start, partition.end), partition.first):
                if offset >= partition.high:
                    break
                if offset < partition.low:
                    continue
                offsets.append(offset)
                values.append(line.decode("utf-8", "replace"))
                if len(offsets) == _ROWS:
                    yield batch()
                    offsets, values = [], []
        yield batch()


class TopicSource(DataSource):
    """Format ``topic``. Options: ``index``, the folder of the offset index, and ``from_offset``, where a new query starts."""

    @classmethod
    def name(cls) -> str:
        return "topic"

    def schema(self) -> str:
        return "offset long, value string"

    def streamReader(self, schema) -> TopicReader:
        return TopicReader(self.options["index"], int(self.options.get("from_offset", 0)))
