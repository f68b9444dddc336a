"""Files that are one JSON array of objects each, read by many tasks and written by many.

A file is read in pieces that end at ``}``, which Spark's text source splits by byte ranges. Whether a range begins within
a string, and how deep, follows from the ranges before it: every range reports what it does in either case, and running
totals over one short row per range say which case holds. Records within a range are complete at once; a record that runs
over ranges is put together from its parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.session import ship_package, written

_ESCAPED = re.compile(r"\\.", re.DOTALL)
_NEVER = 1 << 40  # lowest depth of a range without an end outside strings
_RANGE = "file string, block long, flips boolean, moved_out long, moved_in long, low_out long, low_in long"
_PART = "file string, origin long, block long, ended boolean, record string"


def _depths(piece: str) -> tuple[int, int, bool]:
    """Change of depth if the piece begins outside a string, if it begins inside one, and whether it ends in the other state."""
    parts = _ESCAPED.sub("", piece).split('"')
    moved = [0, 0]
    for k, part in enumerate(parts):
        moved[k % 2] += part.count("{") + part.count("[") - part.count("]")
    return moved[0], moved[1], len(parts) % 2 == 0


def _ranges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per range. A task's ranges come one after the other, each in the order of its file."""
    at, found = None, None
    for frame in frames:
        for file, block, piece in zip(frame["file"], frame["block"], frame["value"]):
            if at != (file, block):
                if at:
                    yield pd.DataFrame([(*at, *found)], columns=["file", "block", "flips", "moved_out", "moved_in", "low_out", "low_in"])
                at, found = (file, block), [False, 0, 0, _NEVER, _NEVER]
            outside, inside, flips = _depths(piece)
            for case in (0, 1):
                begun_inside = found[0] != bool(case)
                found[1 + case] += inside if begun_inside else outside
                if begun_inside == flips:  # the closing brace stands outside strings
                    found[1 + case] -= 1
                    found[3 + case] = min(found[3 + case], found[1 + case])
            found[0] = found[0] != flips
    if at:
        yield pd.DataFrame([(*at, *found)], columns=["file", "block", "flips", "moved_out", "moved_in", "low_out", "low_in"])


def _records(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records of each range, and its parts of records that run over ranges (with the range they begin in)."""
    at, held = None, []
    for frame in frames:
        out = []
        for file, block, piece, inside, depth, opened in zip(*(frame[c] for c in ("file", "block", "value", "inside", "depth", "opened"))):
            if at != (file, block):
                if held:
                    out.append((at[0], origin, at[1], False, "".join(held)))
                at, held, within, level = (file, block), [], inside, depth
                running = within or level > 1
                origin = int(opened) if running else block
                whole = not running
            moved = _depths(piece)
            level += moved[1] if within else moved[0]
            within = within != moved[2]
            if not running:
                begin = piece.find("{")
                running = begin >= 0
                piece = piece[max(begin, 0):]
            if running:
                held += [piece, "}"]
            if not within:
                level -= 1
                if level <= 1 and running:
                    out.append((file, None if whole else origin, block, True, "".join(held)))
                    held, running, whole, origin = [], False, True, block
        yield pd.DataFrame(out, columns=["file", "origin", "block", "ended", "record"])
    if held:
        yield pd.DataFrame([(at[0], origin, at[1], False, "".join(held))], columns=["file", "origin", "block", "ended", "record"])


def read_array_files(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The objects of files that hold one JSON array each, of any size, as rows.

    Nested objects and arrays, and strings that hold braces, brackets, quotes and backslashes are read as they are. An
    object that does not fit the schema is a row of nulls; elements that are no objects, and an object that its file ends
    within, give no row. Compressed files are one range each.
    """
    ship_package(spark)
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = written(pieces.mapInPandas(_ranges, _RANGE), "ranges")
    ranges = ranges.withColumn("inside", F.coalesce(F.sum(F.col("flips").cast("int")).over(before), F.lit(0)) % 2 == 1)
    ranges = ranges.withColumn("moved", F.when(F.col("inside"), F.col("moved_in")).otherwise(F.col("moved_out")))
    ranges = ranges.withColumn("depth", F.coalesce(F.sum("moved").over(before), F.lit(0)))
    low = F.col("depth") + F.when(F.col("inside"), F.col("low_in")).otherwise(F.col("low_out"))
    begins = (~F.col("inside") & (F.col("depth") <= 1)) | (low <= 1)
    ranges = ranges.withColumn("opened", F.coalesce(F.last(F.when(begins, F.col("block")), True).over(before), F.col("block")))
    # One row of a few numbers per byte range of the input.
    known = F.broadcast(ranges.select("file", "block", "inside", "depth", "opened"))
    parts = written(pieces.join(known, ["file", "block"]).mapInPandas(_records, _PART), "records")
    stitched = parts.filter("origin IS NOT NULL").groupBy("file", "origin").agg(
        F.array_sort(F.collect_list(F.struct("block", "ended", "record"))).alias("p")
    ).filter(F.element_at("p", -1)["ended"]).select(F.array_join("p.record", "").alias("record"))
    records = parts.filter("origin IS NULL AND ended").select("record").unionByName(stitched)
    return records.select(F.from_json("record", schema).alias("r")).select("r.*")


def write_array_files(df: DataFrame, path: str) -> None:
    """Rows as JSON arrays: every task writes one file that is one array."""

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mark = "["
        for frame in frames:
            if len(frame):
                marks = pd.Series(",", frame.index)
                marks.iloc[0] = mark
                mark = ","
                yield pd.DataFrame({"value": marks + frame["value"]})
        yield pd.DataFrame({"value": ["]" if mark == "," else "[]"]})

    df.select(F.to_json(F.struct("*")).alias("value")).mapInPandas(lines, "value string").write.text(path)
