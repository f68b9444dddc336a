"""Line deduplication by winnowing over line hashes, in DataFrame operations only (operator 9).

Every window of ``span`` lines selects the smallest line hash in it, so any run of ``span`` lines that occurs twice selects
the same line in both places: a guaranteed fingerprint. Fingerprints that occur at one place only are dropped. At the others
the match is extended both ways: all windows that selected the fingerprint are compared by content with the earliest window
of the same content, and runs are the unions of windows that match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.session import written

#: Fixed value: blanks in the sense of this operator.
BLANKS = " \t\n\x0b\x0c\r"


def _lines(text: Column, long_line: int) -> Column:
    """Lines with a word: place in the text, two hashes, how many words, and whether the line is a passage alone."""

    def described(line: Column, place: Column) -> Column:
        words = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))
        return F.struct(
            place.alias("place"), F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"),
            words.alias("words"), (words >= long_line).alias("long"), (F.btrim(line, F.lit(BLANKS)) != "").alias("worded"),
        )

    return F.filter(F.transform(F.split(text, "\n"), described), lambda x: x["worded"])


def windows(docs: DataFrame, span: int, long_line: int, passages: bool) -> DataFrame:
    """A row per window: document, first line, number of lines and their places, the selected line's hash and place, the
    content's hashes."""
    lines = F.col("lines")

    def window(start: Column, n: int) -> Column:
        part = F.slice(lines, start + 1, n)
        chosen = F.array_min(F.transform(part, lambda x: F.struct(x["a"].alias("mark"), (-x["place"]).alias("at"))))
        return F.struct(
            start.alias("start"), F.lit(n).alias("n"), F.transform(part, lambda x: x["place"]).alias("places"), chosen["mark"].alias("mark"), (-chosen["at"]).alias("at"),
            F.xxhash64(F.transform(part, lambda x: x["a"])).alias("a"), F.xxhash64(F.transform(part, lambda x: x["b"])).alias("b"),
        )

    def alone(line: Column, start: Column) -> Column:
        return F.when(
            line["long"],
            F.struct(start.alias("start"), F.lit(1).alias("n"), F.array(line["place"]).alias("places"), line["a"].alias("mark"), line["place"].alias("at"), line["a"].alias("a"), line["b"].alias("b")),
        )

    def runs_of(n: int) -> Column:
        starts = F.sequence(F.lit(0), F.size(lines) - n)
        if n < span:
            whole = lambda k: F.aggregate(F.slice(lines, k + 1, n), F.lit(0), lambda sum_, x: sum_ + x["words"]) >= long_line
            starts = F.filter(starts, whole)
        return F.when(F.size(lines) >= n, F.transform(starts, lambda k: window(k, n))).otherwise(F.array())

    runs = F.concat(*(runs_of(n) for n in range(2 if passages else span, span + 1)))
    singles = F.filter(F.transform(lines, alone), lambda x: x.isNotNull())
    both = docs.select("doc_id", "key", _lines(F.col("text"), long_line).alias("lines"))
    found = both.select("doc_id", "key", F.explode(F.concat(runs, singles)).alias("w"))
    return found.select("doc_id", "key", "w.*")


def repeated_windows(docs: DataFrame, span: int, long_line: int, passages: bool) -> DataFrame:
    """Windows of which an equal one comes earlier (by id, text hash, line), with their document."""
    found = written(windows(docs, span, long_line, passages), "line-windows")
    places = found.select("doc_id", "key", "mark", "at").distinct()
    marks = places.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark")
    marks = written(marks, "line-marks").hint("merge")  # as many as the corpus has repeated lines: one plan at every size
    candidates = written(found.join(marks, "mark", "left_semi"), "line-matches")
    here = F.struct("doc_id", "key", "start")
    first = candidates.groupBy("n", "a", "b").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    matched = candidates.join(written(first.select("n", "a", "b", "first"), "line-firsts"), ["n", "a", "b"])
    return matched.filter(~here.eqNullSafe(F.col("first"))).select("doc_id", "key", "places")


def without_repeated_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", span: int = 3, long_line: int = 50, passages: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_lines`` (with a word), ``n_removed`` and the remaining ``kept_text``.

    Lines are the parts between ``\\n``; lines without a word never count and stay. A line goes if it belongs to ``span``
    consecutive lines that occur earlier, in another document or before in its own, or if it has ``long_line`` words or more
    and occurs earlier; with ``passages`` also if it belongs to two lines or more, fewer than ``span``, that have ``long_line`` words
    together and occur earlier. Documents come in the order of id (null first), then of a hash of the text; rows that agree in both are one
    document and are treated alike. Null texts count as empty: no lines, an empty kept text. An empty table gives an empty
    result; other columns are not read. A very long text is one row, whose windows are rows of their own. A line that any share of
    the documents has is counted before it is shuffled; the fingerprints that repeat, and the earliest windows, are written before
    they are joined, one row each, so that Spark splits or broadcasts by their size.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("text"))
    gone = repeated_windows(texts, span, long_line, passages).groupBy("doc_id", "key").agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("gone"))
    gone = gone.withColumnsRenamed({"doc_id": "of_id", "key": "of_key"})
    cut = F.split("text", "\n")
    lines = texts.select("doc_id", "key", cut.alias("lines"), F.size(F.filter(cut, lambda x: F.btrim(x, F.lit(BLANKS)) != "")).alias("n_lines"))
    joined = lines.join(gone, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key")), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.array_join(F.transform(left, lambda k: F.get(F.col("lines"), k)), "\n")
    return joined.select("doc_id", F.col("n_lines").cast("long"), F.size(F.coalesce("gone", F.array().cast("array<int>"))).cast("long").alias("n_removed"), kept.alias("kept_text"))
