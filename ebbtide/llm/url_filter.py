"""URL filter lists by hash-prefix joins (operator 4).

A URL is expanded into expressions: a suffix of its host's labels and a prefix of its path, in the shapes (labels, path
length) that the rules have. Expressions and rules meet on a short prefix of their digests; full digests confirm a match, and
the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", prefix: int = 8, default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule`` (or null) and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``block`` or ``allow``). A rule fits its host and all subdomains, if the
    URL's path starts with the rule's; of fitting rules the longest wins, of equally long ones a block, then the smaller text.
    Rules that are repeated count once; rules with a null host, path or verdict never fit, nor do any rules fit an empty host. A
    URL without a rule gets ``default``. Null URLs and URLs without ``://`` have an empty host and path. An empty table gives an
    empty result; other columns are not read. Verdicts are found once for each distinct host and path, so that a host or
    URL may have any share of the pages. Which shapes there are is read from the rules: two small numbers for each shape.
    """
    own = rules.select("host", "path", "verdict").dropna().filter("host <> ''").distinct()
    shapes = [(r["labels"], r["length"]) for r in own.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length")).distinct().collect()]
    listed = own.select(
        F.concat("host", "path").alias("rule"), F.col("verdict").alias("ruled"), _digest(F.col("host"), F.col("path")).alias("rule_digest")
    ).withColumn("short", F.substring("rule_digest", 1, prefix))
    urls = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    labels = F.split("host", r"\.")
    kinds = F.array(*(F.struct(F.lit(a).alias("labels"), F.lit(b).alias("length")) for a, b in shapes)) if shapes else F.array().cast("array<struct<labels:int,length:int>>")
    fitting = F.filter(kinds, lambda k: (k["labels"] <= F.size(labels)) & (k["length"] <= F.length("path")))
    expression = F.struct(
        F.array_join(F.slice(labels, F.size(labels) - F.col("kind.labels") + 1, F.col("kind.labels")), ".").alias("suffix"),
        F.substring(F.col("path"), F.lit(1), F.col("kind.length")).alias("start"),
    )
    distinct = urls.select("host", "path").filter("host <> ''").distinct()
    expanded = distinct.withColumn("kind", F.explode(fitting)).select("host", "path", expression.alias("e"))
    hashed = expanded.withColumn("digest", _digest(F.col("e.suffix"), F.col("e.start"))).withColumn("short", F.substring("digest", 1, prefix))
    matched = hashed.join(listed, "short").filter(F.col("digest") == F.col("rule_digest"))
    best = F.max(F.struct(F.length("rule").alias("size"), (F.col("ruled") == "block").alias("blocks"), "ruled", "rule")).alias("best")
    decided = matched.groupBy("host", "path").agg(best)
    return urls.join(decided, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.ruled", F.lit(default)).alias("verdict")
    )
