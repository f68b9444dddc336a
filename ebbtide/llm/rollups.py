"""Token counts as rollups that are maintained by signed changes (operator 6).

A change inserts, deletes or revises a document's count. Each batch of changes is summed to signed deltas by source, language
and tokenizer version and written as a folder of its own; totals are the sums of all committed batches. A batch is committed
when its folder has the writer's success mark: committing it again changes nothing, and what a failed commit left is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
DELTAS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def _folder(spark: SparkSession, root: str, name: str = ""):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}" if name else root)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_committed(spark: SparkSession, root: str, batch: str) -> bool:
    path, system = _folder(spark, root, f"batch={batch}/_SUCCESS")
    return system.exists(path)


def signed(changes: DataFrame) -> DataFrame:
    """Deltas of changes.

    ``changes`` has ``old`` and ``new``, each a struct of the keys and ``n_tokens``: an insert has no old side, a delete no new
    side, a revision both, be it of the count, the tokenizer version or the document's source. A side whose count is null adds
    a document without tokens; null keys are a group of their own; a row with neither side changes nothing. Repeated rows count
    as often as they come.
    """
    sides = F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("of")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("of")))
    rows = changes.select(F.explode(sides).alias("side")).filter("side.of is not null")
    grouped = rows.groupBy(*(F.col(f"side.of.{k}").alias(k) for k in KEYS)).agg(
        F.sum("side.sign").alias("n_docs"), F.sum(F.col("side.sign") * F.coalesce("side.of.n_tokens", F.lit(0))).alias("n_tokens")
    )
    return grouped.filter("n_docs <> 0 or n_tokens <> 0")


def commit(root: str, batch: str, changes: DataFrame) -> bool:
    """Add a batch under its name; False, and nothing done, if it is committed already."""
    spark = changes.sparkSession
    if is_committed(spark, root, batch):
        return False
    signed(changes).select(*KEYS, F.col("n_docs").cast("long"), F.col("n_tokens").cast("long")).write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch={batch}")
    return True


def committed(spark: SparkSession, root: str) -> list[str]:
    """Names of the committed batches."""
    path, system = _folder(spark, root)
    names = [x.getPath().getName() for x in system.listStatus(path)] if system.exists(path) else []
    return sorted(n[len("batch=") :] for n in names if n.startswith("batch=") and is_committed(spark, root, n[len("batch=") :]))


def totals(spark: SparkSession, root: str) -> DataFrame:
    """``n_docs`` and ``n_tokens`` by source, lang and tokenizer; groups that fell to nothing are gone. No batches: no rows."""
    names = committed(spark, root)
    if not names:
        return spark.createDataFrame([], DELTAS)
    deltas = spark.read.schema(DELTAS).parquet(*(f"{root.rstrip('/')}/batch={n}" for n in names))
    summed = deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return summed.filter("n_docs <> 0 or n_tokens <> 0")


def compact(spark: SparkSession, root: str, to: str) -> None:
    """Write the totals of ``root`` as the first batch of another folder, which then stands for the batches so far."""
    totals(spark, root).write.parquet(f"{to.rstrip('/')}/batch=0")


def counted(docs: DataFrame, tokenizer: str, count: Column, *, source_col: str = "source", lang_col: str = "lang") -> Column:
    """One side of a change: the document's keys and its count under a tokenizer version."""
    return F.struct(F.col(source_col).alias("source"), F.col(lang_col).alias("lang"), F.lit(tokenizer).alias("tokenizer"), count.cast("long").alias("n_tokens"))


def blank_words(text: Column) -> Column:
    """Tokenizer version ``blank-1``: runs without ``[\\x20\\x09-\\x0D]``; null: none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def split_words(text: Column) -> Column:
    """Tokenizer version ``split-2``: ASCII digits one by one, runs of other characters that are neither blank nor ASCII
    punctuation, and punctuation marks one by one; null: none."""
    marks = r"!-/:-@\[-`{-~"
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(rf"[0-9]|[{marks}]|[^0-9{marks}\x20\x09-\x0D]+"))
