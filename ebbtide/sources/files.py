"""File formats of the landing zone: CSV, JSON, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.session import written
from ebbtide.vocab import GATE_COLUMNS, GATE_MIN_ROWS, RAW_COLUMNS

_NOT_TEXT = {"SeniorCitizen": T.IntegerType(), "tenure": T.IntegerType(), "MonthlyCharges": T.DoubleType()}
RAW_SCHEMA = T.StructType([T.StructField(c, _NOT_TEXT.get(c, T.StringType())) for c in RAW_COLUMNS])
CORRUPT = "_corrupt_record"

# Cell texts that mean null in a landing file.
NULL_TOKENS = ["NULL", "null", "", " "]


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The 21 raw columns with declared types; the header is checked by name."""
    return spark.read.schema(RAW_SCHEMA).options(header=True, enforceSchema=False).csv(path)


def load_raw(spark: SparkSession, path: str) -> DataFrame:
    """:func:`read_raw_csv` behind the ingest gate: required columns and a minimum of rows."""
    header = spark.read.option("header", True).csv(path).columns
    absent = [c for c in GATE_COLUMNS if c not in header]
    if absent:
        raise ValueError(f"dataset missing required columns: {sorted(absent)}")
    raw = read_raw_csv(spark, path)
    rows = raw.count()
    if rows < GATE_MIN_ROWS:
        raise ValueError(f"dataset has too few rows: {rows}")
    return raw


def read_landing_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Tolerant CSV: quoted, trimmed, null tokens, short or long lines accepted, bad numbers null."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = spark.read.schema(text).options(
        header=True, quote='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, mode="PERMISSIVE"
    ).csv(path)
    tokens = [t.strip() for t in NULL_TOKENS]
    cells = {c: F.when(F.trim(c).isin(tokens), F.lit(None)).otherwise(F.trim(c)) for c in text.names}
    return rows.select(
        [
            (cells[f.name] if isinstance(f.dataType, T.StringType) else cells[f.name].try_cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def copy_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """Bulk load that goes on after bad lines: (good rows, quarantined lines).

    The parsed rows are written once: a pruned CSV scan would not notice bad cells of unread
    columns, and both sides would parse the file again.
    """
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = written(
        spark.read.schema(kept)
        .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        .csv(path),
        "parsed",
    )
    bad = F.col(CORRUPT).isNotNull()
    return rows.filter(~bad).drop(CORRUPT), rows.filter(bad).select(*schema.names[:1], CORRUPT)


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType | str, whole_file: bool = True
) -> DataFrame:
    """JSON arrays as rows: one array per file (one task per file, so for modest files), or with
    ``whole_file=False`` one array per line, which splits."""
    return spark.read.schema(schema).option("multiLine", whole_file).json(path)


def write_report(df: DataFrame, path: str, kind: str) -> None:
    """Small result tables as a single CSV or JSON file; only for aggregates."""
    out = df.coalesce(1).write.mode("overwrite")
    out.option("header", True).csv(path) if kind == "csv" else out.json(path)
