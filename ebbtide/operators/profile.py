"""Descriptive profile and data-quality checks; nothing is changed or dropped."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.numeric import count_of, number_or_null, rounded_total
from ebbtide.vocab import (
    CATEGORICAL, COLUMN_MEANINGS, DOMAINS, GATE_COLUMNS, GATE_MIN_ROWS, ID, RAW_COLUMNS, SENIOR_DOMAIN, TARGET,
    TARGET_DOMAIN,
)


def _long(row: DataFrame, entries: list[Column]) -> DataFrame:
    """One wide aggregate row to one row per entry."""
    return row.select(F.inline(F.array(*entries)))


def shape(df: DataFrame) -> DataFrame:
    """One row per column with type, position and the row count."""
    rows = df.agg(F.count("*").alias("n_rows"))
    entries = [
        F.struct(
            F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"), F.lit(i).alias("position"),
            F.col("n_rows"),
        )
        for i, (name, kind) in enumerate(df.dtypes, 1)
    ]
    return _long(rows, entries)


def missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null count and percentage of the columns that have nulls; one pass."""
    names = columns or df.columns
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(names)]
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"_{i}").alias("n_missing"),
            rounded_total(F.try_divide(F.col(f"_{i}"), F.col("_rows")) * 100, 3).alias("pct_missing"),
        )
        for i, c in enumerate(names)
    ]
    return _long(counts, entries).filter("n_missing > 0")


def duplicates(df: DataFrame, key: str = ID) -> DataFrame:
    """Rows after the first occurrence, by whole row and by key.

    Copies are counted by a map-side combined aggregate, so a group of copies of any size stays
    cheap.
    """
    whole = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    per_key = whole.groupBy(key).agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("extra"))
    return per_key.agg(
        F.coalesce(F.sum("extra"), F.lit(0)).cast("long").alias("full_row"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("by_id"),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Counts and shares of each value, null included."""
    rows = df.agg(F.count("*").alias("n")).scalar()
    return (
        df.groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("n"))
        .withColumn("proportion", rounded_total(F.col("n") / rows, 4))
    )


def is_blank(column: str) -> Column:
    return F.trim(F.col(column).cast("string")) == ""


def blanks(df: DataFrame, column: str = "TotalCharges") -> DataFrame:
    return df.agg(count_of(is_blank(column)).alias("n_blank"))


def data_dictionary(df: DataFrame, order: str = ID) -> DataFrame:
    """Per column: position, type, non-null count, first non-null example in ``order``, meaning."""
    facts = df.agg(
        *[F.count(c).alias(f"_n{i}") for i, c in enumerate(df.columns)],
        *[
            F.min_by(F.col(c).cast("string"), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_e{i}")
            for i, c in enumerate(df.columns)
        ],
    )
    entries = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col(f"_n{i}").alias("non_null"),
            F.coalesce(F.col(f"_e{i}"), F.lit("")).alias("example"),
            F.lit(COLUMN_MEANINGS.get(c, "(no description available)")).alias("description"),
        )
        for i, (c, kind) in enumerate(df.dtypes)
    ]
    return _long(facts, entries)


# --- checks ---------------------------------------------------------------------------------------
def gate_flags(df: DataFrame) -> DataFrame:
    """Ingest gate as flags: required columns present, enough rows."""
    absent = [c for c in GATE_COLUMNS if c not in df.columns]
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(not absent).alias("has_required_columns"),
        (F.col("n_rows") >= GATE_MIN_ROWS).alias("has_enough_rows"),
    )


def unexpected_values(df: DataFrame) -> DataFrame:
    """Observed values outside a column's domain, with their row counts: one scan, one shuffle,
    and an anti join against the fixed domain table."""
    domains = {**DOMAINS, TARGET: TARGET_DOMAIN}
    present = [c for c in domains if c in df.columns]
    allowed = df.sparkSession.createDataFrame(
        [(c, v) for c in present for v in domains[c]], "field string, value string"
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in present])
    observed = df.select(F.inline(pairs)).groupBy("field", "value").agg(F.count("*").alias("n"))
    return observed.filter("value is not null").join(F.broadcast(allowed), ["field", "value"], "left_anti")


def _check(name: str, passed: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("check"), passed.alias("passed"), detail.alias("detail"))


def _counted(n: Column, noun: str) -> Column:
    return F.concat(n.cast("string"), F.lit(f" {noun}"))


COPY_CHECKS = ("no_duplicate_rows", "unique_customer_ids")


def quality_checks(df: DataFrame, *only: str) -> DataFrame:
    """The check table: check, passed, detail; of all checks or of those named, leaving out the
    passes over the data that none of them needs. Values behind a failed domain check are listed
    by :func:`unexpected_values`."""
    needed = {_copy_checks if c in COPY_CHECKS else _domain_checks if "values_valid" in c else _count_checks for c in only}
    parts = [part(df) for part in (_count_checks, _copy_checks, _domain_checks) if not only or part in needed]
    table = functools.reduce(DataFrame.unionByName, parts)
    return table.filter(F.col("check").isin(*only)) if only else table


def _count_checks(df: DataFrame) -> DataFrame:
    """Columns, nulls, blanks and ranges: one aggregate."""
    names = df.columns
    numeric = {c for c, kind in df.dtypes if kind in ("int", "bigint", "double", "float", "smallint") or kind.startswith("decimal")}
    absent = [c for c in RAW_COLUMNS if c not in names]
    nullable = [c for c in names if c != "TotalCharges"]
    ranged = [c for c in ("tenure", "MonthlyCharges") if c in numeric]
    senior = number_or_null("SeniorCitizen") if "SeniorCitizen" in names else F.lit(None).cast("double")
    blank = is_blank("TotalCharges") if "TotalCharges" in names else F.lit(False)
    if "TotalCharges" in numeric:
        blank = F.col("TotalCharges").isNull()
    facts = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in nullable],
        *[count_of(F.col(c) < 0).alias(f"_neg_{c}") for c in ranged],
        count_of(~senior.isin(*[float(v) for v in SENIOR_DOMAIN])).alias("_senior"),
        count_of(blank).alias("_blank"),
    )
    null_columns = F.filter(
        F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"_null_{c}").alias("n")) for c in nullable]), lambda e: e["n"] > 0
    )
    found = F.array_join(F.transform(null_columns, lambda e: F.concat(e["c"], F.lit("="), e["n"].cast("string"))), ", ")
    entries = [
        _check(
            "required_columns_present", F.lit(not absent),
            F.lit("all present" if not absent else f"missing: {', '.join(absent)}"),
        ),
        _check("no_unexpected_missing", F.size(null_columns) == 0, F.when(found == "", "none").otherwise(found)),
        _check(
            "totalcharges_blanks_documented", F.lit(True), _counted(F.col("_blank"), "blank TotalCharges"),
        ),
        *[_check(f"non_negative[{c}]", F.col(f"_neg_{c}") == 0, _counted(F.col(f"_neg_{c}"), "negatives")) for c in ranged],
    ]
    if "SeniorCitizen" in names:
        entries.append(
            _check("senior_citizen_binary", F.col("_senior") == 0, _counted(F.col("_senior"), "rows outside {0, 1}"))
        )
    return _long(facts, entries)


def _copy_checks(df: DataFrame) -> DataFrame:
    """Repeated rows and ids."""
    names = df.columns
    copies = duplicates(df) if ID in names else df.groupBy(*names).count().agg(F.sum(F.col("count") - 1).alias("full_row"))
    copy_checks = [_check("no_duplicate_rows", F.col("full_row") == 0, _counted(F.col("full_row"), "duplicate rows"))]
    if ID in names:
        copy_checks.append(_check("unique_customer_ids", F.col("by_id") == 0, _counted(F.col("by_id"), "duplicate ids")))
    return _long(copies, copy_checks)


def _domain_checks(df: DataFrame) -> DataFrame:
    """Values of the categories and the target."""
    expected = [(c, f"values_valid[{c}]") for c in CATEGORICAL if c in df.columns]
    if TARGET in df.columns:
        expected.append((TARGET, "target_values_valid"))
    listed = df.sparkSession.createDataFrame(expected, "field string, check string")
    bad = unexpected_values(df).groupBy("field").agg(F.count("*").alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    domain = listed.join(bad, "field", "left").select(
        "check", (n == 0).alias("passed"),
        F.when(n == 0, "ok").otherwise(_counted(n, "unexpected values")).alias("detail"),
    )
    return domain


def quality_report(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.bool_and("passed").alias("passed"),
        F.count("*").alias("n_checks"),
        F.count_if(~F.col("passed")).alias("n_failures"),
    )


def dataset_version(df: DataFrame, family: str = "ibm-telco") -> DataFrame:
    return df.agg(F.concat(F.lit(f"{family}-"), F.count("*").cast("string")).alias("dataset_version"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table; each count reads no columns."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out
