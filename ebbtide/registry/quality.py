"""Profile and data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.operators import profile as q
from ebbtide.registry.base import money, query
from ebbtide.vocab import CATEGORICAL, COLUMN_MEANINGS, DOMAINS, ENGINEERED, RAW_COLUMNS

_TYPES = {c: "string" for c in RAW_COLUMNS} | {"SeniorCitizen": "int", "tenure": "int", "MonthlyCharges": "double"}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def delivered(x):
    """The dirty landing feed without its arrival counter: 21 raw columns, repeated ids."""
    return x.landing.drop("arrival")


@query(
    "b01_shape",
    "SELECT column_name, data_type, CAST(position AS INTEGER) AS position, (SELECT COUNT(*) FROM raw) AS n_rows FROM (VALUES "
    + ", ".join(f"('{c}', '{_TYPES[c]}', {i})" for i, c in enumerate(RAW_COLUMNS, 1))
    + ") t(column_name, data_type, position)",
)
def _(x):
    return q.shape(x.raw)


_MISSING = f"""SELECT 'TotalCharges' AS column_name, COUNT(*) FILTER (TotalCharges IS NULL) AS n_missing,
      {money('COUNT(*) FILTER (TotalCharges IS NULL)::DOUBLE / COUNT(*) * 100', 3)} AS pct_missing FROM landing"""


@query("b02_missing_per_column", _MISSING)
def _(x):
    return q.missing(delivered(x))


@query(
    "b03_duplicates",
    """, twice AS (SELECT * EXCLUDE (arrival) FROM landing UNION ALL SELECT * EXCLUDE (arrival) FROM landing WHERE arrival = 2)
       SELECT (SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM twice)) FROM twice) AS full_row,
              (SELECT COUNT(*) - COUNT(DISTINCT customerID) FROM twice) AS by_id""",
)
def _(x):
    again = x.landing.filter("arrival = 2").drop("arrival")
    return q.duplicates(delivered(x).unionByName(again))


@query(
    "b04_target_distribution",
    f"""SELECT Churn AS value, COUNT(*) AS n, {money('COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER ()', 4)} AS proportion FROM landing GROUP BY Churn""",
)
def _(x):
    return q.distribution(delivered(x), "Churn")


@query("b05_blank_totals", "SELECT COUNT(*) FILTER (TRIM(TotalCharges) = '') AS n_blank FROM landing")
def _(x):
    return q.blanks(delivered(x))


@query(
    "b06_data_dictionary",
    " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS column_name, '{_TYPES[c]}' AS data_type, COUNT({c}) AS non_null,
          COALESCE(ARG_MIN(CAST({c} AS VARCHAR), customerID) FILTER ({c} IS NOT NULL), '') AS example,
          {quoted(COLUMN_MEANINGS[c])} AS description FROM raw"""
        for i, c in enumerate(RAW_COLUMNS, 1)
    ),
)
def _(x):
    return q.data_dictionary(x.raw)


# --- checks over the dirty feed -----------------------------------------------------------------------
def checks_named(x, *names):
    return q.quality_checks(delivered(x), *names)


@query(
    "b07_required_columns",
    "SELECT 'required_columns_present' AS \"check\", COUNT(*) >= 0 AS passed, 'all present' AS detail FROM landing",
)
def _(x):
    return checks_named(x, "required_columns_present")


@query(
    "b08_duplicate_checks",
    """, d AS (SELECT COUNT(*) AS n, COUNT(DISTINCT customerID) AS ids,
                (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM (SELECT * EXCLUDE (arrival) FROM landing))) AS whole FROM landing)
      SELECT 'no_duplicate_rows' AS "check", n = whole AS passed, (n - whole) || ' duplicate rows' AS detail FROM d
      UNION ALL SELECT 'unique_customer_ids', n = ids, (n - ids) || ' duplicate ids' FROM d""",
)
def _(x):
    return checks_named(x, "no_duplicate_rows", "unique_customer_ids")


@query(
    "b09_unexpected_missing",
    """SELECT 'no_unexpected_missing' AS "check", COUNT(*) = 0 AS passed,
         CASE WHEN COUNT(*) = 0 THEN 'none' ELSE 'gender=' || COUNT(*) END AS detail FROM landing WHERE gender IS NULL""",
)
def _(x):
    return checks_named(x, "no_unexpected_missing")


_TARGET_CHECK = """SELECT 'target_values_valid' AS "check", COUNT(*) = 0 AS passed,
    CASE WHEN COUNT(*) = 0 THEN 'ok' ELSE COUNT(*) || ' unexpected values' END AS detail
    FROM (SELECT DISTINCT Churn FROM landing WHERE Churn NOT IN ('Yes', 'No'))"""


@query("b10_target_domain", _TARGET_CHECK)
def _(x):
    return checks_named(x, "target_values_valid")


def _domain_sql(c: str) -> str:
    allowed = ", ".join(quoted(v) for v in DOMAINS[c])
    return f"""SELECT 'values_valid[{c}]' AS "check", COUNT(*) = 0 AS passed,
      CASE WHEN COUNT(*) = 0 THEN 'ok' ELSE COUNT(*) || ' unexpected values' END AS detail
      FROM (SELECT DISTINCT {c} FROM landing WHERE {c} NOT IN ({allowed}))"""


@query("b11_categorical_domains", " UNION ALL ".join(_domain_sql(c) for c in CATEGORICAL))
def _(x):
    return checks_named(x, *[f"values_valid[{c}]" for c in CATEGORICAL])


@query(
    "g13_unexpected_values",
    " UNION ALL ".join(
        f"SELECT '{c}' AS field, {c} AS value, COUNT(*) AS n FROM landing WHERE {c} NOT IN ({', '.join(quoted(v) for v in allowed)}) GROUP BY 2"
        for c, allowed in [*DOMAINS.items(), ("Churn", ["No", "Yes"])]
    ),
)
def _(x):
    return q.unexpected_values(delivered(x))


@query(
    "b12_senior_domain",
    """SELECT 'senior_citizen_binary' AS "check", COUNT(*) = 0 AS passed, COUNT(*) || ' rows outside {0, 1}' AS detail
       FROM landing WHERE SeniorCitizen NOT IN (0, 1)""",
)
def _(x):
    return checks_named(x, "senior_citizen_binary")


@query(
    "b13_blanks_documented",
    """SELECT 'totalcharges_blanks_documented' AS "check", TRUE AS passed, COUNT(*) || ' blank TotalCharges' AS detail
       FROM landing WHERE TRIM(TotalCharges) = ''""",
)
def _(x):
    return checks_named(x, "totalcharges_blanks_documented")


@query(
    "b14_non_negative",
    """SELECT 'non_negative[MonthlyCharges]' AS "check", COUNT(*) = 0 AS passed, COUNT(*) || ' negatives' AS detail
       FROM landing WHERE MonthlyCharges < 0""",
)
def _(x):
    """tenure is text in the dirty feed, so only the charge is checked there."""
    return checks_named(x, "non_negative[MonthlyCharges]", "non_negative[tenure]")


@query(
    "b15_quality_report",
    "SELECT COUNT(*) = COUNT(customerID) AS passed, CAST(24 AS BIGINT) AS n_checks, CAST(0 AS BIGINT) AS n_failures FROM raw",
)
def _(x):
    return q.quality_report(q.quality_checks(x.raw))


@query(
    "b15_quality_report_dirty",
    ", c AS (" + _TARGET_CHECK + " UNION ALL " + _domain_sql("Contract")
    + """ UNION ALL SELECT 'ids', COUNT(*) = COUNT(DISTINCT customerID), '' FROM landing
       UNION ALL SELECT 'neg', COUNT(*) FILTER (MonthlyCharges < 0) = 0, '' FROM landing)
      SELECT BOOL_AND(passed) AS passed, CAST(23 AS BIGINT) AS n_checks, COUNT(*) FILTER (NOT passed) AS n_failures FROM c""",
)
def _(x):
    return q.quality_report(q.quality_checks(delivered(x)))


@query("b17_missing_summary", "SELECT column_name, n_missing FROM (" + _MISSING + ")")
def _(x):
    return q.missing(delivered(x)).drop("pct_missing")


@query("b18_dataset_version", "SELECT 'ibm-telco-' || COUNT(*) AS dataset_version FROM raw")
def _(x):
    return q.dataset_version(x.raw)


@query(
    "b19_row_counts",
    """SELECT 'customers' AS table_name, COUNT(*) AS n FROM raw UNION ALL SELECT 'subscriptions', COUNT(*) FROM raw
       UNION ALL SELECT 'predictions', COUNT(*) FROM valued UNION ALL SELECT 'recommendations', COUNT(*) FROM decided
       UNION ALL SELECT 'customer_events', COUNT(*) FROM ev""",
)
def _(x):
    return q.row_counts(
        {
            "customers": x.raw, "subscriptions": x.raw, "predictions": x.valued, "recommendations": x.decided,
            "customer_events": x.events,
        }
    )


@query(
    "a02_ingest_gate",
    "SELECT COUNT(*) AS n_rows, TRUE AS has_required_columns, COUNT(*) >= 1000 AS has_enough_rows FROM raw",
)
def _(x):
    return q.gate_flags(x.raw)


@query(
    "d11_feature_dictionary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, '{g}' AS "group", {money(f'CAST(SUM(CAST({c} AS DECIMAL(18,6))) AS DOUBLE) / COUNT({c})', 4)} AS mean_value,
           CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value FROM featured"""
        for c, g in ENGINEERED.items()
    ),
)
def _(x):
    """The engineered features with their group and what the table holds of them."""
    from ebbtide.functions.numeric import exact_avg, rounded_total
    from ebbtide.operators.explore import numeric_long
    from ebbtide.operators.features import FeatureEngineer

    groups = F.create_map(*[F.lit(t) for kv in ENGINEERED.items() for t in kv])
    return (
        numeric_long(FeatureEngineer().transform(x.clean), list(ENGINEERED), [])
        .groupBy(F.col("field").alias("feature"))
        .agg(
            rounded_total(exact_avg("v"), 4).alias("mean_value"), F.min("v").alias("min_value"), F.max("v").alias("max_value")
        )
        .withColumn("group", F.element_at(groups, F.col("feature")))
    )
