import pytest
from pyspark.sql import functions as F

from ebbtide.operators import clean as c
from ebbtide.operators import profile as q
from ebbtide.operators.features import FeatureEngineer, engineer_features, to_gold
from ebbtide.plans import medallion
from ebbtide.vocab import ENGINEERED, RAW_COLUMNS


def dirty(spark, inputs, rows):
    """Copies of one customer with changed cells; arrival is the list position."""
    one = inputs.raw.filter("customerID = 'C00000001'").first().asDict()
    full = [{**{k: str(v) for k, v in one.items()}, **r, "arrival": i} for i, r in enumerate(rows)]
    schema = ", ".join(f"{x} string" for x in RAW_COLUMNS) + ", arrival long"
    return spark.createDataFrame([[r[k] for k in [*RAW_COLUMNS, "arrival"]] for r in full], schema)


def test_silver_cleans_every_kind_of_dirt(spark, inputs):
    df = dirty(spark, inputs, [
        {"customerID": "a", "tenure": "5"}, {"customerID": "a", "tenure": "7", "Contract": "  One year "},
        {"customerID": "b", "MonthlyCharges": "-1"}, {"customerID": "c", "TotalCharges": None, "tenure": "3", "MonthlyCharges": "10"},
        {"customerID": "d", "TotalCharges": " ", "tenure": "0"}, {"customerID": "e", "tenure": "101", "Churn": " YES"},
        {"customerID": "f", "SeniorCitizen": "x", "MonthlyCharges": "abc", "TotalCharges": "n/a", "tenure": "zz"},
    ])
    out = {r["customerID"]: r for r in c.to_silver_customers(df, "arrival").collect()}
    assert set(out) == set("acdef")
    assert out["a"]["tenure"] == 7 and out["a"]["Contract"] == "One year"
    assert out["c"]["TotalCharges"] == 30.0 and out["d"]["TotalCharges"] == 0.0 and out["e"]["Churn_Numeric"] == 1
    assert (out["f"]["SeniorCitizen"], out["f"]["MonthlyCharges"], out["f"]["TotalCharges"], out["f"]["tenure"]) == (0, 0.0, 0.0, 0)
    report = c.silver_quality(df, "arrival").first()
    assert (report["raw_records"], report["deduplicated_records"], report["invalid_records_dropped"], report["clean_records"]) == (7, 6, 1, 5)
    gold = {r["customerID"]: r for r in to_gold(c.to_silver_customers(df, "arrival"), None).collect()}
    assert gold["e"]["tenure_cohort"] == "nan" and gold["d"]["tenure_cohort"] == "0-12m (New)" and gold["a"]["recent_events_count"] == 0


def test_clean_raw_keeps_other_nulls(spark, inputs):
    df = dirty(spark, inputs, [{"customerID": "a", "TotalCharges": " ", "tenure": "0"}, {"customerID": "b", "TotalCharges": " ", "tenure": "4"}])
    df = df.withColumn("tenure", F.col("tenure").cast("int"))
    out = {r["customerID"]: r["TotalCharges"] for r in c.clean_raw(df).collect()}
    assert out == {"a": 0.0, "b": None}


def test_record_hash_separates_cells(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "x"), ("\\N", "y")], "p string, q string")
    assert len({r[0] for r in df.select(c.record_hash(["p", "q"])).collect()}) == 4


def test_events_are_typed_even_when_empty(spark):
    schema = "customer_id string, event_type string, timestamp string, value string, is_simulated boolean"
    empty = c.to_silver_events(c.to_bronze_events(spark.createDataFrame([], schema)))
    assert empty.count() == 0 and dict(empty.dtypes)["value"] == "double"
    rows = [("a", " LOGIN ", "2024-01-02T03:04:05+00:00", None, True), ("a", "login", "not a time", "2.5", True)]
    out = c.to_silver_events(c.to_bronze_events(spark.createDataFrame(rows, schema))).orderBy("value").collect()
    assert [(r["event_type"], r["timestamp"], r["value"]) for r in out] == [("login", "2024-01-02 03:04:05", 1.0), ("login", None, 2.5)]


def test_feature_invariants(inputs):
    df = engineer_features(inputs.clean)
    assert df.count() == inputs.clean.count()
    flags = [f for f in ENGINEERED if f.startswith(("has_", "is_")) or f.endswith("_indicator")]
    bad = df.filter(" or ".join(f"{f} not in (0, 1)" for f in flags) + " or total_services not between 0 and 9 or service_adoption_score not between 0 and 1")
    assert bad.count() == 0
    assert FeatureEngineer().transform(inputs.clean).columns == df.columns


def test_feature_engineer_round_trip(tmp_path):
    FeatureEngineer().write().overwrite().save(str(tmp_path / "fe"))
    assert isinstance(FeatureEngineer.load(str(tmp_path / "fe")), FeatureEngineer)


def test_quality_report_on_clean_data(inputs):
    row = q.quality_report(q.quality_checks(inputs.raw)).first()
    assert (row["passed"], row["n_checks"], row["n_failures"]) == (True, 24, 0)


def test_only_the_broken_check_fails(inputs):
    bad = inputs.raw.withColumn("Contract", F.when(F.col("customerID") == "C00000003", "Lifetime").otherwise(F.col("Contract")))
    failed = [r["check"] for r in q.quality_checks(bad).filter("not passed").collect()]
    assert failed == ["values_valid[Contract]"]
    assert [(r["field"], r["value"], r["n"]) for r in q.unexpected_values(bad).collect()] == [("Contract", "Lifetime", 1)]


def test_missing_column_and_duplicates(inputs):
    short = inputs.raw.drop("gender")
    checks = {r["check"]: r for r in q.quality_checks(short.unionByName(short.limit(2))).collect()}
    assert checks["required_columns_present"]["detail"] == "missing: gender" and "values_valid[gender]" not in checks
    assert checks["no_duplicate_rows"]["detail"] == "2 duplicate rows" and not checks["unique_customer_ids"]["passed"]


@pytest.mark.parametrize("with_events", [True])
def test_medallion_run(spark, inputs, tmp_path, with_events):
    out = medallion.run(inputs.landing, inputs.events, str(tmp_path / "m"), "arrival")
    rows = {r["table_name"]: r for r in out.collect()}
    assert rows["gold_customer_features_daily"]["records"] == rows["silver_customers_clean"]["records"]
    audit = spark.read.parquet(str(tmp_path / "m" / "audit_loads"))
    assert audit.count() == 6 and audit.filter("batch_id is null").count() == 0


def test_keep_last_keeps_values_without_arrival(spark):
    rows = [("a", 5, None), ("b", 1, 1), ("b", 2, 2), ("b", 3, None)]
    df = spark.createDataFrame(rows, "k string, tenure int, arrival long")
    assert sorted((r["k"], r["tenure"]) for r in c.keep_last(df, "k", "arrival").collect()) == [("a", 5), ("b", 2)]
