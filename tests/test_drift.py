import pytest
from pyspark.sql import functions as F

from ebbtide.operators import drift as d


@pytest.fixture(scope="module")
def normal(spark):
    base = spark.range(4000).select(
        F.randn(1).alias("z"), F.when(F.col("id") % 2 == 0, d.REFERENCE).otherwise(d.CURRENT).alias("side"), "id"
    )
    return base.cache()


def psi(frame):
    return {r["feature"]: r["psi"] for r in frame.collect()}


def test_numeric_identical_shifted_constant_empty(normal):
    shift = F.when(F.col("side") == d.CURRENT, 2.0).otherwise(0.0)
    twin = normal.select("side", F.col("id").cast("double"), "z").withColumn("same", F.floor(F.col("id") / 2).cast("double"))
    df = twin.withColumns({
        "moved": F.col("z") + shift, "flat": F.lit(1.0), "none": F.lit(None).cast("double"),
        "half": F.when(F.col("side") == d.REFERENCE, F.col("z")), "text": F.lit("n/a"),
    })
    got = psi(d.psi_numeric(df, ["same", "moved", "flat", "none", "half", "text"]))
    assert abs(got["same"]) < 1e-9 and got["moved"] > 0.25
    assert (got["flat"], got["none"], got["half"], got["text"]) == (0.0, 0.0, 0.0, 0.0)
    assert all(v >= 0 for v in got.values())


def test_approximate_edges_are_close(normal):
    df = normal.withColumn("z", F.col("z") + F.when(F.col("side") == d.CURRENT, 1.0).otherwise(0.0))
    exact, approx = psi(d.psi_numeric(df, ["z"]))["z"], psi(d.psi_numeric(df, ["z"], exact=False))["z"]
    assert abs(exact - approx) < 0.05


def test_constant_reference_is_split_at_its_mean(spark):
    rows = [(d.REFERENCE, 5.0)] * 10 + [(d.CURRENT, 4.0)] * 5 + [(d.CURRENT, 5.0)] * 5
    df = spark.createDataFrame(rows, "side string, v double")
    assert psi(d.psi_numeric(df, ["v"]))["v"] > 0.25


def test_categories(spark):
    rows = [(d.REFERENCE, "A")] * 800 + [(d.REFERENCE, "B")] * 200 + [(d.CURRENT, "A")] * 200 + [(d.CURRENT, "B")] * 800
    df = spark.createDataFrame(rows, "side string, c string").withColumn("same", F.lit(None).cast("string"))
    got = psi(d.psi_categorical(df, ["c", "same"]))
    assert got["c"] > 0.25 and got["same"] == 0.0


def test_bands(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.2,), (0.25,), (0.9,)], "p double")
    assert [r[0] for r in df.select(d.psi_band("p")).collect()] == ["stable", "moderate", "moderate", "significant", "significant"]


def test_report_status(inputs):
    from ebbtide.plans.monitoring import with_sides

    shifted = with_sides(inputs.scored, F.col("tenure") < 24, F.col("tenure") >= 48)
    assert d.drift_report(shifted).first()["status"] == "RETRAINING_REQUIRED"
    copies = inputs.scored.unionByName(inputs.scored.withColumn("customerID", F.lit("copy")))
    same = with_sides(copies, F.col("customerID") != "copy", F.col("customerID") == "copy")
    row = d.drift_report(same).first()
    assert row["status"] == "STABLE" and row["n_drifted"] == 0 and row["prediction_psi"] == 0.0
    assert d.drift_report(same, score=None).first()["prediction_psi"] is None
