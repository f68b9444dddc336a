"""Stored reference profiles against drift over both sides."""

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import drift as d
from ebbtide.operators import reference as ref
from ebbtide.session import written

NUMBERS, TEXTS = ["z", "flat", "none", "half", "text"], ["kind", "empty"]


@pytest.fixture(scope="module")
def rows(spark):
    base = spark.range(3000).select(
        F.randn(1).alias("z"), F.when(F.col("id") % 2 == 0, d.REFERENCE).otherwise(d.CURRENT).alias("side"), "id"
    )
    return base.withColumns({
        "z": F.when(F.col("id") % 7 != 0, F.col("z") + (F.col("side") == d.CURRENT).cast("int")), "flat": F.lit(1.0), "none": F.lit(None).cast("double"),
        "half": F.when(F.col("side") == d.REFERENCE, F.col("z")), "text": F.lit("n/a"), "empty": F.lit(None).cast("string"),
        "kind": F.when(F.col("id") % 5 == 0, "new").when(F.col("id") % 3 == 0, F.col("side")),
    }).cache()


def both(rows):
    return rows.filter(F.col("side") == d.REFERENCE), rows.filter(F.col("side") == d.CURRENT)


def as_set(frame):
    return {tuple(r) for r in frame.select("feature", "type", "psi", "band", "drifted").collect()}


def test_equal_to_drift_over_both_sides_in_few_jobs(spark, rows):
    old, new = both(rows)
    profile = written(ref.profile_of(old, NUMBERS, TEXTS), "profile")
    assert profile.schema.simpleString() == spark.createDataFrame([], ref.PROFILE).schema.simpleString()
    sc = spark.sparkContext
    sc.setJobGroup("drift-run", "")
    got = as_set(ref.drift_against(profile, new))
    jobs = len(sc.statusTracker().getJobIdsForGroup("drift-run"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == as_set(d.feature_drift(rows, NUMBERS, TEXTS)) and len(got) == 7
    assert jobs <= 10, jobs


def test_profiles_add_up(rows):
    old, new = both(rows)
    profile = written(ref.profile_of(old, NUMBERS, TEXTS), "profile")
    early, late = old.filter("id < 1000"), old.filter("id >= 1000")
    sums = ref.merged(ref.counted_by(profile, early), ref.counted_by(profile, late))
    assert as_set(ref.drift_against(sums, new)) == as_set(ref.drift_against(profile, new))
    other = ref.profile_of(old.withColumn("z", F.col("z") * 2), NUMBERS, TEXTS)
    with pytest.raises(Exception, match="different edges"):
        ref.merged(profile, other).collect()


def test_no_rows_on_a_side(rows):
    old, new = both(rows)
    profile = written(ref.profile_of(old, NUMBERS, TEXTS), "profile")
    assert {r[2] for r in as_set(ref.drift_against(profile, new.limit(0)))} == {0.0}
    empty = written(ref.profile_of(old.limit(0), NUMBERS, TEXTS), "profile")
    assert {r[2] for r in as_set(ref.drift_against(empty, new))} == {0.0}
