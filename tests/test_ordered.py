import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import ordered as o
from ebbtide.operators.skew import heavy_keys, spread_join


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value."""
    return spark.range(600).select(
        "id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.col("id") * 37, F.lit(101))).cast("double").alias("v")
    ).cache()


def test_rank_equals_sorted_position(skewed):
    rows = [(r["id"], r["v"]) for r in skewed.collect()]
    expected = {i: n + 1 for n, (i, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    got = o.with_rank(skewed, [F.desc("v"), F.asc("id")], "rk", total="n").collect()
    assert {r["id"]: r["rk"] for r in got} == expected and {r["n"] for r in got} == {600}


def test_ranges_share_a_hot_value(skewed):
    placed = o.range_sorted(skewed, [F.asc("v"), F.asc("id")], 4)
    sizes = [r["n"] for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) < 300


def test_tiles_match_ntile_for_every_size(spark):
    cases = spark.range(1, 40).select(F.col("id").alias("n"), F.explode(F.sequence(F.lit(1), F.col("id"))).alias("rk"))
    for tiles in range(1, 9):
        got = {}
        for r in cases.select("n", "rk", o.tile_of(F.col("rk"), F.col("n"), tiles).alias("t")).collect():
            got.setdefault(r["n"], []).append((r["rk"], r["t"]))
        for n, pairs in got.items():
            size, larger = divmod(n, tiles)
            expected = [t + 1 for t in range(tiles) for _ in range(size + (t < larger))]
            assert [t for _, t in sorted(pairs)] == expected


def test_running_totals_within_groups(spark):
    df = spark.range(300).select("id", (F.col("id") % 2).alias("g"), F.lit(2).alias("x"))
    out = o.with_running_totals(df, [F.asc("id")], {"upto": F.col("x")}, ["g"]).collect()
    assert all(r["upto"] == 2 * (r["id"] // 2 + 1) for r in out)


@pytest.mark.parametrize("probs", [[0.0, 0.1, 0.25, 0.5, 0.9, 1.0]])
def test_quantiles_match_numpy(spark, skewed, probs):
    df = skewed.select(F.when(F.col("id") < 100, "a").otherwise("b").alias("g"), (F.col("v") + F.col("id") / 7).alias("v"))
    got = {r["g"]: r["edges"] for r in o.exact_quantiles(df, ["g"], "v", probs).collect()}
    for g, edges in got.items():
        values = [r["v"] for r in df.filter(F.col("g") == g).collect()]
        assert np.allclose(edges, np.quantile(values, probs), rtol=0, atol=1e-9)


def test_quantiles_of_one_value(spark):
    df = spark.createDataFrame([("a", 3.0)], "g string, v double")
    assert o.exact_quantiles(df, ["g"], "v", [0.0, 0.5, 1.0]).first()["edges"] == [3.0, 3.0, 3.0]


def test_spread_join_keeps_every_row_once(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    assert [r["k"] for r in heavy_keys(rows, "k", 4).collect()] == [7]
    plain = sorted(map(tuple, rows.join(lookup, "k").select("id", "k", "x").collect()))
    spread = sorted(map(tuple, spread_join(rows, lookup, "k", F.col("id")).select("id", "k", "x").collect()))
    assert spread == plain
    left = spread_join(rows, lookup, "k", F.col("id"), how="left")
    assert left.count() == 1000 and left.filter("x is null").count() == rows.filter("k >= 40").count()


def test_salts_follow_the_share_of_a_key(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    shares = {r["k"]: r["_shares"] for r in heavy_keys(rows, "k", 30).collect()}
    assert shares == {-1: 10}
