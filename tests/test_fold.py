import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.operators import fold

DELTAS = st.lists(st.integers(-9 * 10**8, 9 * 10**8), min_size=1, max_size=60)


def walk(start, deltas):
    out, p = [], start
    for d in deltas:
        p = min(fold.UNIT, max(0, p + d))
        out.append(p)
    return out


@settings(max_examples=150, deadline=None)
@given(DELTAS, st.integers(0, fold.UNIT), st.integers(0, 60))
def test_composed_maps_equal_the_walk(deltas, start, cut):
    d, lo, hi = fold.prefix_maps(np.zeros(len(deltas)), np.array(deltas))
    assert np.minimum(hi, np.maximum(lo, start + d)).tolist() == walk(start, deltas)
    assert ((lo >= 0) & (hi <= fold.UNIT) & (lo <= hi)).all()
    cut = min(cut, len(deltas) - 1)
    if cut:  # the same in two batches
        first = tuple(int(x[-1]) for x in fold.prefix_maps(np.zeros(cut), np.array(deltas[:cut])))
        d, lo, hi = fold.prefix_maps(np.zeros(len(deltas) - cut), np.array(deltas[cut:]), first=first)
        assert np.minimum(hi, np.maximum(lo, start + d)).tolist() == walk(start, deltas)[cut:]


@settings(max_examples=50, deadline=None)
@given(st.lists(DELTAS, min_size=2, max_size=5))
def test_owners_do_not_mix(histories):
    owner = np.concatenate([np.full(len(h), i) for i, h in enumerate(histories)])
    d, lo, hi = fold.prefix_maps(owner, np.concatenate(histories))
    got = np.minimum(hi, np.maximum(lo, 10**8 + d)).tolist()
    assert got == [p for h in histories for p in walk(10**8, h)]


def frames(spark):
    kinds = ["payment_failed", "login", "purchase", "cancellation_attempt", "plan_upgrade", "mystery"]
    n = len(kinds)
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.pmod(F.xxhash64("id"), F.lit(n)) + 1).cast("int"))
    events = spark.range(900).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 11)).alias("customer_id"),
        kind.alias("event_type"), (F.col("id") % 100).alias("timestamp"),
    )
    start = spark.createDataFrame([("hot", 0.3), ("quiet", 0.9), *[(f"c{i}", i / 11) for i in range(10)]], "customer_id string, churn_probability double")
    return events, start


def expected(events, start):
    from ebbtide.vocab import EVENT_DELTAS

    p = {r["customer_id"]: round(r["churn_probability"] * 10**9) for r in start.collect()}
    steps = {}
    for r in sorted(events.collect(), key=lambda r: (r["customer_id"], r["timestamp"], r["event_id"])):
        if r["customer_id"] in p:
            before = p[r["customer_id"]]
            p[r["customer_id"]] = walk(before, [round(float(EVENT_DELTAS.get(r["event_type"], 0)) * 10**9)])[0]
            steps[r["event_id"]] = (before, p[r["customer_id"]])
    return steps, p


def test_path_of_a_hot_customer_over_many_ranges(spark):
    events, start = frames(spark)
    steps, final = expected(events, start)
    got = {
        r["event_id"]: (round(r["previous_probability"] * 10**9), round(r["new_probability"] * 10**9))
        for r in fold.risk_path(events, start, parts=7).collect()
    }
    assert got == steps
    current = {r["customer_id"]: (round(r["current_probability"] * 10**9), r["n_events"]) for r in fold.final_risk(events, start, parts=7).collect()}
    assert {c: p for c, (p, _) in current.items()} == final and current["quiet"] == (9 * 10**8, 0) and current["hot"][1] == 300


def test_unknown_customers_are_rejected_not_lost(spark):
    events, start = frames(spark)
    rejected = fold.unknown_customer_events(events, start)
    assert {r["customer_id"] for r in rejected.collect()} == {"c10"}
    assert rejected.count() + fold.risk_path(events, start).count() == 900
