import datetime
import glob

from pyspark.sql import functions as F

from ebbtide.operators import fold
from ebbtide.sources.tables import table_stream
from ebbtide.streaming import events as ev
from ebbtide.streaming import risk

SCHEMA = "event_id long, customer_id string, event_type string, timestamp timestamp_ntz, value double, is_simulated boolean"


def source(spark, folder, per_trigger=1):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def scored(inputs):
    return inputs.valued.withColumnRenamed("customerID", "customer_id")


def add(events, folder, low, high):
    part = events.filter(F.col("event_id").between(low, high - 1)).select(*[c.split()[0] for c in SCHEMA.split(", ")])
    part.coalesce(1).write.mode("append").parquet(folder)


def test_batches_and_restarts_equal_the_batch_fold(spark, inputs, tmp_path):
    folder, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    for low in range(0, 600, 200):
        add(inputs.events, folder, low, low + 200)
    updates = risk.risk_updates(ev.validated(source(spark, folder)), scored(inputs))
    assert ev.run_available(updates, out, check).count() == 600
    assert ev.run_available(updates, out, check).count() == 600  # nothing new: nothing repeated
    add(inputs.events, folder, 600, 1000)
    done = ev.run_available(updates, out, check)
    start = scored(inputs).select("customer_id", "churn_probability")
    batch = fold.risk_path(inputs.events, start).select(
        "event_id", F.round("previous_probability", 4).cast("double").alias("a"), F.round("new_probability", 4).cast("double").alias("b")
    )
    got = done.select("event_id", F.col("previous_probability").alias("a"), F.col("new_probability").alias("b"))
    assert done.count() == 1000 and got.exceptAll(batch).count() == 0


def test_state_frames_carry_one_text_for_all_that_passes_through(spark, inputs, tmp_path, monkeypatch):
    """A customer's frame costs by its columns; what is packed comes back with its types and its nulls."""
    folder, widths = str(tmp_path / "in"), spark.sparkContext.accumulator(0)
    step = risk._step

    def measured(key, batches, state):
        frames = list(batches)
        for frame in frames:
            widths.add(max(0, len(frame.columns) - 6))
        yield from step(key, iter(frames), state)

    monkeypatch.setattr(risk, "_step", measured)
    odd = inputs.events.withColumn("value", F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).when(F.col("event_id") % 3 == 1, F.col("value")))
    add(odd, folder, 0, 90)
    who = scored(inputs).withColumn("tenure", F.when(F.col("tenure") % 2 == 0, F.col("tenure")))
    done = ev.run_available(risk.risk_updates(source(spark, folder), who))
    assert done.count() == 90 and widths.value == 0
    columns = ["event_id", "event_type", F.col("timestamp").cast("timestamp"), "value"]
    sent = odd.filter("event_id < 90").select(*columns)
    assert done.select(*columns).exceptAll(sent).count() == 0 and sent.exceptAll(done.select(*columns)).count() == 0


def test_invalid_events_are_quarantined(spark, tmp_path):
    rows = [(1, "a", "login", None, None, True), (2, "a", "dance", None, 2.0, True), (3, None, "login", None, 1.0, True), (4, "a", None, None, 1.0, True)]
    df = spark.createDataFrame(rows, SCHEMA)
    good = ev.validated(df).collect()
    assert [(r["event_id"], r["value"]) for r in good] == [(1, 1.0)] and good[0]["timestamp"] is not None
    assert {r["event_id"] for r in ev.quarantined(df).collect()} == {2, 3, 4}


def test_repeated_batch_is_stored_once(spark, inputs, tmp_path):
    rows = [("a", 1, "login", 1.0, 0.5, 0.47, -0.03, "LOW", 3.0, True)]
    batch = spark.createDataFrame(
        rows, "customer_id string, event_id long, event_type string, value double, previous_probability double, new_probability double, "
        "risk_change double, new_risk_level string, revenue_at_risk double, is_simulated boolean",
    ).withColumn("timestamp", F.current_timestamp())
    store = risk.store_updates(str(tmp_path / "s"), "r")
    store(batch, 3)
    store(batch, 3)
    assert spark.read.parquet(str(tmp_path / "s" / "risk_scores")).count() == 1
    risk.store_updates(str(tmp_path / "s"), "another checkpoint")(batch, 3)
    assert spark.read.parquet(str(tmp_path / "s" / "risk_scores")).count() == 2
    event = spark.read.parquet(str(tmp_path / "s" / "customer_events")).filter("run = 'r'").first()
    assert event["payload"] == '{"delta_applied":-0.03}' and event["batch_id"] == 3


def test_a_stream_reads_a_folder_or_a_file(spark, inputs, tmp_path):
    folder = str(tmp_path / "events.parquet")
    rows = inputs.events.select(*[c.split()[0] for c in SCHEMA.split(", ")])
    rows.repartition(5).write.parquet(folder)
    streamed = ev.run_available(table_stream(spark, folder, SCHEMA, per_trigger=1))
    assert streamed.exceptAll(rows).isEmpty() and streamed.count() == rows.count()
    path = glob.glob(f"{folder}/part-*.parquet")[0]
    one = spark.read.parquet(path)
    assert ev.run_available(table_stream(spark, path, SCHEMA)).exceptAll(one).isEmpty()


def test_late_events_that_are_no_copies_come_out(spark, tmp_path):
    folder = str(tmp_path / "in")
    for name, hour, ids in (("a", 20, [1, 2]), ("b", 23, [3, 2, 4]), ("c", 1, [5, 6, 1])):
        times = [(k, "c", "login", datetime.datetime(2024, 1, 2, hour), 1.0, True) for k in ids]
        spark.createDataFrame(times, SCHEMA).coalesce(1).write.parquet(f"{folder}/part={name}")
    done = ev.run_available(ev.deduplicated(ev.validated(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder))))
    assert sorted(r["event_id"] for r in done.collect()) == [1, 2, 3, 4, 5, 6]


def test_folded_batches_equal_keyed_state_and_survive_repeats(spark, inputs, tmp_path):
    """Four batches with a snapshot after every second one, late events among them, a restart and a repeated batch."""
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    hot = inputs.events.withColumn("customer_id", F.when(F.col("event_id") % 3 == 0, F.lit("C1")).otherwise(F.col("customer_id")))
    who = scored(inputs)
    known = who.select("customer_id").first()["customer_id"]
    hot = hot.withColumn("customer_id", F.when(F.col("customer_id") == "C1", known).otherwise(F.col("customer_id")))
    for low in (600, 0, 300):
        add(hot, folder, low, low + 300)
    done = risk.run_folded(ev.validated(source(spark, folder)), who, out, check, snapshot_every=2)
    assert done.count() == 900
    add(hot, folder, 900, 1000)
    done = risk.run_folded(ev.validated(source(spark, folder)), who, out, check, snapshot_every=2)
    keyed = ev.run_available(risk.risk_updates(ev.validated(source(spark, folder)), who))
    assert done.count() == 1000 and done.exceptAll(keyed.select(*done.columns)).isEmpty()
    state = f"{out}/state/run=once"
    before = sorted(map(tuple, risk.kept_state(spark, state, 99).collect()))
    batch = spark.read.schema(SCHEMA).parquet(folder).filter("event_id >= 900")
    risk.store_folded(out, "once", who, snapshot_every=2)(ev.validated(batch), 3)  # the last batch again
    assert sorted(map(tuple, risk.kept_state(spark, state, 99).collect())) == before
    assert glob.glob(f"{state}/snapshots/*") and known in {b[0] for b in before}
