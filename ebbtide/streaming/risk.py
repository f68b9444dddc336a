"""The live risk update: keyed state per customer, decisions as columns, idempotent sinks.

Two ways to the same updates. :func:`risk_updates` is one streaming plan with keyed state: a customer's events of a micro-batch
are one frame in one task, so the source's per-trigger limit must bound them. :func:`store_folded` works batch by batch: the
micro-batch is folded in ranges of the global (customer, time) order, so a customer with a third of it is spread over a
third of the tasks, and what is kept between batches is one row per customer in stored tables.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ebbtide.config import DEFAULTS, Settings
from ebbtide.functions.numeric import rounded
from ebbtide.functions.risk import event_delta, risk_level
from ebbtide.operators.fold import UNIT, prefix_maps, risk_path
from ebbtide.operators.value import recommended_action
from ebbtide.sources.commits import jvm_path

# Raised by the state serializer for every batch; harmless.
warnings.filterwarnings("ignore", message=".*DataFrame concatenation with empty.*", category=FutureWarning)

_STEP = "customer_id string, event_id long, micros long, rest string, p_before long, p_after long"

_STATE = "customer_id string, p long, batch long"
_UPDATED = (
    "customer_id string, event_id long, event_type string, timestamp timestamp, value double, previous_probability double, "
    "new_probability double, risk_change double, previous_risk_level string, new_risk_level string, revenue_at_risk double, "
    "recommended_action string, model_version string, is_simulated boolean, p_after long"
)
_UPDATE = [f.split()[0] for f in _UPDATED.split(", ")[:-1]]

# Customer attributes that the decision rules read.
DECISION_SIGNALS = [
    "estimated_clv", "payment_risk_indicator", "is_month_to_month", "tenure", "has_internet", "has_tech_support",
    "has_online_security",
]


def _step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Apply a customer's events of this micro-batch in time order to the kept probability. There are many small frames, each
    of which costs by its columns: time is a number, and all that only passes through is one text."""
    frames = list(batches)
    events = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    ids, micros = events["event_id"].to_numpy(), events["micros"].to_numpy()
    order = np.lexsort((ids, micros))
    start = state.get[0] if state.exists else int(events["p0"].iloc[order[0]])
    d, lo, hi = prefix_maps(np.zeros(len(events), np.int8), events["delta"].to_numpy()[order])
    after = np.minimum(hi, np.maximum(lo, start + d))
    state.update((int(after[-1]),))
    yield pd.DataFrame(
        {
            "customer_id": key[0], "event_id": ids[order], "micros": micros[order], "rest": events["rest"].to_numpy()[order],
            "p_before": np.concatenate(([start], after[:-1])), "p_after": after,
        }
    )


def risk_updates(
    events: DataFrame, scored: DataFrame, model_version: str = "unknown", cfg: Settings = DEFAULTS
) -> DataFrame:
    """Stream of risk updates. ``scored`` is the static table of scored customers (customer_id,
    churn_probability, decision signals): it seeds the state and rejects unknown customers. It is
    read and joined once per micro-batch, so it should be a stored table."""
    seed = scored.select(
        "customer_id", (F.col("churn_probability").cast("decimal(18,9)") * UNIT).cast("long").alias("p0"), *DECISION_SIGNALS
    )
    rest = ["event_type", "value", *DECISION_SIGNALS]
    moves = events.select(
        "customer_id", "event_id", "event_type", F.unix_micros(F.col("timestamp").cast("timestamp")).alias("micros"), "value",
        (event_delta("event_type") * F.lit(UNIT)).cast("long").alias("delta"),
    ).join(seed, "customer_id")
    packed = ", ".join(f"{c} {moves.schema[c].dataType.simpleString()}" for c in rest)
    stepped = moves.select("customer_id", "event_id", "micros", "delta", "p0", F.to_json(F.struct(*rest)).alias("rest")).groupBy(
        "customer_id"
    ).applyInPandasWithState(_step, _STEP, "p long", "append", GroupStateTimeout.NoTimeout)
    stepped = stepped.withColumns({"timestamp": F.timestamp_micros("micros"), "rest": F.from_json("rest", packed)}).select("*", "rest.*")
    return _decided(stepped, model_version, cfg).select(*_UPDATE)


def _decided(stepped: DataFrame, model_version: str, cfg: Settings) -> DataFrame:
    """Levels, revenue at risk and action of each step from ``p_before`` to ``p_after``."""
    before, after = F.col("p_before") / F.lit(UNIT), F.col("p_after") / F.lit(UNIT)
    levelled = stepped.withColumns(
        {
            "previous_probability": rounded(before, 4),
            "new_probability": rounded(after, 4),
            "risk_change": rounded(after - before, 4),
            "previous_risk_level": risk_level(before, cfg),
            "new_risk_level": risk_level(after, cfg),
            "risk_level": risk_level(after, cfg),
            "revenue_at_risk": rounded(after * F.col("estimated_clv"), 2),
        }
    )
    return levelled.withColumns(
        {
            "recommended_action": recommended_action(levelled, cfg),
            "model_version": F.lit(model_version),
            "is_simulated": F.lit(True),
        }
    )


def _batches_of(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the micro-batches that have a subfolder."""
    place, system = jvm_path(spark, folder)
    names = [x.getPath().getName() for x in system.listStatus(place)] if system.exists(place) else []
    return [int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")]


def kept_state(spark: SparkSession, folder: str, before: int) -> DataFrame:
    """customer_id and p (in units) after all micro-batches numbered below ``before``: the last snapshot and the changes since.
    Batches run one after another, so those below the current one are complete, and leftovers of a failed try are not read."""
    snapshots = [b for b in _batches_of(spark, f"{folder}/snapshots") if b < before]
    last = max(snapshots, default=-1)
    paths = [f"{folder}/snapshots/batch_id={last}"] if snapshots else []
    paths += [f"{folder}/changes/batch_id={b}" for b in _batches_of(spark, f"{folder}/changes") if last < b < before]
    if not paths:
        return spark.createDataFrame([], _STATE)
    stored = spark.read.schema(_STATE).parquet(*paths)
    return stored.groupBy("customer_id").agg(F.max_by("p", "batch").alias("p"), F.max("batch").alias("batch"))


def store_folded(
    folder: str, run: str, scored: DataFrame, model_version: str = "unknown", snapshot_every: int = 20, cfg: Settings = DEFAULTS
):
    """A foreachBatch sink that updates risk: ``{folder}/updates`` gets the updates of each micro-batch, ``{folder}/state`` the
    probabilities that changed and, every so many batches, those of all customers seen so far. A repeated batch overwrites its own
    folders and starts from the same state. ``scored`` is as for :func:`risk_updates`; events of unknown customers are left out.

    Within a micro-batch events are in (timestamp, event_id) order, between micro-batches in the order of arrival. Empty batches
    store nothing.
    """
    state = f"{folder}/state/run={run}"

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events = batch.select("customer_id", "event_id", "event_type", F.col("timestamp").cast("timestamp").alias("timestamp"), "value")
        earlier = kept_state(spark, state, batch_id)
        seeded = scored.select("customer_id", "churn_probability", *DECISION_SIGNALS).join(earlier, "customer_id", "left")
        now = F.coalesce((F.col("p").cast("decimal(18,0)") / UNIT).cast("decimal(18,9)"), F.col("churn_probability").cast("decimal(18,9)"))
        path = risk_path(events, seeded.select("customer_id", now.alias("churn_probability"), *DECISION_SIGNALS))
        units = {f"p_{c}": (F.col(f"{n}_probability") * UNIT).cast("long") for c, n in (("before", "previous"), ("after", "new"))}
        stored = f"{folder}/updates/run={run}/batch_id={batch_id}"
        updates = _decided(path.withColumns(units), model_version, cfg).select(*_UPDATE, "p_after")
        updates.write.mode("overwrite").parquet(stored)
        moved = spark.read.schema(updates.schema).parquet(stored).groupBy("customer_id").agg(
            F.max_by("p_after", F.struct("timestamp", "event_id")).alias("p"), F.lit(batch_id).cast("long").alias("batch")
        )
        moved.write.mode("overwrite").parquet(f"{state}/changes/batch_id={batch_id}")
        if (batch_id + 1) % snapshot_every == 0:
            kept_state(spark, state, batch_id + 1).write.mode("overwrite").parquet(f"{state}/snapshots/batch_id={batch_id}")

    return store


def run_folded(
    events: DataFrame, scored: DataFrame, folder: str, checkpoint: str, run: str = "once", model_version: str = "unknown",
    snapshot_every: int = 20, cfg: Settings = DEFAULTS,
) -> DataFrame:
    """Take all events that are available now through :func:`store_folded`; the updates of all batches of the run so far."""
    sink = store_folded(folder, run, scored, model_version, snapshot_every, cfg)
    job = events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    job.awaitTermination()
    spark = scored.sparkSession
    found = _batches_of(spark, f"{folder}/updates/run={run}")
    paths = [f"{folder}/updates/run={run}/batch_id={b}" for b in found]
    return spark.read.schema(_UPDATED).parquet(*paths).select(*_UPDATE) if paths else spark.createDataFrame([], _UPDATED).select(*_UPDATE)


def store_updates(folder: str, run: str):
    """A foreachBatch sink into two tables. A batch overwrites its own folder, so a repeated batch
    after a failure leaves each row once. ``run`` names the checkpoint: batch numbers start again
    with each new one, and must not overwrite those of another."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        events = batch.select(
            "customer_id", "event_id", "event_type", F.col("timestamp").alias("event_timestamp"), "value", "is_simulated",
            F.to_json(F.struct(F.col("risk_change").alias("delta_applied"))).alias("payload"),
        )
        scores = batch.select(
            "customer_id", "event_id", "previous_probability", "new_probability", "risk_change",
            F.col("new_risk_level").alias("risk_level"), "revenue_at_risk",
        )
        events.write.mode("overwrite").parquet(f"{folder}/customer_events/run={run}/batch_id={batch_id}")
        scores.write.mode("overwrite").parquet(f"{folder}/risk_scores/run={run}/batch_id={batch_id}")
        batch.unpersist()

    return store
