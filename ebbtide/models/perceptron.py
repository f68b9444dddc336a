"""A perceptron with hidden layers, trained data-parallel in mini-batches.

Every task takes Adam steps over the mini-batches of its rows, beginning at the shared state; after each pass the states of
all tasks are averaged, weighted by their rows. A pass also measures the state it began with on the held-out rows, so that
training ends once these no longer gain. All passes are one stage: tasks keep their rows in a mapped file and exchange states.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasSeed, HasStepSize, HasTol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.models.together import MOST_TOGETHER, dealt, run_together, slots
from ebbtide.session import ship_package, written

_B1, _B2, _TINY = 0.9, 0.999, 1e-8  # Adam's usual decay rates


def layers_of(flat: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of each layer's weights and offsets in the flat state."""
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def first_state(sizes: list[int], seed: int) -> np.ndarray:
    """Uniform starting weights whose range follows the widths of the layer; offsets are zero."""
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(sizes, sizes[1:]):
        bound = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), np.zeros(b)]
    return np.concatenate(parts)


def activations(x: np.ndarray, layers: list) -> list[np.ndarray]:
    """The input, each hidden layer's output (rectified), and the logit."""
    out = [x]
    for k, (w, b) in enumerate(layers):
        z = out[-1] @ w
        z += b
        out.append(np.maximum(z, 0.0, out=z) if k < len(layers) - 1 else z)
    return out


def row_losses(logit: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, logit) - y * logit


def gradient(flat: np.ndarray, sizes: list[int], x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
    """Gradient of the weighted mean loss plus half the penalty times the squared weights, by the batch's weight."""
    layers, total = layers_of(flat, sizes), weight.sum()
    acts = activations(x, layers)
    out = np.empty_like(flat)
    slots = layers_of(out, sizes)
    delta = ((1 / (1 + np.exp(-np.clip(acts[-1][:, 0], -500, 500))) - y) * weight / total)[:, None]
    for k in range(len(layers) - 1, -1, -1):
        np.matmul(acts[k].T, delta, out=slots[k][0])
        slots[k][0][:] += penalty / total * layers[k][0]
        delta.sum(0, out=slots[k][1])
        if k:
            back = np.ascontiguousarray(layers[k][0].T)
            delta = delta @ back if len(back) > 1 else delta * back
            np.multiply(delta, acts[k] > 0, out=delta)
    return out


class Perceptron(
    Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasMaxIter, HasSeed, HasStepSize, HasTol, DefaultParamsReadable, DefaultParamsWritable
):
    """Two classes. ``heldOut`` of the rows (by a hash of features and label) are not learnt from; after ``patience`` passes
    without a gain of ``tol`` in their loss the best state is the model. Without any such row the loss of the learnt rows
    counts. Rows of weight 0 change nothing; no rows at all are an error."""

    hidden = Param(Params._dummy(), "hidden", "widths of the hidden layers", TypeConverters.toListInt)
    penalty = Param(Params._dummy(), "penalty", "L2 penalty on the weights", TypeConverters.toFloat)
    batch = Param(Params._dummy(), "batch", "rows of a mini-batch", TypeConverters.toInt)
    patience = Param(Params._dummy(), "patience", "passes without a gain before training ends", TypeConverters.toInt)
    heldOut = Param(Params._dummy(), "heldOut", "share of rows that decide when to end", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", labelCol: str = "label", weightCol: str | None = None, hidden: list[int] | None = None,
        penalty: float = 1e-4, batch: int = 200, maxIter: int = 300, stepSize: float = 1e-3, tol: float = 1e-4, patience: int = 10,
        heldOut: float = 0.1, seed: int = 42,
    ):
        super().__init__()
        self._setDefault(
            hidden=[64, 32], penalty=1e-4, batch=200, maxIter=300, stepSize=1e-3, tol=1e-4, patience=10, heldOut=0.1, seed=42
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PerceptronModel:
        ship_package(dataset.sparkSession)
        get = self.getOrDefault
        weight = F.col(get(self.weightCol)).cast("double") if self.isSet(self.weightCol) else F.lit(1.0)
        rows = dataset.select(
            vector_to_array(get(self.featuresCol)).alias("x"), F.col(get(self.labelCol)).cast("double").alias("y"), weight.alias("w")
        )
        held = F.pmod(F.xxhash64("x", "y"), F.lit(10_000)) < int(get(self.heldOut) * 10_000)
        rows = written(rows.withColumn("held", held), "perceptron")
        width = rows.agg(F.max(F.size("x"))).first()[0]
        if width is None:
            raise ValueError("no rows to fit on")
        sizes = [width, *get(self.hidden), 1]
        table = written(rows.mapInArrow(_frames, "part int, frame int, x binary, y binary, w binary, held binary"), "frames")
        parts, most = rows.rdd.getNumPartitions(), min(slots(dataset.sparkSession), MOST_TOGETHER)
        # Each stored partition is a task's, as long as they can all run together; else frames are dealt in turn.
        tasks = table.rdd.map(lambda r: (r[0], tuple(r))).partitionBy(parts, int).values() if parts <= most else dealt(table, most)
        settings = {p: get(getattr(self, p)) for p in ("penalty", "batch", "stepSize", "seed", "maxIter", "tol", "patience")}
        best, best_loss, spent = run_together(dataset.sparkSession, tasks, lambda frames, gather: _passes(frames, gather, sizes, settings))
        model = PerceptronModel(featuresCol=get(self.featuresCol), sizes=sizes, weights=best, passes=spent, heldOutLoss=best_loss)
        return model


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every batch of rows as one row of packed columns, with its place."""
    part = TaskContext.get().partitionId()
    for k, batch in enumerate(b for b in batches if b.num_rows):
        packed = [batch["x"].flatten(), *(batch[c].cast(t) for c, t in (("y", pa.float64()), ("w", pa.float64()), ("held", pa.uint8())))]
        columns = [pa.array([part], pa.int32()), pa.array([k], pa.int32()), *(pa.array([c.to_numpy().tobytes()], pa.binary()) for c in packed)]
        yield pa.RecordBatch.from_arrays(columns, ["part", "frame", "x", "y", "w", "held"])


def _mapped(frames: Iterable[tuple], width: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The task's frames in their order; vectors lie in a mapped file, so that they need not fit in memory."""
    file, found, at = tempfile.TemporaryFile(), {}, 0
    for part, frame, x, *others in frames:
        y, w, held = (np.frombuffer(v, t) for v, t in zip(others, (np.float64, np.float64, np.bool_), strict=True))
        file.write(x)
        found[part, frame] = at, y, w, held
        at += len(x)
    file.flush()
    whole = np.memmap(file, np.float64, "r") if at else np.zeros(0)
    return [(whole[at // 8 : at // 8 + len(y) * width].reshape(-1, width), y, w, held) for at, y, w, held in (found[k] for k in sorted(found))]


def _passes(frames: Iterable[tuple], gather: Callable[[np.ndarray], list[np.ndarray]], sizes: list[int], settings: dict) -> tuple[list[float], float, int]:
    """All passes; every task takes the same decisions from the same sums. Gives the best weights, their loss and the passes."""
    frames = _mapped(frames, sizes[0])
    size = len(first_state(sizes, 0))
    state = np.concatenate([first_state(sizes, settings["seed"]), np.zeros(2 * size)])  # weights, Adam's two moments
    learnt_weight = float(sum(w[~held].sum() for _, _, w, held in frames))
    weight, held_weight = sum(gather(np.array([learnt_weight, sum(w[held].sum() for _, _, w, held in frames)])))
    steps, best, best_loss, idle, spent = 0.0, state[:size].copy(), np.inf, 0, 0
    for spent in range(settings["maxIter"] + 1):
        ended, done, loss = _pass(frames, state, steps, sizes, settings, settings["seed"] + spent, held_weight > 0)
        whole = sum(gather(np.concatenate([np.append(ended, done) * learnt_weight, [loss]])))
        loss = whole[-1] / held_weight if held_weight else whole[-1] / max(weight, _TINY)
        idle = 0 if loss < best_loss - settings["tol"] else idle + 1
        if loss < best_loss:
            best, best_loss = state[:size].copy(), loss
        if idle >= settings["patience"] or not weight:
            break
        state, steps = whole[: 3 * size] / weight, whole[3 * size] / weight
    return best.tolist(), float(best_loss), spent


def _pass(frames: list[tuple], state: np.ndarray, steps: float, sizes: list[int], settings: dict, seed: int, by_held: bool) -> tuple[np.ndarray, float, float]:
    """One pass of a task: the state and steps it ends with, and the loss of the state it began with on the rows that count."""
    flat, m, v = np.split(state.copy(), 3)
    begun, done, rng, loss = layers_of(state[: len(flat)], sizes), steps, np.random.default_rng(seed), 0.0
    for x, y, w, held in frames:
        of = np.flatnonzero(held == by_held)
        if len(of):
            loss += (row_losses(activations(x[of], begun)[-1][:, 0], y[of]) * w[of]).sum()
        order = rng.permutation(np.flatnonzero(~held & (w > 0)))
        for at in range(0, len(order), settings["batch"]):
            of = order[at:at + settings["batch"]]
            g = gradient(flat, sizes, x[of], y[of], w[of], settings["penalty"])
            done += 1
            m *= _B1
            m += (1 - _B1) * g
            v *= _B2
            g *= g
            g *= 1 - _B2
            v += g
            np.sqrt(np.divide(v, 1 - _B2**done, out=g), out=g)
            g += _TINY
            np.divide(m, g, out=g)
            g *= settings["stepSize"] / (1 - _B1**done)
            flat -= g
    return np.concatenate([flat, m, v]), done, loss


class PerceptronModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``rawPrediction``, ``probability`` and ``prediction``. ``passes`` counts the passes that were learnt from."""

    sizes = Param(Params._dummy(), "sizes", "widths of all layers", TypeConverters.toListInt)
    weights = Param(Params._dummy(), "weights", "weights and offsets, layer by layer", TypeConverters.toListFloat)
    passes = Param(Params._dummy(), "passes", "passes before training ended", TypeConverters.toInt)
    heldOutLoss = Param(Params._dummy(), "heldOutLoss", "mean loss of the held-out rows", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", sizes: list[int] | None = None, weights: list[float] | None = None, passes: int | None = None,
        heldOutLoss: float | None = None,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        sizes, flat = self.getOrDefault(self.sizes), np.array(self.getOrDefault(self.weights))

        @F.pandas_udf("double")
        def logit(x: pd.Series) -> pd.Series:
            return pd.Series(activations(np.stack(x.to_numpy()), layers_of(flat, sizes))[-1][:, 0] if len(x) else [], dtype="float64")

        z = F.col("_logit")
        p = 1 / (1 + F.exp(-z))
        out = dataset.withColumn("_logit", logit(vector_to_array(self.getOrDefault(self.featuresCol))))
        return out.withColumns(
            {
                "rawPrediction": array_to_vector(F.array(-z, z)), "probability": array_to_vector(F.array(1 - p, p)),
                "prediction": (z >= 0).cast("double"),
            }
        ).drop("_logit")
