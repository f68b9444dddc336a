"""K-means segments over standardised behaviour, value and risk."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS
from ebbtide.functions.numeric import added
from ebbtide.models.candidates import sized
from ebbtide.operators.split import standardised
from ebbtide.session import ship_package, written
from ebbtide.vocab import ID, SEGMENT_FEATURES

_VECTOR = "segment_vector"


def segment_vectors(scored: DataFrame, features: list[str] = SEGMENT_FEATURES) -> DataFrame:
    """Rows with the z-scores of the segment features as a vector; written once for the fits."""
    z = [f"{c}_z" for c in features]
    out = VectorAssembler(inputCols=z, outputCol=_VECTOR).transform(standardised(scored, features))
    vectors = written(out.drop(*z), "segments")
    return sized(vectors)


@dataclass
class Clusters:
    """A fit: its centres (cluster by dimension), its cost, and each cluster's rows, sum of vectors and sum of squared norms."""

    k: int
    centres: np.ndarray
    cost: float
    sizes: np.ndarray
    sums: np.ndarray
    squares: np.ndarray


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def _spread_out(pool: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` rows of the pool, each drawn with a chance that grows with its squared distance from those before it."""
    chosen = [pool[rng.integers(len(pool))]]
    near = _distances(pool, chosen[0][None])[:, 0]
    while len(chosen) < k:
        share = near / near.sum() if near.sum() > 0 else None
        chosen.append(pool[rng.choice(len(pool), p=share)])
        near = np.minimum(near, _distances(pool, chosen[-1][None])[:, 0])
    return np.array(chosen)


def starting_centres(vectors: DataFrame, ks: Iterable[int], starts: int, seed: int, pool_rows: int = 1000) -> list[np.ndarray]:
    """Centres of every fit (all starts of the first k, then of the next). They are drawn from about ``pool_rows`` rows a
    start, those with the smallest hashes of id and start; only the starting centres depend on these."""
    rows = vectors.count()
    bound = min(1.0, pool_rows / max(rows, 1)) * (1 << 31)
    drawn = F.array(*[F.when(F.pmod(F.xxhash64(ID, F.lit(seed + i)), F.lit(1 << 31)) < bound, F.lit(i)) for i in range(starts)])
    found = vectors.select(ID, vector_to_array(_VECTOR).alias("x"), F.explode(F.array_compact(drawn)).alias("start")).toPandas()
    found = found.sort_values(["start", ID], kind="stable")
    if not len(found):
        raise ValueError("no rows to cluster")
    pools = {i: np.stack(part["x"].to_numpy()) for i, part in found.groupby("start")}
    fallback = next(iter(pools.values()))
    return [_spread_out(pools.get(i, fallback), k, np.random.default_rng([seed, i, k])) for k in ks for i in range(starts)]


def _assigned(vectors: DataFrame, fits: dict[int, np.ndarray]) -> dict[int, Clusters]:
    """Every row meets the centres of all fits in one pass; the driver gets one row per fit and cluster."""
    width = next(iter(fits.values())).shape[1]
    dims = [f"d{j}" for j in range(width)]

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {f: np.zeros((len(c), width + 3)) for f, c in fits.items()}  # rows, squares, cost, vector
        for frame in frames:
            if not len(frame):
                continue
            x = np.stack(frame["x"].to_numpy())
            one, squares = np.ones(len(x)), (x * x).sum(1)
            for f, centres in fits.items():
                far = _distances(x, centres)
                near = far.argmin(1)
                facts = np.column_stack([one, squares, far.min(1), x])
                sums[f] += (near[:, None] == np.arange(len(centres))).T.astype(float) @ facts
        for f, s in sums.items():
            yield pd.DataFrame(s, columns=["n", "squares", "cost", *dims]).assign(fit=f, cluster=np.arange(len(s)))

    schema = "n double, squares double, cost double, " + ", ".join(f"{d} double" for d in dims) + ", fit int, cluster int"
    parts = vectors.select(vector_to_array(_VECTOR).alias("x")).mapInPandas(measure, schema)
    table = parts.groupBy("fit", "cluster").agg(*[F.sum(c).alias(c) for c in ("n", "squares", "cost", *dims)]).toPandas()
    out = {}
    for f, part in table.sort_values("cluster").groupby("fit"):
        out[f] = Clusters(
            len(part), fits[f], float(part["cost"].sum()), part["n"].to_numpy(), part[dims].to_numpy(), part["squares"].to_numpy()
        )
    return out


def fit_together(vectors: DataFrame, starts: list[np.ndarray], rounds: int = 20, tol: float = 1e-4) -> list[Clusters]:
    """K-means from every set of starting centres, all in the same passes: a round is one job, however many fits take part.
    A fit ends when none of its centres moves by more than ``tol``. A cluster without rows keeps its centre."""
    centres, moving = dict(enumerate(starts)), set(range(len(starts)))
    for _ in range(rounds):
        if not moving:
            break
        for f, found in _assigned(vectors, {f: centres[f] for f in moving}).items():
            sizes = found.sizes[:, None]
            moved = np.where(sizes > 0, found.sums / np.maximum(sizes, 1), centres[f])
            if ((moved - centres[f]) ** 2).sum(1).max() <= tol * tol:
                moving.discard(f)
            centres[f] = moved
    final = _assigned(vectors, centres)
    return [final[f] for f in range(len(starts))]


def silhouettes(vectors: DataFrame, fits: list[Clusters]) -> list[float]:
    """Mean silhouette (squared Euclidean) of every fit in one pass: mean distances to a cluster follow from its rows, sum and
    sum of squares. A row alone in its cluster counts 0."""

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(fits), 2))
        for frame in frames:
            if not len(frame):
                continue
            x = np.stack(frame["x"].to_numpy())
            rows, squares = np.arange(len(x)), (x * x).sum(1)[:, None]
            for f, fit in enumerate(fits):
                n = np.where(fit.sizes > 0, fit.sizes, np.nan)
                mean = squares - 2 * x @ (fit.sums / n[:, None]).T + fit.squares / n
                own = _distances(x, fit.centres).argmin(1)
                inner = mean[rows, own] * fit.sizes[own] / np.maximum(fit.sizes[own] - 1, 1)
                mean[rows, own] = np.nan
                outer = np.nanmin(np.where(np.isnan(mean), np.inf, mean), axis=1)
                top = np.maximum(inner, outer)
                good = (fit.sizes[own] > 1) & (top > 0) & np.isfinite(outer)
                sums[f] += [np.where(good, (outer - inner) / np.where(good, top, 1), 0).sum(), len(x)]
        yield pd.DataFrame(sums, columns=["s", "n"]).assign(fit=np.arange(len(fits)))

    parts = vectors.select(vector_to_array(_VECTOR).alias("x")).mapInPandas(measure, "s double, n double, fit int")
    table = parts.groupBy("fit").agg((F.sum("s") / F.sum("n")).alias("s")).toPandas()
    return table.sort_values("fit")["s"].tolist()


def _best_of(vectors: DataFrame, ks: list[int], starts: int, seed: int) -> list[Clusters]:
    """The fit of the lowest cost for every k."""
    ship_package(vectors.sparkSession)
    fits = fit_together(vectors, starting_centres(vectors, ks, starts, seed))
    return [min((f for f in fits if f.k == k), key=lambda f: f.cost) for k in ks]


def choose_k(vectors: DataFrame, ks=range(2, 9), starts: int = 10, seed: int = DEFAULTS.seed) -> DataFrame:
    """Inertia and silhouette (squared Euclidean) per k."""
    best = _best_of(vectors, list(ks), starts, seed)
    rows = [(f.k, round(f.cost, 2), round(s, 4)) for f, s in zip(best, silhouettes(vectors, best))]
    return vectors.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def fit_segments(vectors: DataFrame, k: int, starts: int = 10, seed: int = DEFAULTS.seed) -> DataFrame:
    """Rows with their cluster: the nearest centre, the first on a tie."""
    x = vector_to_array(_VECTOR)
    best = _best_of(vectors, [k], starts, seed)[0]
    far = F.array(*[added((x[j] - float(v)) * (x[j] - float(v)) for j, v in enumerate(centre)) for centre in best.centres])
    rows = vectors.withColumn("_far", far)
    nearest = (F.array_position("_far", F.array_min("_far")) - 1).cast("int")
    return rows.withColumn("cluster", nearest).drop("_far", _VECTOR)


def pca_2d(vectors: DataFrame) -> DataFrame:
    """Two principal components per row (the sign of a component is arbitrary)."""
    model: PipelineModel = Pipeline(stages=[PCA(k=2, inputCol=_VECTOR, outputCol="_pc")]).fit(vectors)
    pc = vector_to_array("_pc")
    return model.transform(vectors).withColumns({"pc1": pc[0], "pc2": pc[1]}).drop("_pc", _VECTOR)
