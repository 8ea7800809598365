"""K-means for many k and many starts at once.

Equal points are counted first. Then each step is one scan of the points for all models
together: the choice of the next centre of every start, an iteration of Lloyd's algorithm
for every (k, start) that still moves, the costs, the silhouettes. A task adds up sums by
centre in arrays, and a sum over tasks by centre gives the next centres; the driver holds
centres only, which ``ks``, ``starts`` and the number of features bound.

A start draws its centres one by one, each point in proportion to its squared distance
from those drawn: every point gets an arrival time of that rate from a hash, and the
earliest is taken. So a start is the same in every run, and a smaller k's centres are the
first ones of a larger k's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.sources.tables import scratch_folder

#: Iterations at most, and the distance below which a centre stands still: what KMeans has.
ITERATIONS, TOLERANCE = 20, 1e-4


@dataclass
class Model:
    k: int
    start: int
    centres: np.ndarray
    cost: float = 0.0
    iterations: int = 0
    moving: bool = True


def _points(df: DataFrame, features: str) -> DataFrame:
    """x, weight, draw: the different points, how often each stands, and a number of its own."""
    x = vector_to_array(F.col(features)).alias("x")
    path = scratch_folder(df.sparkSession, "points")
    df.select(x).groupBy("x").agg(F.count("*").cast("double").alias("weight")).withColumn("draw", F.xxhash64("x")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for f in frames:
        if len(f):
            yield np.vstack(f["x"].to_numpy()), f["weight"].to_numpy(), f["draw"].to_numpy().view(np.uint64)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centres."""
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)[None, :], 0)


def _mixed(draw: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1] from hashes and a salt."""
    z = draw + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2**53 + 2**-54


def _summed(points: DataFrame, work: Callable[[Iterator[pd.DataFrame]], np.ndarray | None]) -> np.ndarray:
    """The sum over all tasks of the array that each makes of its points."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = work(frames)
        if out is not None:
            flat = out.ravel()
            yield pd.DataFrame({"place": np.arange(flat.size), "value": flat})

    rows = points.mapInPandas(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").toPandas()
    return rows["value"].to_numpy()


def _starts(points: DataFrame, k: int, starts: Sequence[int]) -> dict[int, np.ndarray]:
    """``k`` centres of every start, fewer where there are fewer points; a scan for each."""
    chosen: dict[int, np.ndarray] = {}
    for nth in range(k):

        def earliest(frames: Iterator[pd.DataFrame], nth: int = nth, chosen: dict = dict(chosen)) -> Iterator[pd.DataFrame]:
            best: dict[int, tuple[float, list[float]]] = {}
            for x, weight, draw in _blocks(frames):
                for s in starts:
                    rate = weight * (_squares(x, chosen[s]).min(1) if nth else 1.0)
                    with np.errstate(divide="ignore"):
                        time = np.where(rate > 0, -np.log(_mixed(draw, s * 1000 + nth)) / rate, np.inf)
                    i = int(time.argmin())
                    if time[i] < best.get(s, (np.inf, []))[0]:
                        best[s] = (float(time[i]), x[i].tolist())
            yield pd.DataFrame([(s, t, x) for s, (t, x) in best.items()], columns=["start", "time", "x"])

        found = points.mapInPandas(earliest, "start long, time double, x array<double>").groupBy("start").agg(F.min(F.struct("time", "x")).alias("m")).collect()
        for r in found:
            x = np.array([r["m"]["x"]])
            chosen[r["start"]] = np.vstack([chosen[r["start"]], x]) if r["start"] in chosen else x
    return chosen


def _labels(squares: np.ndarray, models: Sequence[Model]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each model, where its centres start, each point's centre, and its squared distance."""
    at = 0
    for m in models:
        own = squares[:, at : at + len(m.centres)]
        label = own.argmin(1)
        yield at, label, own[np.arange(len(own)), label]
        at += len(m.centres)


def _sums(points: DataFrame, models: Sequence[Model]) -> np.ndarray:
    """By centre: sums of each feature, the weight, the cost, the sum of squared norms."""
    centres = np.vstack([m.centres for m in models])
    width = centres.shape[1]

    def work(frames: Iterator[pd.DataFrame]) -> np.ndarray | None:
        out = None
        for x, weight, _ in _blocks(frames):
            out = np.zeros((len(centres), width + 3)) if out is None else out
            for at, label, square in _labels(_squares(x, centres), models):
                n = int(label.max()) + 1
                for j in range(width):
                    out[at : at + n, j] += np.bincount(label, weight * x[:, j], n)
                for j, v in enumerate((np.ones(len(x)), square, (x**2).sum(1))):
                    out[at : at + n, width + j] += np.bincount(label, weight * v, n)
        return out

    return _summed(points, work).reshape(len(centres), width + 3)


def train(df: DataFrame, ks: Sequence[int], starts: Sequence[int], features: str = "features", iterations: int = ITERATIONS, tolerance: float = TOLERANCE) -> tuple[list[Model], DataFrame]:
    """A model of every k and start, all trained side by side, and the points that they saw.
    An empty table has none."""
    points = _points(df, features)
    first = _starts(points, max(ks), starts)
    models = [Model(k, s, first[s][:k].copy()) for k in ks for s in starts if s in first]
    for _ in range(iterations):
        moving = [m for m in models if m.moving]
        if not moving:
            break
        sums, at = _sums(points, moving), 0
        for m in moving:
            own = sums[at : at + len(m.centres)]
            at += len(m.centres)
            weight = own[:, -3]
            new = np.where(weight[:, None] > 0, own[:, :-3] / np.maximum(weight, 1)[:, None], m.centres)  # a centre without points stays
            m.moving = bool(np.sqrt(((new - m.centres) ** 2).sum(1)).max() > tolerance)
            m.centres, m.iterations = new, m.iterations + 1
    if models:
        sums, at = _sums(points, models), 0
        for m in models:
            m.cost = float(sums[at : at + len(m.centres), -2].sum())
            at += len(m.centres)
    return models, points


def best(models: Sequence[Model]) -> dict[int, Model]:
    """Of each k the model of lowest cost, the first start's on ties."""
    out: dict[int, Model] = {}
    for m in models:
        if m.k not in out or m.cost < out[m.k].cost:
            out[m.k] = m
    return out


def silhouettes(points: DataFrame, models: Sequence[Model]) -> list[float]:
    """Mean silhouette of each model by squared distances, from each cluster's sums alone:
    two scans for all. A point that is alone in its cluster counts 0."""
    sums = _sums(points, models)
    mean, weight, norm = sums[:, :-3] / np.maximum(sums[:, -3:-2], 1), sums[:, -3], sums[:, -1]
    centres = np.vstack([m.centres for m in models])

    def work(frames: Iterator[pd.DataFrame]) -> np.ndarray | None:
        out = None
        for x, w, _ in _blocks(frames):
            out = np.zeros((len(models), 2)) if out is None else out
            # Mean squared distance of a point to a cluster's: |x|^2 - 2 x mean + mean of |y|^2.
            apart = (x**2).sum(1)[:, None] - 2 * x @ mean.T + (norm / np.maximum(weight, 1))[None, :]
            for i, (at, label, _) in enumerate(_labels(_squares(x, centres), models)):
                k = len(models[i].centres)
                rows, n = np.arange(len(x)), weight[at : at + k]
                own = apart[:, at : at + k]
                a = own[rows, label] * n[label] / np.maximum(n[label] - 1, 1)
                others = np.where(n[None, :] > 0, own, np.inf)
                others[rows, label] = np.inf
                b = others.min(1) if k > 1 else np.full(len(x), np.inf)
                with np.errstate(invalid="ignore", divide="ignore"):
                    s = np.where((n[label] > 1) & np.isfinite(b) & (np.maximum(a, b) > 0), (b - a) / np.maximum(a, b), 0.0)
                out[i] += (w * s).sum(), w.sum()
        return out

    found = _summed(points, work).reshape(len(models), 2)
    return (found[:, 0] / np.maximum(found[:, 1], 1)).tolist()


def elbow(df: DataFrame, ks: Sequence[int], starts: Sequence[int], features: str = "features") -> DataFrame:
    """k, cost of the best start."""
    found = best(train(df, ks, starts, features)[0])
    return df.sparkSession.createDataFrame([(k, m.cost) for k, m in sorted(found.items())], "k int, cost double")


def silhouette_sweep(df: DataFrame, ks: Sequence[int], starts: Sequence[int], features: str = "features") -> DataFrame:
    """k, silhouette of the best start."""
    models, points = train(df, ks, starts, features)
    found = [m for _, m in sorted(best(models).items())]
    values = silhouettes(points, found) if found else []
    return df.sparkSession.createDataFrame([(m.k, s) for m, s in zip(found, values)], "k int, silhouette double")
