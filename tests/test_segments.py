"""Segment queries have no SQL that says the same; they are held to what must be true of them."""

import os

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

import __spark_entry__  # noqa: F401 (registers the queries)
from gridmill.operators import segment
from gridmill.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture
def fits(monkeypatch):
    """(k, seed, cost) of each KMeans that is fitted."""
    made = []

    class Spy(segment.KMeans):
        def _fit(self, dataset):
            model = super()._fit(dataset)
            made.append((self.getK(), self.getSeed(), model.summary.trainingCost))
            return model

    monkeypatch.setattr(segment, "KMeans", Spy)
    return made


def seeds_of(fits, k):
    return sorted(seed for of, seed, _ in fits if of == k)


def least(fits, k):
    return min(cost for of, _, cost in fits if of == k)


def test_best_of_ten_starts(spark, fits):
    points = [(i, Vectors.dense(10.0 * (i % 7), float(i % 3))) for i in range(84)]
    df = spark.createDataFrame(points, ["id", "features"])
    model = segment.best_kmeans(df, 7)
    assert seeds_of(fits, 7) == list(range(42, 52))
    assert model.summary.trainingCost == least(fits, 7)


@given
def test_kmeans_query_takes_ten_starts(spark, fits):
    assert {r.cluster for r in QUERIES["M5_kmeans"](spark, FOLDER).collect()} == set(range(4))
    assert seeds_of(fits, 4) == list(range(42, 52))


@given
def test_elbow_sweeps_to_nine(spark, fits):
    cost = {r.k: r.cost for r in QUERIES["M6_elbow"](spark, FOLDER).collect()}
    assert list(cost) == list(range(1, 10)) and sorted(cost.values(), reverse=True) == list(cost.values())
    for k in range(2, 10):
        assert seeds_of(fits, k) == list(range(42, 52)) and cost[k] == least(fits, k)


@given
def test_silhouette_sweeps_to_seven(spark, fits):
    found = {r.k: r.silhouette for r in QUERIES["M7_silhouette"](spark, FOLDER).collect()}
    assert list(found) == list(range(2, 8)) and all(-1 <= x <= 1 for x in found.values())
    assert all(seeds_of(fits, k) == list(range(42, 52)) for k in range(2, 8))


@given
def test_kept_components_are_clustered(spark):
    features = np.array([r.features for r in QUERIES["M3_encoded"](spark, FOLDER).collect()])
    rows = QUERIES["M8_kept_components"](spark, FOLDER).collect()
    kept = np.array([r.components for r in rows])
    shares = np.sort(np.linalg.eigvalsh(np.cov(features.T)))[::-1]
    assert kept.shape == (len(features), np.searchsorted(np.cumsum(shares) / shares.sum(), 0.95) + 1)
    assert kept.var(axis=0, ddof=1) == pytest.approx(shares[: kept.shape[1]], abs=1e-4)
    clusters = np.array([r.cluster for r in rows])
    assert set(clusters) == set(range(5))
    # Every row lies in the cluster whose mean is nearest.
    means = np.array([kept[clusters == c].mean(axis=0) for c in range(5)])
    distance = ((kept[:, None] - means) ** 2).sum(axis=2)
    assert (distance[np.arange(len(kept)), clusters] <= distance.min(axis=1) + 1e-3).all()


@given
def test_component_clusters_are_nearest(spark):
    cluster = {r.c_custkey: r.cluster for r in QUERIES["M4_component_clusters"](spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/customer.parquet").select("c_custkey", "c_nationkey", "c_acctbal").toPandas()
    z = rows[["c_nationkey", "c_acctbal"]].astype(float).to_numpy()
    z = (z - z.mean(axis=0)) / z.std(axis=0, ddof=1)  # turning to components keeps distances
    of = rows["c_custkey"].map(cluster).to_numpy()
    assert set(of) == set(range(5)) and len(cluster) == len(rows)
    distance = ((z[:, None] - np.array([z[of == c].mean(axis=0) for c in range(5)])) ** 2).sum(axis=2)
    # One start of at most twenty rounds: all but a few rows at borders lie nearest their own mean.
    assert (distance[np.arange(len(z)), of] <= distance.min(axis=1) + 1e-2).mean() > 0.97


def test_fits_read_different_points_once(spark, monkeypatch):
    """A fit's passes read each different point once, with its weight; costs and silhouettes count all rows."""
    sizes, real = [], segment.KMeans

    class Spy(real):
        def _fit(self, dataset):
            sizes.append(dataset.count())
            return super()._fit(dataset)

    monkeypatch.setattr(segment, "KMeans", Spy)
    spots = [(10.0 * (i % 3), float(i % 2)) for i in range(6)]
    df = spark.createDataFrame([(Vectors.dense(*spots[i % 6 if i < 60 else 0]),) for i in range(90)], ["features"])
    x = np.array([spots[i % 6 if i < 60 else 0] for i in range(90)])
    cost = {r.k: r.cost for r in segment.elbow(df, range(1, 4), starts=3).collect()}
    assert set(sizes) == {6}
    assert cost[1] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())
    of = (x[:, 0] / 10).astype(int)
    assert cost[3] == pytest.approx(sum(((x[of == c] - x[of == c].mean(axis=0)) ** 2).sum() for c in range(3)))


@pytest.fixture
def parts(spark, monkeypatch):
    """Number of partitions that each fit reads, with many shuffle partitions."""
    found, real, before = [], segment.KMeans, spark.conf.get("spark.sql.shuffle.partitions")

    class Spy(real):
        def _fit(self, dataset):
            found.append(dataset.rdd.getNumPartitions())
            return super()._fit(dataset)

    monkeypatch.setattr(segment, "KMeans", Spy)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    yield found
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_elbow_passes_go_by_points(spark, parts, monkeypatch):
    """A pass has a task for each TASK_POINTS different points, not for each shuffle partition; costs stay."""
    x = np.array([(float(i % 30), float(i % 2 * 50)) for i in range(300)])
    df = spark.createDataFrame([(Vectors.dense(*p),) for p in x.tolist()], ["features"])
    cost = [r.cost for r in segment.elbow(df, [1, 2], starts=2).collect()]
    assert parts == [1, 1]
    monkeypatch.setattr(segment, "TASK_POINTS", 8)  # 30 different points
    assert [r.cost for r in segment.elbow(df, [1, 2], starts=2).collect()] == pytest.approx(cost)
    assert parts[2:] == [4, 4]
    halves = [x[x[:, 1] == y] for y in (0, 50)]
    assert cost == pytest.approx([((x - x.mean(axis=0)) ** 2).sum(), sum(((h - h.mean(axis=0)) ** 2).sum() for h in halves)])


def test_silhouette_passes_go_by_points(spark, parts, monkeypatch):
    """As for the elbow; the silhouettes count all rows."""
    df = spark.createDataFrame([(Vectors.dense(float(i % 12 + i % 2 * 50)),) for i in range(120)], ["features"])
    found = {r.k: r.silhouette for r in segment.silhouettes(df, [2, 3], starts=2).collect()}
    assert parts == [1] * 4
    monkeypatch.setattr(segment, "TASK_POINTS", 5)  # 12 different points
    again = {r.k: r.silhouette for r in segment.silhouettes(df, [2, 3], starts=2).collect()}
    assert parts[4:] == [3] * 4 and again[2] == pytest.approx(found[2])
    x = np.array([i % 12 + i % 2 * 50 for i in range(120)], float)
    apart = (x[:, None] - x[None]) ** 2
    own = (x > 30)[:, None] == (x > 30)[None]
    a, b = (apart * own).sum(1) / (own.sum(1) - 1), (apart * ~own).sum(1) / (~own).sum(1)
    assert found[2] == pytest.approx(((b - a) / np.maximum(a, b)).mean())
    copies = spark.createDataFrame([(Vectors.dense(float(i % 2)),) for i in range(10)], ["features"])
    assert [r.silhouette for r in segment.silhouettes(copies, [2], starts=2).collect()] == [1.0]
