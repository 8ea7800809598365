"""The batched k-means against plain numpy and against Spark's own costs and silhouettes."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.linalg import Vectors

from gridmill.operators import sweep


@pytest.fixture(scope="module")
def points():
    random = np.random.default_rng(5)
    middles = random.normal(0, 8, (5, 3))
    x = np.round(np.vstack([random.normal(m, 1.0, (120, 3)) for m in middles]), 2)
    return np.vstack([x, x[:200], np.zeros((150, 3))])  # copies too


@pytest.fixture(scope="module")
def frame(spark, points):
    return spark.createDataFrame([(Vectors.dense(p),) for p in points.tolist()], ["features"])


def lloyd(x, centres, iterations=sweep.ITERATIONS):
    for _ in range(iterations):
        label = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[label == j].mean(0) if (label == j).any() else c for j, c in enumerate(centres)])
        moved = np.sqrt(((new - centres) ** 2).sum(1)).max()
        centres = new
        if moved <= sweep.TOLERANCE:
            break
    return centres, ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


def test_all_models_are_those_of_separate_fits(spark, frame, points):
    ks, starts = [1, 2, 3, 5], [42, 43, 44]
    models, seen = sweep.train(frame, ks, starts)
    assert [(m.k, m.start) for m in models] == [(k, s) for k in ks for s in starts]
    assert seen.agg({"weight": "sum"}).first()[0] == len(points)
    first = sweep._starts(seen, 5, starts)
    for m in models:
        centres, cost = lloyd(points, first[m.start][: m.k])
        assert np.allclose(m.centres, centres) and m.cost == pytest.approx(cost)
        alone = sweep.train(frame, [m.k], [m.start])[0][0] if m.k in (1, 5) else m
        assert np.allclose(alone.centres, m.centres) and alone.cost == pytest.approx(m.cost)
    again = sweep.train(frame.repartition(7), ks, starts)[0]
    assert [m.cost for m in again] == pytest.approx([m.cost for m in models])


def test_elbow_is_as_low_as_sparks(frame):
    cost = {r.k: r.cost for r in sweep.elbow(frame, [1, 2, 3, 4, 5, 6], range(42, 52)).collect()}
    assert list(cost.values()) == sorted(cost.values(), reverse=True)
    spark_cost = min(KMeans(k=5, seed=s).fit(frame).summary.trainingCost for s in (42, 43, 44))
    assert cost[5] <= spark_cost * 1.001


def test_silhouettes_are_sparks(spark, frame):
    models, seen = sweep.train(frame, [2, 5], [42])
    values = sweep.silhouettes(seen, models)
    for m, s in zip(models, values):
        java = spark._jvm.org.apache.spark.mllib.clustering.KMeansModel
        vectors = spark._jvm.java.util.ArrayList()
        for c in m.centres.tolist():
            vectors.add(spark._jvm.org.apache.spark.mllib.linalg.Vectors.dense(c[0], spark._jvm.PythonUtils.toSeq(c[1:])))
        own = KMeansModel(spark._jvm.org.apache.spark.ml.clustering.KMeansModel("m", java(vectors)))
        assert s == pytest.approx(ClusteringEvaluator(predictionCol="prediction").evaluate(own.transform(frame)), abs=1e-9)


def test_few_points(spark):
    two = spark.createDataFrame([(Vectors.dense([0.0]),), (Vectors.dense([0.0]),), (Vectors.dense([4.0]),)], ["features"])
    cost = {r.k: r.cost for r in sweep.elbow(two, [1, 2, 3], [1]).collect()}
    assert cost == {1: pytest.approx(32 / 3), 2: 0.0, 3: 0.0}
    assert [r.silhouette for r in sweep.silhouette_sweep(two, [2], [1]).collect()] == [pytest.approx(2 / 3)]
    assert sweep.elbow(two.limit(0), [1, 2], [1]).count() == 0
