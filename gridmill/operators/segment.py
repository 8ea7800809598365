"""Segmentation: imputation, encoding, scaling, components, clusters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from math import ceil

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.operators import sweep
from gridmill.operators.dedupe import average_rank
from gridmill.operators.quantiles import modes, value_counts, wide_quantiles
from gridmill.sources.tables import scratch_folder

#: Starts of each clustering, of which the one of lowest cost counts.
STARTS = 10
#: Fits that run beside each other, more where their tasks leave cores idle; each is many short jobs.
_FITS = 6
#: Points that a task of a fit reads in each pass: enough to outweigh the start of a task.
TASK_POINTS = 50_000


def impute(df: DataFrame, key: str) -> DataFrame:
    """Texts take their mode (the smallest on ties), numbers their median, as subqueries of one
    row: nothing runs while the plan is built."""
    texts = [f.name for f in df.schema.fields if f.name != key and isinstance(f.dataType, T.StringType)]
    numbers = [f.name for f in df.schema.fields if f.name != key and isinstance(f.dataType, T.NumericType)]
    filled = {}
    if texts:
        tops = modes(value_counts(df, texts)).groupBy().agg(*[F.max(F.when(F.col("column") == c, F.col("top"))).alias(c) for c in texts])
        filled |= {c: F.coalesce(c, tops.select(c).scalar()) for c in texts}
    if numbers:
        medians = wide_quantiles(df, {c: (c, 0.5) for c in numbers})
        filled |= {c: F.coalesce(c, medians.select(c).scalar().cast(df.schema[c].dataType)) for c in numbers}
    return df.withColumns(filled)


def label_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """Codes of the values in alphabetical order."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn(out, (F.row_number().over(Window.orderBy(column)) - 1).cast("int"))
    return df.join(values, column, "left")


def encoder(texts: Sequence[str], numbers: Sequence[str]) -> Pipeline:
    """One-hot texts and numbers, standardised, in ``features``."""
    coded, hot = [f"{c}_code" for c in texts], [f"{c}_hot" for c in texts]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(texts), outputCols=coded, stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=coded, outputCols=hot, dropLast=False, handleInvalid="keep"),
        VectorAssembler(inputCols=[*hot, *numbers], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True),
    ])


def component_clusters(numbers: Sequence[str], k: int = 5, components: int = 2, seed: int = 42) -> Pipeline:
    filled = [f"{c}_filled" for c in numbers]
    return Pipeline(stages=[
        Imputer(strategy="median", inputCols=list(numbers), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True),
        PCA(k=components, inputCol="scaled", outputCol="features"),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster"),
    ])


def _different(df: DataFrame, features: str = "features") -> DataFrame:
    """The different points, and how often each stands, in ``weight``: what every pass of a fit
    reads. Points of equal weight in sum give the same centres and costs."""
    counted = df.select(vector_to_array(F.col(features)).alias("_x")).groupBy("_x").agg(F.count("*").cast("double").alias("weight"))
    return counted.select(array_to_vector("_x").alias(features), "weight")


@contextmanager
def _held(df: DataFrame, features: str = "features") -> Iterator[DataFrame]:
    """:func:`_different` points, cached in partitions of ``TASK_POINTS`` whatever the session's
    number of shuffle partitions: a fit takes dozens of passes, and each starts a task for every
    partition. They are stored, for their number, and again as dealt: what is cached from a
    shuffle is planned adaptively by every fit, with jobs and threads of the driver for each."""
    spark = df.sparkSession
    counted, dealt = scratch_folder(spark, "points"), scratch_folder(spark, "points")
    _different(df, features).write.parquet(counted)
    stored = spark.read.parquet(counted)
    stored.repartition(max(1, ceil(stored.count() / TASK_POINTS))).sortWithinPartitions(vector_to_array(features)).write.parquet(dealt)
    rows = spark.read.parquet(dealt).persist()
    try:
        rows.count()
        yield rows
    finally:
        rows.unpersist()


def _best_of(rows: DataFrame, ks: Sequence[int], seed: int, starts: int, features: str = "features") -> dict:
    """For each k the model of lowest cost of several starts, the first seed's on ties. ``rows``
    are :func:`_held` points. Blocks of points give the costs that single ones give, sooner."""

    def fit(task):
        return KMeans(k=task[0], seed=task[1], featuresCol=features, weightCol="weight", predictionCol="cluster", solver="block").fit(rows)

    tasks = [(k, seed + i) for k in ks for i in range(starts)]
    with ThreadPoolExecutor(max(_FITS, rows.sparkSession.sparkContext.defaultParallelism // rows.rdd.getNumPartitions())) as pool:
        # Wrapped one by one: what is wrapped once shares its local properties between threads.
        running = [pool.submit(inheritable_thread_target(rows.sparkSession)(fit), task) for task in tasks]
        models = [r.result() for r in running]
    return {k: min((m for (of, _), m in zip(tasks, models) if of == k), key=lambda m: m.summary.trainingCost) for k in ks}


def best_kmeans(df: DataFrame, k: int, seed: int = 42, starts: int = STARTS, features: str = "features"):
    """The best of several starts by cost."""
    with _held(df, features) as rows:
        return _best_of(rows, [k], seed, starts, features)[k]


def total_variance(df: DataFrame) -> float:
    """The cost of one cluster, which KMeans does not take: squared distances of weighted points
    from the mean."""
    values = df.select("weight", F.posexplode(vector_to_array("features")).alias("i", "x"))
    means = values.groupBy("i").agg((F.sum(F.col("weight") * F.col("x")) / F.sum("weight")).alias("mean"))
    return values.join(F.broadcast(means), "i").agg(F.sum(F.col("weight") * F.pow(F.col("x") - F.col("mean"), 2))).first()[0]


def elbow(df: DataFrame, ks: Sequence[int], seed: int = 42, starts: int = STARTS) -> DataFrame:
    with _held(df) as rows:
        best = _best_of(rows, [k for k in ks if k > 1], seed, starts)
        costs = [(k, float(total_variance(rows) if k == 1 else best[k].summary.trainingCost)) for k in ks]
    return df.sparkSession.createDataFrame(costs, "k int, cost double")


def silhouettes(df: DataFrame, ks: Sequence[int], seed: int = 42, starts: int = STARTS) -> DataFrame:
    """Mean silhouette of each k's best model over all rows. ClusteringEvaluator would leave out all
    copies of a point, not only the point itself, from its own cluster's distances."""
    with _held(df) as rows:
        best = _best_of(rows, ks, seed, starts)
        points = rows.select(vector_to_array("features").alias("x"), "weight", F.lit(0).cast("long").alias("draw"))
        values = sweep.silhouettes(points, [sweep.Model(k, seed, np.array(m.clusterCenters())) for k, m in best.items()])
    return df.sparkSession.createDataFrame(list(zip(best, values)), "k int, silhouette double")


def components_for(df: DataFrame, share: float = 0.95) -> DataFrame:
    """Components that keep ``share`` of the variance, in ``components``."""
    width = len(df.select("features").first()["features"])
    kept, n = 0.0, 0
    for x in PCA(k=width, inputCol="features", outputCol="_").fit(df).explainedVariance:
        kept, n = kept + float(x), n + 1
        if kept >= share:
            break
    return PCA(k=max(1, n), inputCol="features", outputCol="components").fit(df).transform(df)


def spread_ranking(clustered: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """Features by how far the clusters' means lie apart."""
    centres = clustered.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns])
    spread = centres.agg(*[F.stddev_samp(c).alias(c) for c in columns])
    rows = spread.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("spread")) for c in columns])))
    return rows.withColumn("rank", average_rank(F.col("spread")))


def profile(clustered: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    return clustered.groupBy(cluster).agg(F.count("*").alias("n"), *[F.mode(c, True).alias(c) for c in columns])


def weighted(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.col(c) * w for c, w in weights.items()})
