"""Clustering: k-means with the best of several starts, its cost by number of clusters, assignment to given centres."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fits that run at the same time.
AT_ONCE = 8


def assembled(df: DataFrame, columns: Sequence[str], to: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=to, handleInvalid="skip").transform(df)


def points(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(features, weight): the distinct points with how often each comes, dealt to all cores whatever the files' layout."""
    x = [F.col(c).cast("double") for c in columns]
    distinct = df.select(*[v.alias(c) for v, c in zip(x, columns, strict=True)]).groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return assembled(distinct.repartition(cores, *columns), columns).select("features", "weight")


def fitted(df: DataFrame, columns: Sequence[str], tries: Sequence[tuple[int, int]], max_iter: int = 300) -> list[KMeansModel]:
    """A model for each (k, seed), several of them at a time, as their many short jobs leave cores idle."""
    rows = points(df, columns).cache()
    try:
        rows.count()
        fit = lambda t: KMeans(k=t[0], maxIter=max_iter, seed=t[1], weightCol="weight").fit(rows)
        with ThreadPool(AT_ONCE) as pool:
            return pool.map(inheritable_thread_target(df.sparkSession)(fit), tries, chunksize=1)
    finally:
        rows.unpersist()


def kmeans(df: DataFrame, columns: Sequence[str], k: int, starts: int = 3, seed: int = 42, max_iter: int = 300) -> KMeansModel:
    """The model of the least cost over several seeds."""
    return min(fitted(df, columns, [(k, seed + s) for s in range(starts)], max_iter), key=lambda m: m.summary.trainingCost)


def single_cost(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The cost of one cluster: n times the sum of population variances."""
    x = [F.col(c).cast("double") for c in columns]
    return df.agg((F.count(F.lit(1)) * sum((F.var_pop(c) for c in x), F.lit(0.0))).alias("cost"))


def elbow(df: DataFrame, columns: Sequence[str], ks: Sequence[int], starts: int = 3, seed: int = 42) -> DataFrame:
    """(k, cost) for each number of clusters from 1."""
    tries = [(k, seed + s) for k in ks if k > 1 for s in range(starts)]
    found = [(k, float(m.summary.trainingCost)) for (k, _), m in zip(tries, fitted(df, columns, tries), strict=True)] if tries else []
    costs = [(k, min(c for j, c in found if j == k)) for k in ks if k > 1]
    rows = df.sparkSession.createDataFrame(costs, "k int, cost double")
    return single_cost(df, columns).select(F.lit(1).alias("k"), "cost").unionByName(rows) if 1 in ks else rows


def assign(df: DataFrame, columns: Sequence[str], centres: Sequence[Sequence[float]]) -> DataFrame:
    """Adds cluster (the nearest of the given centres, the first of ties) and distance2, within each row."""
    far = [sum(((F.col(c).cast("double") - float(v)) * (F.col(c).cast("double") - float(v)) for c, v in zip(columns, centre, strict=True)), F.lit(0.0)) for centre in centres]
    nearest = F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(k).alias("k")) for k, d in enumerate(far)]))
    return df.withColumn("__near", nearest).withColumn("cluster", F.col("__near.k")).withColumn("distance2", F.col("__near.d")).drop("__near")
