"""Models: Spark ML with parameters converted to what data scientists' libraries mean by them, and two exact ones in SQL.

Stand-ins, because Spark has no twin: a kernel SVM is a linear SVM on random Fourier or polynomial features, with
probabilities from a logistic fit of its margins; a recurrent network is a linear model on the window of past values.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, Imputer, OneHotEncoder, PolynomialExpansion, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def preprocessor(numeric: Sequence[str], categorical: Sequence[str], strategy: str = "mean", scaled: bool = True) -> Pipeline:
    """Imputed (and scaled) numbers beside one-hot categories, in features; unknown and null categories are all zeros."""
    filled = [f"{c}__filled" for c in numeric]
    stages = [Imputer(strategy=strategy, inputCols=list(numeric), outputCols=filled), VectorAssembler(inputCols=filled, outputCol="__numbers")]
    numbers = "__numbers"
    if scaled:
        stages.append(StandardScaler(inputCol="__numbers", outputCol="__scaled", withMean=True))
        numbers = "__scaled"
    parts = [numbers]
    if categorical:
        codes, hot = [f"{c}__code" for c in categorical], [f"{c}__hot" for c in categorical]
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=True))
        parts += hot
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol="features")])


def linear_regression(label: str = "label", **params) -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol=label, solver="normal", **params)


def line_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept of y on one x, by sums in one pass."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def logistic_regression(rows: int, c: float = 1.0, label: str = "label", max_iter: int = 200) -> LogisticRegression:
    """C weighs the sum of losses, Spark's penalty the mean, so that regParam is 1 / (C * rows)."""
    return LogisticRegression(featuresCol="features", labelCol=label, regParam=1 / (c * rows), elasticNetParam=0.0, standardization=False, maxIter=max_iter)


def linear_svm(label: str = "label", reg: float = 0.01, max_iter: int = 100) -> OneVsRest:
    return OneVsRest(classifier=LinearSVC(regParam=reg, maxIter=max_iter), featuresCol="features", labelCol=label)


def decision_tree(label: str = "label", seed: int = 42) -> DecisionTreeClassifier:
    """Depth 30 is the most that Spark grows."""
    return DecisionTreeClassifier(featuresCol="features", labelCol=label, maxDepth=30, seed=seed)


def random_forest(label: str = "label", trees: int = 100, depth: int = 12, seed: int = 42, **params) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, **params)


def forest_regressor(label: str = "label", trees: int = 100, depth: int = 12, leaf: int = 1, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=seed)


def boosted_trees(label: str = "label", rounds: int = 50, depth: int = 6, classes: int = 2, seed: int = 42) -> Estimator:
    trees = GBTClassifier(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed)
    return trees if classes == 2 else OneVsRest(classifier=trees, featuresCol="features", labelCol=label)


def fourier_features(columns: Sequence[str], n: int = 64, gamma: float = 1.0, seed: int = 42) -> list[str]:
    """SQL of columns rff0.. whose products approach the Gaussian kernel exp(-gamma * distance^2)."""
    rng = np.random.default_rng(seed)
    w, b = rng.normal(scale=np.sqrt(2 * gamma), size=(n, len(columns))), rng.uniform(0, 2 * np.pi, n)
    angle = lambda k: " + ".join([f"{b[k]:.17g}D", *(f"`{c}` * {w[k, j]:.17g}D" for j, c in enumerate(columns))])
    return [f"cos({angle(k)}) * {np.sqrt(2 / n):.17g}D AS rff{k}" for k in range(n)]


def kernel_svm(df: DataFrame, columns: Sequence[str], label: str, kernel: str = "rbf", gamma: float = 1.0, degree: int = 3, reg: float = 0.01, seed: int = 42, max_iter: int = 50) -> PipelineModel:
    """An approximate kernel SVM with probabilities; transform() wants the columns and adds prediction and probability."""
    if kernel == "rbf":
        made = fourier_features(columns, gamma=gamma, seed=seed)
        names = [f"rff{k}" for k in range(len(made))]
        stages = [SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__"), VectorAssembler(inputCols=names, outputCol="__kernel")]
    else:
        stages = [VectorAssembler(inputCols=list(columns), outputCol="__plain"), PolynomialExpansion(degree=degree, inputCol="__plain", outputCol="__kernel")]
    svm = LinearSVC(featuresCol="__kernel", labelCol=label, regParam=reg, maxIter=max_iter, predictionCol="__side", rawPredictionCol="__margin")
    platt = LogisticRegression(featuresCol="__margin", labelCol=label, maxIter=max_iter)
    return Pipeline(stages=[*stages, svm, platt]).fit(df)


def score_of(probability: str = "probability", of: int = 1) -> Column:
    return vector_to_array(probability)[of]


def gaussian_nb(df: DataFrame, features: Sequence[str], label: str, smoothing: float = 1e-9) -> DataFrame:
    """One row for each class: its share, and mean and variance of each feature (plus smoothing times the largest variance)."""
    x = {c: F.col(c).cast("double") for c in features}
    whole = df.agg(F.greatest(*[F.var_pop(v) for v in x.values()], F.lit(0.0)).alias("__v"), F.count(F.lit(1)).alias("__n"))
    by_class = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("__k"), *[F.avg(x[c]).alias(f"mean_{c}") for c in features], *[F.var_pop(x[c]).alias(f"var_{c}") for c in features])
    return by_class.crossJoin(F.broadcast(whole)).select("class", (F.col("__k") / F.col("__n")).alias("prior"), *[f"mean_{c}" for c in features], *[(F.col(f"var_{c}") + smoothing * F.col("__v")).alias(f"var_{c}") for c in features])


def gaussian_nb_predict(df: DataFrame, key: str, features: Sequence[str], classes: DataFrame) -> DataFrame:
    """(key, predicted): the class of the greatest log likelihood, the smallest of ties. Classes are a few rows."""
    terms = [-0.5 * (F.log(2 * F.pi() * F.col(f"var_{c}")) + F.pow(F.col(c).cast("double") - F.col(f"mean_{c}"), 2) / F.col(f"var_{c}")) for c in features]
    scored = df.select(key, *features).crossJoin(classes).select(key, "class", sum(terms, F.log("prior")).alias("__ll"))
    return scored.groupBy(key).agg(F.max(F.struct("__ll", (-F.col("class")).alias("c"))).alias("m")).select(key, (-F.col("m.c")).alias("predicted"))


def vote(found: DataFrame, k: int) -> DataFrame:
    """(query, predicted): the commonest label of the first k neighbours, the smallest of ties."""
    counts = found.where(F.col("place") <= k).groupBy("query", "label").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("query").agg(F.max(F.struct("n", (-F.col("label")).alias("l"))).alias("m")).select("query", (-F.col("m.l")).cast("int").alias("predicted"))


def pca(columns: Sequence[str], k: int) -> Pipeline:
    """Centred principal components in column components."""
    return Pipeline(stages=[VectorAssembler(inputCols=list(columns), outputCol="__plain"), StandardScaler(inputCol="__plain", outputCol="__centred", withMean=True, withStd=False), PCA(k=k, inputCol="__centred", outputCol="components")])


def grid(estimator: Estimator, values: Mapping[str, Sequence]) -> list:
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


def cross_validated(df: DataFrame, pipeline: Pipeline, params: list, label: str = "label", folds: int = 2, seed: int = 42, metric: str = "accuracy", parallelism: int = 2):
    """The best model, refitted on all rows."""
    evaluator = BinaryClassificationEvaluator(labelCol=label) if metric == "auc" else MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    return CrossValidator(estimator=pipeline, estimatorParamMaps=params, evaluator=evaluator, numFolds=folds, seed=seed, parallelism=parallelism).fit(df)


def searched(train: DataFrame, valid: DataFrame, make, values: Mapping[str, Sequence], evaluate, parallel: int = 4) -> Iterator[tuple[dict, float]]:
    """Yields (parameters, score on valid) in order, parallel fits at a time; the caller refits the best. Scores never come from train."""
    points = [dict(zip(values, choice)) for choice in product(*values.values())]
    with ThreadPoolExecutor(parallel) as pool:
        yield from zip(points, pool.map(lambda p: evaluate(make(**p).fit(train).transform(valid)), points))


def sized(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """df in as many partitions as its rows call for, so that the many short jobs of a fit aren't all scheduling."""
    return df.coalesce(max(1, -(-df.count() // rows)))


def each_of(points: Sequence, evaluate, parallel: int = 4) -> list:
    """evaluate(point) of each point, in order."""
    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(evaluate, points))


def window_regression(windows: DataFrame, size: int) -> Pipeline:
    """A linear model of the target on the size values before it."""
    names = [f"lag{k}" for k in range(size)]
    statement = "SELECT *, " + ", ".join(f"window[{k}] AS lag{k}" for k in range(size)) + " FROM __THIS__"
    return Pipeline(stages=[SQLTransformer(statement=statement), VectorAssembler(inputCols=names, outputCol="features"), LinearRegression(featuresCol="features", labelCol="target", regParam=1e-6)])
