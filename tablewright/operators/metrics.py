"""Measures of predictions: regression errors, confusion matrix, report, threshold, ROC curve and AUC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """mse, rmse, mae and r2 (against the mean of the evaluated values) in one pass."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    one = df.agg(F.avg(F.pow(y - p, 2)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"), F.var_pop(y).alias("__v"))
    return one.select("mse", F.sqrt("mse").alias("rmse"), "mae", F.when(F.col("__v") > 0, 1 - F.col("mse") / F.col("__v")).alias("r2"))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"))


def thresholded(score: Column, threshold: float) -> Column:
    return F.when(score > threshold, 1).otherwise(0)


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(actual, predicted, n) for all pairs of labels, those that don't occur included."""
    counts = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    labels = counts.select(F.col("actual").alias("l")).union(counts.select("predicted")).dropna().distinct()
    cells = labels.select(F.col("l").alias("actual")).crossJoin(labels.select(F.col("l").alias("predicted")))  # labels squared
    return cells.join(counts, ["actual", "predicted"], "left").fillna(0, ["n"])


def report(df: DataFrame, actual: str, predicted: str, zero_division: float = 0.0) -> DataFrame:
    """(label, precision, recall, f1, support) by label, then "macro avg" and "weighted avg"."""
    cells = confusion(df, actual, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    by_actual = cells.groupBy(F.col("actual").alias("l")).agg(F.sum("n").alias("support"), F.sum(hit).alias("tp"))
    by_predicted = cells.groupBy(F.col("predicted").alias("l")).agg(F.sum("n").alias("said"))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(zero_division)
    rows = by_actual.join(by_predicted, "l").select(F.col("l").cast("string").alias("label"), share(F.col("tp"), F.col("said")).alias("precision"), share(F.col("tp"), F.col("support")).alias("recall"), "support")
    both = F.col("precision") + F.col("recall")
    rows = rows.select("label", "precision", "recall", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0).alias("f1"), "support")
    macro = rows.agg(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")], F.sum("support").alias("support"))
    weighted = rows.agg(F.lit("weighted avg").alias("label"), *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in ("precision", "recall", "f1")], F.sum("support").alias("support"))
    return rows.unionByName(macro).unionByName(weighted)


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg) of each distinct score."""
    y = F.col(label)
    return df.dropna(subset=[label, score]).groupBy(F.col(score).alias("score")).agg(F.sum((y == 1).cast("long")).alias("pos"), F.sum((y == 0).cast("long")).alias("neg"))


def with_counts_above(counts: DataFrame, bucket: Column) -> DataFrame:
    """Adds tp and fp: positives and negatives with a score at least as high.

    bucket must rise with the score: sums run within buckets, and over the few buckets' totals.
    """
    df = counts.withColumn("__b", bucket)
    order = Window.partitionBy("__b").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    above = Window.orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("__b").agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    before = totals.select("__b", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}0") for c in ("__p", "__n")])
    return df.join(before, "__b").select("score", "pos", "neg", (F.sum("pos").over(order) + F.col("__p0")).alias("tp"), (F.sum("neg").over(order) + F.col("__n0")).alias("fp"))


def score_bucket(score: str = "score", parts: int = 1024) -> Column:
    """Buckets of scores between 0 and 1; others fall in the first or the last."""
    return F.least(F.greatest(F.floor(F.col(score) * parts), F.lit(0)), F.lit(parts)).cast("int")


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr), a point for each distinct score, and the origin with an infinite threshold."""
    counts = with_counts_above(score_counts(df, label, score), score_bucket())
    total = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    points = counts.crossJoin(F.broadcast(total)).select(F.col("score").alias("threshold"), (F.col("fp") / F.col("n")).alias("fpr"), (F.col("tp") / F.col("p")).alias("tpr"))
    origin = df.sparkSession.sql("SELECT double('Infinity') AS threshold, 0D AS fpr, 0D AS tpr")
    return points.unionByName(origin)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """The chance that a positive outscores a negative, ties counting half."""
    counts = with_counts_above(score_counts(df, label, score), score_bucket())
    # Of each score's negatives, positives above count whole, those of the same score half.
    wins = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return counts.agg((wins / (F.sum("pos") * F.sum("neg"))).alias("auc"))
