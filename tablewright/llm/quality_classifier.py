"""Quality classifier: scores learned from preference pairs by the Bradley-Terry model.

The chance that document a is better than document b is the logistic function of the difference of their scores, which
are linear in a few features of the whole text. Weights are learned from pairs of a good and a bad labelled document by
logistic loss on feature differences; the score that becomes THRESHOLD is the quantile of the labelled scores below
which the share of bad documents lies.

Features are Spark expressions within each row, so scoring is one pass without a shuffle. The sample that the driver
learns from has at most MAX_LABELLED documents, chosen by a hash of their ids.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, staged
from .quality_rules import CLASSES, text_counts

THRESHOLD = 0.7
MAX_LABELLED = 20_000
PAIRS = 100_000
PENALTY = 1e-3
FEATURES = (*(f"share_{name}" for name in CLASSES), "word_length", "log_words", "repeated", "stuttered", "line_copies")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def with_features(documents: DataFrame, keep: list[str]) -> DataFrame:
    """keep and __features: an array of doubles, from 0 to about 1, all 0 for an empty text."""
    df = text_counts(documents, keep)
    chars, words = F.length("__text"), F.col("n_words")
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(0.0)
    stuttered = F.size(F.filter("__words", lambda w, i: F.coalesce(w == F.get("__words", i - 1), F.lit(False))))
    values = [
        *[share(F.col("__classes")[k], chars) for k in range(len(CLASSES))],
        F.least(share(F.col("word_chars"), words) / 20, F.lit(1.0)),
        F.log1p(words) / 10,
        share(F.col("n_repeat_words"), words),
        share(stuttered, words),
        share(F.col("n_dup_lines"), F.col("n_dup_lines") + 10),
    ]
    return df.select(*keep, F.array(*[v.cast("double") for v in values]).alias("__features"))


@dataclass
class Ranking:
    """Weights of the features, and the score's value at which documents are taken for good."""

    weights: np.ndarray
    cut: float

    def score(self, features: Column) -> Column:
        if not self.weights.any():
            return F.lit(1.0)
        raw = sum((features[k] * float(w) for k, w in enumerate(self.weights)), F.lit(0.0))
        return 1 / (1 + F.exp(-(raw - float(self.cut) + float(np.log(THRESHOLD / (1 - THRESHOLD))))))


def bradley_terry(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, penalty: float = PENALTY, seed: int = 0) -> Ranking:
    """Learns from rows x of features with labels y (1: better); without both labels every document scores 1."""
    good, bad = x[y == 1], x[y == 0]
    if not len(good) or not len(bad):
        return Ranking(np.zeros(len(FEATURES)), 0.0)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 0.01)
    rng = np.random.default_rng(seed)
    # As many of the rarer label as of the other, each document about as often as the others of its label.
    better, worse = rng.integers(len(good), size=pairs), rng.integers(len(bad), size=pairs)
    d = (good[better] - bad[worse]) / scale
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(np.clip(d @ w, -50, 50)))  # of the wrong order
        gradient = penalty * w - d.T @ p / pairs
        step = np.linalg.solve(penalty * np.eye(len(w)) + (d * (p * (1 - p))[:, None]).T @ d / pairs, gradient)
        w -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    raw = np.sort(x @ (w / scale))
    k = len(bad)
    return Ranking(w / scale, float((raw[k - 1] + raw[min(k, len(raw) - 1)]) / 2))


def learn(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Ranking:
    """From labelled documents that are not held out; of a document with several labels the lowest counts."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.min("quality").alias("__y")).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_labelled)
    # Broadcast: at most max_labelled rows of two numbers.
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = with_features(sample, ["doc_id", "__y"]).groupBy("doc_id").agg(F.first("__y").alias("y"), F.max("__features").alias("x")).select("doc_id", "y", "x").toPandas().sort_values("doc_id")
    x = np.array(rows["x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return bradley_terry(x, rows["y"].to_numpy(dtype=int))


def quality_classifier(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """For each row of documents (doc_id, text): held_out, score and predicted (1 if score >= THRESHOLD, else 0).

    A null text is empty; it has features like any other. Where labels hold no document of either value, every score is
    1. A null doc_id isn't held out. Repeated rows give repeated results; only doc_id and text are read, and doc_id only
    to join labels and to hold out.
    """
    ranking = learn(documents, labels, max_labelled)
    # Written, as a filter on the result would otherwise be pushed below the features and compute them many times over.
    df = staged(with_features(documents.select("doc_id", "text"), ["doc_id"]))
    df = df.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), ranking.score(F.col("__features")).alias("score"))
    return df.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def good_documents(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of documents that the classifier predicts to be good, with their columns."""
    ranking = learn(documents, labels, max_labelled)
    # The document's own columns go along as one, whatever their names. The row number keeps the filter above the
    # features, which it would otherwise compute many times over.
    own = F.struct(*[named(c) for c in documents.columns]).alias("__own")
    df = with_features(documents.select(own, F.col("text").cast("string").alias("text")), ["__own"])
    df = df.withColumn("__row", F.monotonically_increasing_id())
    return df.where((F.col("__row") >= 0) & (ranking.score(F.col("__features")) >= THRESHOLD)).select("__own.*")
