"""Boosted trees of second order for any number of classes, by histograms of gradients.

Each round fits one tree a class to the softmax loss. Features are binned once by approximate quantiles; bin 0 holds
missing values. To grow all trees of a round by one level, every task adds up the first and second derivatives of its rows
by class, node, feature and bin; Spark adds the tasks' histograms and finds each node's best split by running sums over
bins, tried with missing values on either side. The driver sees one row a node. Trees are small arrays, sent with each
level; rows keep their margins in a staged table that is written anew every STAGED_ROUNDS rounds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import Staging
from .sums import matrix

STAGED_ROUNDS = 8
MAX_CLASSES = 256
#: Bins fit in a byte.
MAX_BINS = 255


@dataclass
class Tree:
    """Nodes as in a heap: the children of k are 2k + 1 and 2k + 2. A node without a feature is a leaf."""

    size: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    missing_left: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)

    def __post_init__(self):
        self.feature, self.cut = np.full(self.size, -1), np.zeros(self.size, int)
        self.missing_left, self.value = np.zeros(self.size, bool), np.zeros(self.size)

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        at, rows = np.zeros(len(bins), int), np.arange(len(bins))
        while True:
            inner = self.feature[at] >= 0
            if not inner.any():
                return at
            own = bins[rows, np.maximum(self.feature[at], 0)]
            left = np.where(own == 0, self.missing_left[at], own <= self.cut[at])
            at = np.where(inner, 2 * at + np.where(left, 1, 2), at)


@dataclass
class Boosted:
    classes: list
    bounds: list[np.ndarray]
    #: A list of trees, one a class, for each round.
    rounds: list[list[Tree]]

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return added(self.rounds, bins, np.zeros((len(bins), len(self.classes))))


def added(rounds: list[list[Tree]], bins: np.ndarray, margins: np.ndarray) -> np.ndarray:
    for trees in rounds:
        for c, tree in enumerate(trees):
            margins[:, c] += tree.value[tree.leaves(bins)]
    return margins


def binned(values: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    """Bin 0 for a missing value; otherwise 1 and the number of bounds below the value."""
    out = np.empty(values.shape, np.uint8)
    for j, own in enumerate(bounds):
        out[:, j] = np.where(np.isnan(values[:, j]), 0, 1 + np.searchsorted(own, values[:, j]))
    return out


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def derivatives(margins: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the softmax loss; the second as its upper bound, twice the diagonal."""
    p = softmax(margins)
    return p - (label[:, None] == np.arange(margins.shape[1])), np.maximum(2 * p * (1 - p), 1e-16)


def quantile_bounds(df: DataFrame, features: str, width: int, bins: int) -> list[np.ndarray]:
    """At most bins - 2 bounds for each feature."""
    x = lambda j: F.nullif(F.get(F.col(features), F.lit(j)).cast("double"), F.lit(float("nan")))
    row = df.agg(*[F.percentile_approx(x(j), [k / (bins - 1) for k in range(1, bins - 1)], 10_000).alias(f"b{j}") for j in range(width)]).first()
    return [np.unique(np.array(row[j] or [], float)) for j in range(width)]


def histograms(rows: DataFrame, width: int, bins: int, grown: list[list[Tree]], growing: list[Tree], open_nodes: list[list[int]]) -> DataFrame:
    """(class, node, feature, bin, g, h) of the open nodes of the trees that grow."""
    classes = len(growing)
    place = {(c, node): k for k, (c, node) in enumerate((c, node) for c in range(classes) for node in open_nodes[c])}
    names = np.array(list(place))
    number = np.full((classes, growing[0].size), -1)
    for (c, node), k in place.items():
        number[c, node] = k

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g_sum, h_sum = np.zeros(len(place) * width * bins), np.zeros(len(place) * width * bins)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, width)
            start = np.frombuffer(b"".join(batch.column(2).to_pylist())).reshape(-1, classes).copy()
            g, h = derivatives(added(grown, own, start), batch.column(1).to_numpy())
            for c in range(classes):
                node = number[c, growing[c].leaves(own)]
                mine = node >= 0
                at = ((node[mine, None] * width + np.arange(width)) * bins + own[mine]).ravel()
                g_sum += np.bincount(at, np.repeat(g[mine, c], width), len(g_sum))
                h_sum += np.bincount(at, np.repeat(h[mine, c], width), len(h_sum))
        held = np.flatnonzero(h_sum)
        which = names[held // (width * bins)].reshape(-1, 2)
        columns = [pa.array(x, pa.int32()) for x in (which[:, 0], which[:, 1], held // bins % width, held % bins)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(g_sum[held]), pa.array(h_sum[held])], names=["class", "node", "feature", "bin", "g", "h"])

    summed = rows.mapInArrow(count, "class int, node int, feature int, bin int, g double, h double")
    return summed.groupBy("class", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(counted: DataFrame, ridge: float, least_gain: float, least_weight: float) -> DataFrame:
    """For each class and node the best split: feature, cut (bins up to it go left), missing_left and both sides' sums; has_gain is false where none is worth it."""
    own = Window.partitionBy("class", "node", "feature")
    upto = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    missing = lambda x: F.sum(F.when(F.col("bin") == 0, F.col(x)).otherwise(0.0)).over(own)
    present = lambda x: F.sum(F.when(F.col("bin") > 0, F.col(x)).otherwise(0.0)).over(upto)
    df = counted.select("class", "node", "feature", "bin", *[f(x).alias(n + x) for x in ("g", "h") for n, f in (("all_", lambda x: F.sum(x).over(own)), ("no_", missing), ("to_", present))])
    sides = F.explode(F.array(F.lit(False), F.lit(True))).alias("missing_left")
    df = df.select("class", "node", "feature", "bin", "all_g", "all_h", "no_g", "no_h", "to_g", "to_h", sides)
    left = lambda x: F.col(f"to_{x}") + F.when(F.col("missing_left"), F.col(f"no_{x}")).otherwise(0.0)
    df = df.withColumns({"left_g": left("g"), "left_h": left("h")})
    part = lambda g, h: g * g / (h + ridge)
    g, h, lg, lh = (F.col(x) for x in ("all_g", "all_h", "left_g", "left_h"))
    gain = F.round((part(lg, lh) + part(g - lg, h - lh) - part(g, h)) / 2 - least_gain, 9)
    # Without missing values both sides give the same; the first is taken.
    able = (lh >= least_weight) & (h - lh >= least_weight) & (~F.col("missing_left") | (F.col("no_h") > 0)) & (F.col("bin") > 0)
    best = F.struct(F.when(able, gain).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), (~F.col("missing_left")).alias("right"), "left_g", "left_h", "all_g", "all_h")
    return df.groupBy("class", "node").agg(F.max(best).alias("x")).select("class", "node", (-F.col("x.f")).alias("feature"), (-F.col("x.b")).alias("cut"), (~F.col("x.right")).alias("missing_left"), F.coalesce(F.col("x.gain") > 0, F.lit(False)).alias("has_gain"), "x.left_g", "x.left_h", "x.all_g", "x.all_h")


def boost(df: DataFrame, features: str, label: str, rounds: int = 20, depth: int = 4, rate: float = 0.3, ridge: float = 1.0, least_gain: float = 0.0, least_weight: float = 1.0, bins: int = 64) -> Boosted:
    """A model of label by features (an array of numbers of one length; null and NaN are missing).

    Rows with a null label are left out; an empty table or a null array's length is an error. Classes are the labels in
    order, at most MAX_CLASSES of them.
    """
    if not 3 <= bins <= MAX_BINS:
        raise ValueError(f"bins must be between 3 and {MAX_BINS}")
    df = df.where(F.col(label).isNotNull()).select(F.col(features).alias("x"), F.col(label).alias("y"))
    classes = sorted(r[0] for r in df.select("y").distinct().limit(MAX_CLASSES + 1).collect())
    if not classes or len(classes) > MAX_CLASSES:
        raise ValueError(f"{len(classes)} classes; between 1 and {MAX_CLASSES} can be told apart")
    width = df.agg(F.max(F.size("x"))).first()[0]
    bounds = quantile_bounds(df, "x", width, bins)
    code = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("y")).cast("int") - 1
    none = np.zeros(len(classes)).tobytes()

    def prepare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = binned(matrix(batch.column(0), width), bounds)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in own], pa.binary()), batch.column(1), pa.array([none] * len(own), pa.binary())], names=["bins", "y", "margin"])

    model, schema = Boosted(classes, bounds, []), "bins binary, y int, margin binary"
    with Staging() as keep:
        rows = keep(df.select("x", code.alias("y")).mapInArrow(prepare, schema))
        since: list[list[Tree]] = []
        for k in range(rounds):
            growing = [Tree(2 ** (depth + 1) - 1) for _ in classes]
            open_nodes = [[0] for _ in classes]
            for level in range(depth):
                following: list[list[int]] = [[] for _ in classes]
                for s in best_splits(histograms(rows, width, bins, since, growing, open_nodes), ridge, least_gain, least_weight).collect():
                    tree, node = growing[s["class"]], s["node"]
                    if level == 0:
                        tree.value[0] = -rate * s["all_g"] / (s["all_h"] + ridge)
                    if s["has_gain"]:
                        tree.feature[node], tree.cut[node], tree.missing_left[node] = s["feature"], s["cut"], s["missing_left"]
                        tree.value[2 * node + 1] = -rate * s["left_g"] / (s["left_h"] + ridge)
                        tree.value[2 * node + 2] = -rate * (s["all_g"] - s["left_g"]) / (s["all_h"] - s["left_h"] + ridge)
                        following[s["class"]] += [2 * node + 1, 2 * node + 2]
                open_nodes = following
                if not any(open_nodes):
                    break
            model.rounds.append(growing)
            since.append(growing)
            if len(since) == STAGED_ROUNDS and k + 1 < rounds:
                done, n = since, len(classes)

                def advance(batches: Iterable[pa.RecordBatch], done=done, n=n) -> Iterator[pa.RecordBatch]:
                    for batch in batches:
                        if batch.num_rows:
                            own = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, width)
                            margin = added(done, own, np.frombuffer(b"".join(batch.column(2).to_pylist())).reshape(-1, n).copy())
                            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in margin], pa.binary())], names=["bins", "y", "margin"])

                rows, since = keep(rows.mapInArrow(advance, schema), rows), []
    return model


def boosted_scores(df: DataFrame, model: Boosted, features: str, name: str = "probabilities", predicted: str = "prediction") -> DataFrame:
    """Adds the probability of each class, in the order of model.classes, and the likeliest one (the first of ties)."""
    width = len(model.bounds)

    @F.pandas_udf("array<double>")
    def scores(x: pd.Series) -> pd.Series:
        return pd.Series(list(softmax(model.margins(binned(matrix(pa.array(x, pa.list_(pa.float64())), width), model.bounds)))))

    labels = F.array(*[F.lit(c) for c in model.classes])
    out = df.withColumn(name, scores(F.col(features).cast("array<double>")))
    return out.withColumn(predicted, F.get(labels, F.array_position(name, F.array_max(name)).cast("int") - 1))


def log_loss(df: DataFrame, model: Boosted, label: str, name: str = "probabilities") -> DataFrame:
    """(log_loss, accuracy, majority_log_loss): of scored rows, beside what the rows' own shares of labels give."""
    at = F.array_position(F.array(*[F.lit(c) for c in model.classes]), F.col(label)).cast("int") - 1
    p = F.greatest(F.coalesce(F.get(name, at), F.lit(0.0)), F.lit(1e-15))
    own = df.agg(F.avg(-F.log(p)).alias("log_loss"), F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"))
    shares = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = shares.agg(F.sum("n").alias("all"))
    majority = shares.crossJoin(F.broadcast(total)).agg(F.sum(-F.col("n") / F.col("all") * F.log(F.col("n") / F.col("all"))).alias("majority_log_loss"))
    return own.crossJoin(majority)  # one row each
