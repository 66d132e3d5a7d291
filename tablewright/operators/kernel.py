"""Kernel support vector machines on landmarks, solved to a duality gap that is reported.

Rows are mapped to the span of the kernel functions of at most `landmarks` rows (Nystroem's method; with all rows as
landmarks it is the kernel itself). There the hinge loss is smoothed over a width that shrinks until the gap between the
true primal and dual objectives is small: each of Newton's steps is one pass that sums gradient and curvature over all
rows, and one that tries a series of step lengths. The smoothed loss's slopes are a feasible point of the dual, so the gap
bounds how far the result is from the best one. The driver sees matrices of the landmarks' number, never rows.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import Staging
from .sums import matrix, summed

STEPS = 0.5 ** np.arange(12)


@dataclass
class KernelSvm:
    landmarks: np.ndarray
    root: np.ndarray
    weights: np.ndarray
    kernel: str
    gamma: float
    degree: int
    offset: float
    #: (primal - dual) / primal, and the primal objective.
    gap: float = np.inf
    primal: float = np.inf

    def mapped(self, x: np.ndarray) -> np.ndarray:
        """Rows in the span of the landmarks, and a 1 for the bias, which is weighed like the rest."""
        return np.column_stack([self.products(x) @ self.root, np.ones(len(x))])

    def products(self, x: np.ndarray) -> np.ndarray:
        dot = x @ self.landmarks.T
        if self.kernel == "rbf":
            squares = (x**2).sum(axis=1)[:, None] + (self.landmarks**2).sum(axis=1) - 2 * dot
            return np.exp(-self.gamma * np.maximum(squares, 0))
        return (self.gamma * dot + self.offset) ** (self.degree if self.kernel == "poly" else 1)

    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.mapped(x) @ self.weights


def chosen(df: DataFrame, x: str, landmarks: int) -> np.ndarray:
    """At most so many distinct rows, the first ones in the order of a hash; each task keeps no more."""
    rows = df.select(x).distinct().orderBy(F.xxhash64(x), x).limit(landmarks).collect()
    return np.array([r[0] for r in rows], float)


def scale_of(df: DataFrame, x: str) -> float:
    """1 over the number of features times the variance of all their values."""
    width, spread = df.select(F.size(x).alias("n"), F.explode(x).alias("v")).agg(F.max("n"), F.var_pop("v")).first()
    return 1 / (width * spread) if spread else 1.0


def fit(df: DataFrame, x: str, y: str, c: float = 1.0, kernel: str = "rbf", gamma: float | None = None, degree: int = 3, offset: float = 0.0, landmarks: int = 200, tolerance: float = 1e-3, max_steps: int = 80) -> KernelSvm:
    """A machine for two labels, y true or above 0 against the rest; x is an array of numbers of one length.

    c weighs the sum of the losses; gamma is 1 / (features * variance) if not given. Rows with a null label, a null array or
    a null in it are left out; without any row it is an error. Warns if the gap is above tolerance after max_steps.
    """
    whole = F.coalesce(F.col(y).isNotNull() & ~F.exists(x, lambda v: v.isNull()), F.lit(False))
    df = df.where(whole).select(F.col(x).cast("array<double>").alias("x"), F.when(F.col(y).cast("double") > 0, 1.0).otherwise(-1.0).alias("y"))
    # Every step reads all rows again, so what they are made of is worked out once.
    with Staging() as keep:
        return solved(keep(df), c, kernel, gamma, degree, offset, landmarks, tolerance, max_steps)


def solved(df: DataFrame, c: float, kernel: str, gamma: float | None, degree: int, offset: float, landmarks: int, tolerance: float, max_steps: int) -> KernelSvm:
    """fit() of rows x, y (1 or -1)."""
    picked = chosen(df, "x", landmarks)
    if not len(picked):
        raise ValueError("there are no rows to learn from")
    model = KernelSvm(picked, np.eye(len(picked)), np.zeros(0), kernel, gamma if gamma is not None else scale_of(df, "x"), degree, offset)
    values, vectors = np.linalg.eigh(model.products(picked))
    real = values > 1e-9 * values.max()
    model.root = vectors[:, real] / np.sqrt(values[real])
    n = model.root.shape[1] + 1
    w, width, steps = np.zeros(n), 1.0, 0

    def pieces(w: np.ndarray, width: float):
        def add(batch: pa.RecordBatch) -> np.ndarray:
            z, y = model.mapped(matrix(batch.column(0), picked.shape[1])), batch.column(1).to_numpy()
            behind = 1 - y * (z @ w)
            slope = c * np.clip(behind / width, 0, 1)
            near = z[(behind > 0) & (behind < width)]
            return np.concatenate([z.T @ (slope * y), (near.T @ near).ravel(), [np.maximum(behind, 0).sum(), slope.sum()]])

        return add

    def tried(points: np.ndarray, width: float):
        def add(batch: pa.RecordBatch) -> np.ndarray:
            z, y = model.mapped(matrix(batch.column(0), picked.shape[1])), batch.column(1).to_numpy()
            behind = np.maximum(1 - y[:, None] * (z @ points.T), 0)
            return np.where(behind < width, behind**2 / (2 * width), behind - width / 2).sum(axis=0)

        return add

    while steps < max_steps:
        steps += 1
        sums = summed(df, pieces(w, width), n + n * n + 2)
        pull, curve, hinge, slopes = sums[:n], sums[n : n + n * n].reshape(n, n), sums[-2], sums[-1]
        primal, dual = w @ w / 2 + c * hinge, slopes - pull @ pull / 2
        gap = (primal - dual) / max(abs(primal), 1e-12)
        if gap < model.gap:
            model.weights, model.gap, model.primal = w, gap, primal
        if gap <= tolerance:
            break
        gradient = w - pull
        if np.linalg.norm(gradient) <= 1e-6 * max(1.0, np.linalg.norm(w)):
            width *= 0.2  # the best for this width; a narrower one is nearer to the hinge
            continue
        direction = -np.linalg.solve(np.eye(n) + c / width * curve, gradient)
        points = w + STEPS[:, None] * direction
        costs = (points**2).sum(axis=1) / 2 + c * summed(df, tried(points, width), len(STEPS))
        w = points[int(np.argmin(costs))]
    if model.gap > tolerance:
        warnings.warn(f"the duality gap is {model.gap:.2g} of the objective after {steps} steps", stacklevel=2)
    return model


def with_margin(df: DataFrame, model: KernelSvm, x: str, name: str = "margin") -> DataFrame:
    """Adds the signed margin (above 0: the label holds); null where the array is null or has nulls."""

    @F.pandas_udf("double")
    def margin(v: pd.Series) -> pd.Series:
        return pd.Series(model.margins(matrix(pa.array(v, pa.list_(pa.float64())), model.landmarks.shape[1])))

    whole = F.coalesce(~F.exists(x, lambda v: v.isNull()), F.lit(False))
    safe = F.when(whole, F.col(x).cast("array<double>")).otherwise(F.array_repeat(F.lit(0.0), model.landmarks.shape[1]))
    return df.withColumn(name, F.when(whole, margin(safe)))


def platt(df: DataFrame, margin: str, y: str, steps: int = 30) -> tuple[float, float]:
    """Slope and intercept of a logistic fit of the label to the margin, by Newton's steps on sums, with Platt's targets for the labels' shares."""
    with Staging() as keep:
        df = keep(df.select(F.col(margin).cast("double").alias("m"), (F.col(y).cast("double") > 0).alias("p")).dropna())
        ups, downs = df.agg(F.count_if("p"), F.count_if(~F.col("p"))).first()
        high, low = (ups + 1) / (ups + 2), 1 / (downs + 2)
        a, b = 0.0, float(np.log((ups + 1) / (downs + 1)))
        for _ in range(steps):
            p = 1 / (1 + F.exp(-(a * F.col("m") + b)))
            off, w = p - F.when(F.col("p"), high).otherwise(low), p * (1 - p)
            m = F.col("m")
            g0, g1, h00, h01, h11 = df.agg(F.sum(off * m), F.sum(off), F.sum(w * m * m), F.sum(w * m), F.sum(w)).first()
            step = np.linalg.solve(np.array([[h00, h01], [h01, h11]]) + 1e-12 * np.eye(2), [g0, g1])
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-8:
                break
    return a, b


def probability(margin: str, fitted: tuple[float, float]) -> Column:
    return 1 / (1 + F.exp(-(fitted[0] * F.col(margin) + fitted[1])))
