"""The recurrent network's gradients and forecasts, and kernel machines against a plain solver."""

import math
import random

import numpy as np
import pytest

from tablewright.operators import kernel as K
from tablewright.operators import recurrent as R


def test_gradients_by_differences():
    rng = np.random.default_rng(61)
    for hidden, layers in ((3, 1), (2, 2), (2, 3)):
        windows, target = rng.normal(size=(5, 6)), rng.normal(size=5)
        w = R.initial(hidden, layers, 7) + 0.1 * rng.normal(size=len(R.initial(hidden, layers, 7)))
        got = R.gradient(w, windows, target, hidden, layers)
        assert got[-1] == 5
        for k in range(len(w)):
            step = np.zeros(len(w))
            step[k] = 1e-5
            by = (R.gradient(w + step, windows, target, hidden, layers)[-2] - R.gradient(w - step, windows, target, hidden, layers)[-2]) / 2e-5
            assert got[k] == pytest.approx(by, rel=1e-5, abs=1e-7)


def test_forecast_beats_the_last_value(spark):
    rng = random.Random(62)
    series = [math.sin(k / 3) + 0.1 * rng.gauss(0, 1) for k in range(700)]
    rows = [(k, series[k : k + 12], series[k + 12]) for k in range(688)] + [(-1, None, 1.0), (-2, [1.0] * 11 + [None], 1.0), (-3, [1.0], 1.0), (-4, [1.0] * 12, None)]
    df = spark.createDataFrame(rows, "k int, window array<double>, target double").repartition(3)
    model = R.train(df.where("k < 500"), 12, hidden=6, layers=2, epochs=14, parts=4, rate=0.05)
    assert len(model.losses) == 14 and model.losses[-1] < model.losses[0] / 4
    out = R.forecasts(df, model).collect()
    held = [r for r in out if r.k >= 500]
    assert sum((r.forecast - r.target) ** 2 for r in held) < 0.6 * sum((r.window[-1] - r.target) ** 2 for r in held)
    assert {r.k: r.forecast is None for r in out if r.k < 0} == {-1: True, -2: True, -3: True, -4: False}
    with pytest.raises(ValueError):
        R.train(df.limit(0), 12)


def rings(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = ((x**2).sum(axis=1) + 0.3 * rng.normal(size=n) < 1.2).astype(int)
    return x, y


def plain(kernel, y, c):
    """Coordinate ascent on the dual of the whole kernel with a bias of its own, until nothing moves."""
    q, a = (kernel + 1) * np.outer(y, y), np.zeros(len(y))
    for _ in range(3000):
        before = a.copy()
        for i in range(len(y)):
            a[i] = np.clip(a[i] + (1 - q[i] @ a) / q[i, i], 0, c)
        if np.abs(a - before).max() < 1e-9:
            break
    return a, a.sum() - a @ q @ a / 2


@pytest.mark.parametrize(("kernel", "c"), [("rbf", 10.0), ("poly", 1.0)])
def test_kernel_machine_agrees_with_a_plain_solver(spark, kernel, c):
    x, label = rings(120, 63)
    y = 2.0 * label - 1
    df = spark.createDataFrame([([float(v) for v in row], int(t)) for row, t in zip(x, label)] + [(None, 1), ([1.0, None], 0), ([0.0, 0.0], None)], "x array<double>, y int").repartition(4)
    model = K.fit(df, "x", "y", c=c, kernel=kernel, gamma=0.7, degree=3, offset=1.0, landmarks=200, tolerance=1e-4)
    full = np.exp(-0.7 * ((x[:, None] - x[None]) ** 2).sum(axis=2)) if kernel == "rbf" else (0.7 * x @ x.T + 1) ** 3
    a, dual = plain(full, y, c)
    assert model.gap <= 1e-4 and model.primal == pytest.approx(dual, rel=2e-4)
    out = {tuple(r.x): r.margin for r in K.with_margin(df.where("x IS NOT NULL AND size(x) = 2 AND x[1] IS NOT NULL"), model, "x").collect()}
    expected = (full + 1) @ (a * y)
    assert max(abs(out[tuple(map(float, row))] - f) for row, f in zip(x, expected)) < 0.05


def test_landmarks_margins_and_probabilities(spark):
    x, label = rings(800, 64)
    df = spark.createDataFrame([(k, [float(v) for v in row], int(t)) for k, (row, t) in enumerate(zip(x, label))], "k int, x array<double>, y int").repartition(4)
    train, test = df.where("k < 600"), df.where("k >= 600")
    model = K.fit(train, "x", "y", landmarks=40)
    assert model.gap <= 1e-3 and len(model.landmarks) == 40
    fitted = K.platt(K.with_margin(train, model, "x"), "margin", "y")
    out = K.with_margin(test, model, "x").withColumn("p", K.probability("margin", fitted)).collect()
    right = sum((r.margin > 0) == (r.y == 1) for r in out) / len(out)
    assert right > 0.85 > max(np.mean(label[600:]), 1 - np.mean(label[600:]))
    assert sum((r.p - r.y) ** 2 for r in out) / len(out) < 0.12 and all(0 <= r.p <= 1 for r in out)
    with pytest.raises(ValueError):
        K.fit(df.limit(0), "x", "y")
