"""A recurrent network (layers of LSTM cells and one linear output) that forecasts the value after a window.

Weights are one vector, sent out with each step. Every task runs its windows forward and back through time and adds up
their gradients; Spark adds the tasks' sums, and the driver, which sees as many numbers as there are weights, takes a step
of Adam. Windows are dealt to parts by a hash, and a step uses one part, read on its own; an epoch uses all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import Staging
from .sums import matrix, summed

#: Windows that a task runs through time at once; bounds its memory.
CHUNK = 512


def shapes(hidden: int, layers: int) -> list[tuple[int, ...]]:
    """For each layer weights of its input, of its own last output, and biases, for the gates in, forget, out and the new value; then the output's."""
    out: list[tuple[int, ...]] = []
    for k in range(layers):
        out += [(1 if k == 0 else hidden, 4 * hidden), (hidden, 4 * hidden), (4 * hidden,)]
    return [*out, (hidden,), (1,)]


def unpacked(weights: np.ndarray, hidden: int, layers: int) -> list[np.ndarray]:
    out, at = [], 0
    for shape in shapes(hidden, layers):
        n = int(np.prod(shape))
        out.append(weights[at : at + n].reshape(shape))
        at += n
    return out


def initial(hidden: int, layers: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    made = [rng.uniform(-1, 1, s) * np.sqrt(6 / sum(s)) if len(s) == 2 else np.zeros(s) for s in shapes(hidden, layers)]
    for k in range(layers):
        made[3 * k + 2][hidden : 2 * hidden] = 1  # cells begin by remembering
    made[-2] = rng.uniform(-1, 1, hidden) * np.sqrt(6 / (hidden + 1))
    return np.concatenate([m.ravel() for m in made])


def forward(parts: list[np.ndarray], windows: np.ndarray, hidden: int) -> tuple[np.ndarray, list]:
    """Forecasts of windows (rows, steps), and for each layer its inputs, gates, cells, their tanh and outputs by step.

    Within, a row is a column: what belongs to one gate lies together for all rows, so that numpy runs over long strips.
    """
    n, steps = windows.shape
    x, kept = np.ascontiguousarray(windows.T)[:, None, :], []
    for k in range((len(parts) - 2) // 3):
        w, u, b = parts[3 * k].T.copy(), parts[3 * k + 1].T.copy(), parts[3 * k + 2][:, None]
        h, c = np.zeros((hidden, n)), np.zeros((hidden, n))
        gates, cells, seen, outs = np.empty((steps, 4 * hidden, n)), np.empty((steps, hidden, n)), np.empty((steps, hidden, n)), np.empty((steps, hidden, n))
        for t in range(steps):
            z = gates[t]
            np.add(w @ x[t], u @ h, out=z)
            z += b
            # 1 / (1 + exp(-x)) is (tanh(x / 2) + 1) / 2.
            z[: 3 * hidden] *= 0.5
            np.tanh(z, out=z)
            z[: 3 * hidden] *= 0.5
            z[: 3 * hidden] += 0.5
            c = np.multiply(z[hidden : 2 * hidden], c, out=cells[t])
            c += z[:hidden] * z[3 * hidden :]
            h = np.multiply(z[2 * hidden : 3 * hidden], np.tanh(c, out=seen[t]), out=outs[t])
        kept.append((x, gates, cells, seen, outs))
        x = outs
    return parts[-2] @ x[-1] + parts[-1], kept


def gradient(weights: np.ndarray, windows: np.ndarray, target: np.ndarray, hidden: int, layers: int) -> np.ndarray:
    """The gradient of the sum of squared errors, then that sum, then the number of windows."""
    parts = unpacked(weights, hidden, layers)
    grads = [np.zeros_like(p) for p in parts]
    found, kept = forward(parts, windows, hidden)
    error = found - target
    n, steps = windows.shape
    grads[-2], grads[-1] = 2 * kept[-1][4][-1] @ error, np.array([2 * error.sum()])
    above = None
    for k in reversed(range(layers)):
        (x, gates, cells, seen, outs), (w, u, _) = kept[k], parts[3 * k : 3 * k + 3]
        below = np.empty((steps, hidden, n)) if k else None
        dh, dc, dz = np.zeros((hidden, n)), np.zeros((hidden, n)), np.empty((4 * hidden, n))
        none = np.zeros((hidden, n))
        for t in reversed(range(steps)):
            i, f, o, new = (gates[t][j * hidden : (j + 1) * hidden] for j in range(4))
            if above is not None:
                dh = dh + above[t]
            elif t == steps - 1:
                dh = 2 * parts[-2][:, None] * error
            dc = dc + dh * o * (1 - seen[t] ** 2)
            into = dc * i
            dz[:hidden] = into * new * (1 - i)
            dz[hidden : 2 * hidden] = dc * (cells[t - 1] if t else none) * f * (1 - f)
            dz[2 * hidden : 3 * hidden] = dh * outs[t] * (1 - o)
            dz[3 * hidden :] = into * (1 - new**2)
            grads[3 * k] += x[t] @ dz.T
            grads[3 * k + 1] += (outs[t - 1] if t else none) @ dz.T
            grads[3 * k + 2] += dz.sum(axis=1)
            dh, dc = u @ dz, dc * f
            if k:
                below[t] = w @ dz
        above = below
    return np.concatenate([*[g.ravel() for g in grads], [float(error @ error), float(n)]])


@dataclass
class Recurrent:
    weights: np.ndarray
    hidden: int
    layers: int
    size: int
    low: float
    high: float
    #: Mean squared error of each epoch, of scaled values, before its steps.
    losses: list[float]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.low) / ((self.high - self.low) or 1.0)

    def forecast(self, windows: np.ndarray) -> np.ndarray:
        parts = unpacked(self.weights, self.hidden, self.layers)
        found = [forward(parts, self.scaled(windows[k : k + CHUNK]), self.hidden)[0] for k in range(0, len(windows), CHUNK)]
        return self.low + np.concatenate([*found, np.zeros(0)]) * ((self.high - self.low) or 1.0)


def train(windows: DataFrame, size: int, window: str = "window", target: str = "target", hidden: int = 50, layers: int = 2, epochs: int = 20, parts: int = 8, rate: float = 0.003, seed: int = 42) -> Recurrent:
    """A network for windows (arrays of size numbers) and the value after each.

    Values are scaled to 0 to 1 by the least and greatest target. Rows with a null target, or a window that is null, of
    another size or with nulls, are left out; without any row it is an error. The same rows and seed give the same
    network, but for the rounding of sums.
    """
    whole = F.col(target).isNotNull() & (F.size(window) == size) & ~F.exists(window, lambda x: x.isNull())
    df = windows.where(F.coalesce(whole, F.lit(False))).select(F.col(window).cast("array<double>").alias("w"), F.col(target).cast("double").alias("y"))
    model = Recurrent(initial(hidden, layers, seed), hidden, layers, size, 0.0, 0.0, [])
    count = len(model.weights) + 2

    def of(weights: np.ndarray):
        def add(batch: pa.RecordBatch) -> np.ndarray:
            w, y = model.scaled(matrix(batch.column(0), size)), model.scaled(batch.column(1).to_numpy())
            return sum(gradient(weights, w[k : k + CHUNK], y[k : k + CHUNK], hidden, layers) for k in range(0, len(w), CHUNK))

        return add

    mean, square, step = np.zeros(count - 2), np.zeros(count - 2), 0
    with Staging() as keep:
        rows = keep(df.withColumn("part", F.pmod(F.xxhash64("y", "w"), F.lit(parts)).cast("int")), by=["part"])  # windows are made once
        model.low, model.high = rows.agg(F.min("y"), F.max("y")).first()
        if model.low is None:
            raise ValueError("there are no windows to learn from")
        for _ in range(epochs):
            error = n = 0.0
            for part in range(parts):
                sums = summed(rows.where(F.col("part") == part).select("w", "y"), of(model.weights), count)
                if not sums[-1]:
                    continue
                error, n, step = error + sums[-2], n + sums[-1], step + 1
                g = sums[:-2] / sums[-1]
                mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
                model.weights = model.weights - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            model.losses.append(error / n)
    return model


def forecasts(df: DataFrame, model: Recurrent, window: str = "window", name: str = "forecast") -> DataFrame:
    """Adds the forecast of each window; null where the window is null, of another size, or has nulls."""

    @F.pandas_udf("double")
    def forecast(w: pd.Series) -> pd.Series:
        return pd.Series(model.forecast(matrix(pa.array(w, pa.list_(pa.float64())), model.size)))

    whole = F.coalesce((F.size(window) == model.size) & ~F.exists(window, lambda x: x.isNull()), F.lit(False))
    # Other windows go in as zeros, and their forecasts are not shown.
    safe = F.when(whole, F.col(window).cast("array<double>")).otherwise(F.array_repeat(F.lit(0.0), model.size))
    return df.withColumn(name, F.when(whole, forecast(safe)))
