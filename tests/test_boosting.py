"""Boosted trees against a plain version over the same bins."""

import math
import random

import numpy as np
import pytest

from tablewright.operators import boosting as B

CLASSES, WIDTH = ["a", "b", "c"], 4


def generated(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        x = [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1), float(rng.randint(-2, 2))]) for _ in range(WIDTH)]
        label = "a" if x[0] > 0.5 else "b" if x[1] * x[2] > 0 else "c"
        if rng.random() < 0.1:
            x[rng.randrange(WIDTH)] = rng.choice([None, float("nan")])
        rows.append((k, x, label if rng.random() < 0.95 else rng.choice(CLASSES)))
    return rows


def plain(bins, y, rounds, depth, rate, ridge, least_weight):
    """Trees as dictionaries of node to (feature, cut, missing left), by trying every split."""
    margins, out = np.zeros((len(bins), 3)), []
    for _ in range(rounds):
        p = np.exp(margins) / np.exp(margins).sum(axis=1, keepdims=True)
        step, trees = np.zeros_like(margins), []
        for c in range(3):
            g, h = p[:, c] - (y == c), 2 * p[:, c] * (1 - p[:, c])
            tree = {}

            def grow(node, rows, level):
                G, H = g[rows].sum(), h[rows].sum()
                step[rows, c] = -rate * G / (H + ridge)
                if level == depth:
                    return
                best = (0.0,)
                for f in range(WIDTH):
                    own = bins[rows, f]
                    for cut in sorted(set(own) - {0}):
                        for left in (False, True) if (own == 0).any() else (False,):
                            side = np.where(own == 0, left, own <= cut)
                            a, b = rows[side], rows[~side]
                            if h[a].sum() >= least_weight and h[b].sum() >= least_weight:
                                gain = round((g[a].sum() ** 2 / (h[a].sum() + ridge) + g[b].sum() ** 2 / (h[b].sum() + ridge) - G**2 / (H + ridge)) / 2, 9)
                                if gain > best[0]:
                                    best = (gain, f, cut, left, a, b)
                if best[0] > 0:
                    tree[node] = best[1:4]
                    grow(2 * node + 1, best[4], level + 1)
                    grow(2 * node + 2, best[5], level + 1)

            grow(0, np.arange(len(bins)), 0)
            trees.append(tree)
        margins += step
        out.append(trees)
    return out, margins


def test_same_trees_as_the_plain_version(spark, monkeypatch):
    monkeypatch.setattr(B, "STAGED_ROUNDS", 2)
    rows = generated(300, 51)
    df = spark.createDataFrame([*rows, (-1, [0.0] * WIDTH, None)], "k int, x array<double>, y string").repartition(5)
    model = B.boost(df, "x", "y", rounds=3, depth=3, bins=12, least_weight=1.0)
    values = np.array([[np.nan if v is None else v for v in x] for _, x, _ in rows], float)
    bins, y = B.binned(values, model.bounds), np.array([CLASSES.index(c) for *_, c in rows])
    trees, margins = plain(bins, y, 3, 3, 0.3, 1.0, 1.0)
    assert model.classes == CLASSES
    for ours, theirs in zip(model.rounds, trees):
        for tree, expected in zip(ours, theirs):
            assert {k: (tree.feature[k], tree.cut[k], bool(tree.missing_left[k])) for k in np.flatnonzero(tree.feature >= 0)} == expected
    assert np.allclose(model.margins(bins), margins, atol=1e-8)
    scored = {r.k: r for r in B.boosted_scores(df.where("y IS NOT NULL"), model, "x").collect()}
    p = B.softmax(margins)
    for i, (k, *_) in enumerate(rows):
        assert scored[k].probabilities == pytest.approx(list(p[i]), abs=1e-8) and scored[k].prediction == CLASSES[int(np.argmax(p[i]))]


def test_held_out_loss(spark):
    df = spark.createDataFrame(generated(1200, 52), "k int, x array<double>, y string").repartition(4)
    model = B.boost(df.where("k % 4 <> 0"), "x", "y", rounds=10, depth=3)
    r = B.log_loss(B.boosted_scores(df.where("k % 4 = 0"), model, "x"), model, "y").first()
    assert r.log_loss < 0.6 * r.majority_log_loss and r.accuracy > 0.8


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, [1.0, None], 7), (2, None, 7), (3, [None, 2.0], 7)], "k int, x array<double>, y int")
    model = B.boost(df, "x", "y", rounds=2, depth=2)
    assert all(r.prediction == 7 and math.isclose(r.probabilities[0], 1) for r in B.boosted_scores(df, model, "x").collect())
    with pytest.raises(ValueError):
        B.boost(df.limit(0), "x", "y")
    with pytest.raises(ValueError):
        B.boost(df, "x", "y", bins=2)
