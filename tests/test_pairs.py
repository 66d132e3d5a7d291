"""Nearest neighbours and all-pairs cosines against plain loops, with the share of pairs that are opened."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import neighbours as N
from tablewright.operators import similarity as S
from tablewright.staging import Staging


def points(n, seed, centres=6):
    rng = random.Random(seed)
    middle = [[rng.uniform(-9, 9) for _ in range(5)] for _ in range(centres)]
    # A third of all rows are one vector.
    return [(k, [round(x + rng.gauss(0, 0.5), 3) for x in rng.choice(middle)] if k % 3 else [1.0, 2.0, 3.0, 4.0, 5.0], f"l{k % 4}") for k in range(n)]


@pytest.mark.parametrize(("pivots", "block", "k"), [(16, 4096, 3), (5, 7, 4), (64, 50, 1), (1, 4096, 400)])
def test_nearest(spark, pivots, block, k):
    rows, asked = points(300, 71), [(1000 + k, v, "q") for k, v, _ in points(20, 72)] + [(2000, [1.0, 2.0, 3.0, 4.0, 5.0], "q")]
    schema = "k int, v array<double>, s string"
    train, queries = spark.createDataFrame([*rows, (-1, None, "x"), (None, rows[0][1], "x"), (-2, [None] * 5, "x")], schema).repartition(4), spark.createDataFrame([*asked, (-3, None, "q")], schema)
    out = sorted(tuple(r) for r in N.nearest(queries, train, "k", "v", k, ("s",), pivots=pivots, block=block).collect())
    expected = []
    for i, q, _ in asked:
        order = sorted((round(sum((a - b) ** 2 for a, b in zip(q, v)), 9), t, s) for t, v, s in rows)[:k]
        expected += [(i, p + 1, t, d, s) for p, (d, t, s) in enumerate(order)]
    assert [(i, p, t, s) for i, p, t, _, s in out] == [(i, p, t, s) for i, p, t, _, s in sorted(expected)]
    assert [d for *_, d, _ in out] == pytest.approx([d for *_, d, _ in sorted(expected)], abs=1e-8)
    assert N.nearest(queries, train.limit(0), "k", "v", k).count() == 0 and N.nearest(queries.limit(0), train, "k", "v", k).count() == 0


def test_few_pairs_are_opened(spark):
    rng = random.Random(73)
    near = lambda c: [c * 10 + rng.gauss(0, 1) for _ in range(3)]
    df = spark.createDataFrame([(k, near(rng.randint(0, 9))) for k in range(2000)], "k int, v array<double>")
    with Staging() as keep:
        opened = N.compared(df.where("k % 50 = 0"), df, "k", "v", 5, staging=keep).agg(F.sum("n_compared")).first()[0]
    assert opened < 0.1 * 40 * 2000


def vectors(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        if k > 10 and rng.random() < 0.4:
            terms = dict(rows[rng.randrange(len(rows))][1])
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                terms[f"t{rng.randint(0, 60)}"] = rng.randint(1, 3)
        else:
            terms = {f"t{min(int(rng.expovariate(0.08)), 60)}": rng.randint(1, 3) for _ in range(rng.randint(1, 12))}
        rows.append((k, terms))
    return rows


@pytest.mark.parametrize(("least", "held"), [(0.3, 1000), (0.8, 1000), (0.8, 3), (1.0, 1000)])
def test_all_cosines(spark, monkeypatch, least, held):
    monkeypatch.setattr(S, "HELD", held)
    rows = vectors(150, 74)
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    counts = spark.createDataFrame([(k, t, n) for k, v in rows for t, n in v.items()], "k int, term string, tf int").repartition(4)
    weights = spark.createDataFrame([(k, t, n / length(v)) for k, v in rows for t, n in v.items()], "k int, term string, weight double").repartition(4)
    cosine = lambda u, v: round(sum(x * v.get(t, 0) for t, x in u.items()) / length(u) / length(v), 9)
    expected = {(a, b) for a, u in rows for b, v in rows if a < b and cosine(u, v) >= least}
    assert {(r.a, r.b) for r in S.cosines(weights, "k", least).collect()} == expected
    if least == 0.8:
        assert S.candidates(weights, "k", least).count() < 0.5 * sum(1 for a, u in rows for b, v in rows if a < b and set(u) & set(v))
        first = {}
        for k, v in rows:
            first.setdefault(tuple(sorted(v.items())), k)
        own = {k: first[tuple(sorted(v.items()))] for k, v in rows}
        links = lambda c: len({own[x] for a, b in expected for x in (a, b) if (own[a] == c) != (own[b] == c) and c in (own[a], own[b]) and own[x] != c})
        assert {r.k: (r["class"], r.n_links) for r in S.similar_documents(counts, weights, "k", least).collect()} == {k: (c, links(c)) for k, c in own.items()}
