"""The fourth round's finding: a result of all pairs lies on disk in files whose values repeat."""

import bisect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import blocks, text
from tablewright.plans import registry, texts


def vectors(n, rng):
    return {k: {f"t{j}": rng.choice([0.01, 0.3, 0.5, 1.0]) for j in rng.sample(range(12), rng.randint(1, 5))} for k in range(n)}


@pytest.mark.parametrize("least, sign", [(0.0, 1), (float("-inf"), -1)])
def test_bands_hold_all_pairs(spark, monkeypatch, least, sign):
    monkeypatch.setattr(blocks, "BLOCK", 9)
    monkeypatch.setattr(blocks, "TERMS", 4)
    monkeypatch.setattr(blocks, "FIRST", 20)
    rng = random.Random(6)
    found = vectors(40, rng)
    for v in found.values():
        v |= {t: w * rng.choice([1, sign]) for t, w in v.items()}
    df = spark.createDataFrame([(k, t, w) for k, v in found.items() for t, w in v.items()], "k int, term string, weight double")
    dot = {(a, b): sum(w * v[t] for t, w in u.items() if t in v) for a, u in found.items() for b, v in found.items() if a != b and a % 5 == 0 and set(u) & set(v)}
    out = text.similarities(df, "k", least, queries=df.where("k % 5 = 0"), digits=6, edges=(0.0, 0.3, 0.5, 1.5)).collect()
    assert len(out) == len(dot)
    assert {(r.a, r.b): r.cosine for r in out} == pytest.approx(dot, abs=6e-7)


def test_query_cosine_has_a_band_in_a_task():
    assert max(np.diff([0, *texts.EDGES, 1])) * 1e6 * 8 <= 1.3 * 2**20


def test_files_of_query_cosine_hold_one_band(spark):
    out = registry.queries()["query_cosine"](spark, "/root/testdata/sf0.01").select("cosine", F.spark_partition_id().alias("p")).collect()
    bands = {}
    for r in out:  # as they are rounded, some may lie on the edge above
        bands.setdefault(r.p, set()).add(bisect.bisect_right(texts.EDGES, r.cosine - 5e-7))
    assert len(out) == 14054 and all(len(b) == 1 or max(b) - min(b) == 1 and min(r.cosine for r in out if r.p == p) + 1e-6 >= texts.EDGES[min(b)] for p, b in bands.items())
