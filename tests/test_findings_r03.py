"""The third round's findings: work that must not grow with copies, read its input again and again, or come together in one task."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.functions import arrays as A
from tablewright.functions import scalars as S
from tablewright.operators import baskets as B
from tablewright.operators import blocks, cluster, kernel, recurrent, text
from tablewright.operators import quantiles as Q


def test_kernel_machine_works_its_rows_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def costly(v):
        seen.add(1)
        return v

    rng = random.Random(1)
    df = spark.createDataFrame([(rng.gauss(k % 2, 0.5), k % 2) for k in range(200)], "v double, y int").withColumn("x", F.array(costly("v")))
    kernel.fit(df, "x", "y", landmarks=10)
    assert 200 <= seen.value <= 400


def test_equal_baskets_are_one(spark, monkeypatch):
    rng = random.Random(2)
    kinds = [[f"i{j}" for j in sorted(rng.sample(range(8), rng.randint(1, 5)))] for _ in range(40)]
    rows, keep = [], B.Staging.__call__

    def counted(self, df, *rest, **named):
        out = keep(self, df, *rest, **named)
        rows[-1] += out.count()
        return out

    monkeypatch.setattr(B.Staging, "__call__", counted)
    found = []
    for copies in (1, 64):
        rows.append(0)
        df = spark.createDataFrame([(k, x) for k, x in enumerate(kinds * copies)], "basket int, items array<string>")
        found.append(sorted((tuple(r["items"]), r.support) for r in B.vertical_itemsets(df, 0.1, 4).collect()))
    assert found[0] == found[1] and found[0]
    assert rows[1] == rows[0]
    odd = spark.createDataFrame([(k, x) for k, x in enumerate(kinds * 5 + kinds[:7] * 6)], "basket int, items array<string>")
    want = {tuple(r["items"]): r.freq for r in B.itemsets(odd, 0.1).collect()}
    assert {tuple(r["items"]): r.freq for r in B.vertical_itemsets(odd, 0.1, 4).collect()} == want


def test_points_are_distinct_and_weighed(spark):
    df = spark.createDataFrame([(float(k % 7), float(k % 3)) for k in range(2100)], "x double, y double").coalesce(1)
    points = cluster.points(df, ["x", "y"])
    assert points.count() == 21 and points.agg(F.sum("weight")).first()[0] == 2100
    assert points.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    model = cluster.kmeans(df, ["x", "y"], 3, starts=2)
    assigned = model.transform(cluster.assembled(df, ["x", "y"])).groupBy("prediction").agg(F.avg("x"), F.avg("y")).collect()
    assert all(model.clusterCenters()[p] == pytest.approx([x, y]) for p, x, y in assigned)
    assert model.summary.trainingCost == pytest.approx(sum(min(((np.array([k % 7, k % 3]) - c) ** 2).sum() for c in model.clusterCenters()) for k in range(2100)))


def test_no_column_of_quantiles_comes_together(spark):
    df = spark.range(40_000).select((F.col("id") % 50).cast("double").alias("x"))
    out = Q.quantiles(df, ["x"], [0.5])
    assert out.collect()[0]["values"] == [24.5]
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_hot_groups_of_quantiles(spark, monkeypatch):
    monkeypatch.setattr(Q, "HOT", 50)
    rng = random.Random(3)
    rows = [(None if k % 5 == 0 else f"g{min(int(rng.expovariate(0.3)), 9)}", None if k % 11 == 0 else rng.gauss(0, 1)) for k in range(900)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r["values"] for r in Q.quantiles(df, ["x"], (0.25, 0.5), ["g"]).collect()}
    assert set(got) == {g for g, x in rows if x is not None}
    for g, values in got.items():
        assert values == pytest.approx(np.quantile([x for h, x in rows if h == g and x is not None], [0.25, 0.5]))


def test_unit_vectors_as_sql_gives_them(spark):
    rows = [[3.0, -1e-9], [0.0, 0.0], [1.0, None], [0.5, -0.5]]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k int, x array<double>")
    got = [r.u for r in df.select("k", F.transform(A.over_length(F.col("x")), lambda v: S.rounded_up(v, 6)).alias("u")).orderBy("k").collect()]
    assert repr(got[0]) == "[1.0, -0.0]" and repr(got[1]) == "[nan, nan]" and got[2] == [1.0, None] and got[3] == [0.707107, -0.707107]
    x = [0.5e-6, -0.5e-6, 1.5e-6, 2.4999995e-6, -1e-9, 0.1234565]
    ours = [r.y for r in spark.createDataFrame([(v,) for v in x], "x double").select(S.rounded_up(F.col("x"), 6).alias("y")).collect()]
    assert repr(sorted(ours)) == repr(sorted(blocks.rounded_up(np.array(x), 6).tolist()))


def test_vector_cosines(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 7)
    rng = random.Random(4)
    rows = [(k, [round(rng.gauss(0, 1), 2) for _ in range(3)]) for k in range(60)] + [(100, None), (150, [0.0] * 3), (7, [0.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "k int, v array<double>")
    out = blocks.vector_cosines(df.where("k % 50 = 0"), df, "k", "v", 3, 6)
    assert "Exchange SinglePartition" not in out._jdf.queryExecution().toString()
    got = {(r.a, r.b): r.cosine for r in out.where("b <> 7").collect()}
    assert set(got) == {(a, b) for a, _ in rows if a % 50 == 0 for b, _ in rows if a != b and b != 7}
    for (a, b), c in got.items():
        u, v = dict(rows[:62])[a], dict(rows[:62])[b]
        if u is None or v is None:
            assert c is None
        elif not any(u) or not any(v):
            assert np.isnan(c)
        else:
            assert c == pytest.approx(np.dot(u, v) / np.linalg.norm(u) / np.linalg.norm(v), abs=6e-7)


def test_term_cosines_shuffle_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 9)
    monkeypatch.setattr(blocks, "TERMS", 4)
    rng = random.Random(5)
    vectors = {k: {f"t{j}": rng.choice([0.5, -0.5, 1.0]) for j in rng.sample(range(12), rng.randint(1, 5))} for k in range(40)}
    df = spark.createDataFrame([(k, t, w) for k, v in vectors.items() for t, w in v.items()], "k int, term string, weight double")
    dot = {(a, b): sum(w * v[t] for t, w in u.items() if t in v) for a, u in vectors.items() for b, v in vectors.items() if a != b and set(u) & set(v)}
    out = text.similarities(df, "k", 0.0, queries=df.where("k % 10 = 0"))
    assert {(r.a, r.b): r.cosine for r in out.collect()} == pytest.approx({p: c for p, c in dot.items() if p[0] % 10 == 0 and c >= 0})
    assert "HashAggregate" not in out._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    every = text.similarities(df, "k", float("-inf"))
    assert {(r.a, r.b): r.cosine for r in every.collect()} == pytest.approx({p: c for p, c in dot.items() if p[0] < p[1]})


def test_windows_are_made_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def made(k):
        seen.add(1)
        return [float(k), float(k + 1), float(k + 2)]

    df = spark.range(64).select(made("id").alias("window"), (F.col("id") + 3).cast("double").alias("target"))
    recurrent.train(df, 3, hidden=2, layers=1, epochs=1, parts=2)
    assert 64 <= seen.value <= 128
