"""Goldens worked out by hand, properties, null semantics and independence of partitions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tablewright.functions import arrays as A
from tablewright.functions import scalars as S
from tablewright.operators import balance, baskets, cluster, metrics, models, prep, profile, select, split, text, timeseries
from tablewright.operators import quantiles as Q
from tablewright.sources import readers, sinks



def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_numbers_from_text_and_csv(spark, tmp_path):
    (tmp_path / "a.txt").write_text("2.1 3.4\t5.6\n 4.5\n")
    (tmp_path / "b.csv").write_text("1,2,3\n4, 5\n6\n")
    (tmp_path / "c.csv").write_text("1,x\n")
    assert sorted(r[0] for r in readers.read_numbers(spark, str(tmp_path / "a.txt")).collect()) == [2.1, 3.4, 4.5, 5.6]
    assert sorted(r[0] for r in readers.read_numbers(spark, str(tmp_path / "b.csv")).collect()) == [1, 2, 3, 4, 5, 6]
    with pytest.raises(readers.InvalidData):
        readers.read_numbers(spark, str(tmp_path / "c.csv"))
    with pytest.raises(readers.UnsupportedFormat):
        readers.read_numbers(spark, "a.xlsx")


def test_csv_variants(spark, tmp_path):
    (tmp_path / "h.csv").write_text("name,x\nann,1.5\nbob,\ncid,NaN\n")
    df = readers.read_csv(spark, str(tmp_path / "h.csv"), "name string, x double")
    assert {r.name: r.x for r in df.collect()} == {"ann": 1.5, "bob": None, "cid": None}
    (tmp_path / "t.tsv").write_text("ham\thello\nspam\tbuy\n")
    assert readers.read_csv(spark, str(tmp_path / "t.tsv"), sep="\t", header=False, names=["label", "message"]).count() == 2
    (tmp_path / "q.csv").write_text("39, ?, 1\n40, Private, 2\n")
    rows = readers.read_csv(spark, str(tmp_path / "q.csv"), "age int, work string, n int", header=False, null_value="?").collect()
    assert [r.work for r in rows] == [None, "Private"]
    assert readers.from_columns(spark, {"a": [1, 2], "b": ["x", None]}).count() == 2


def test_array_round_trip(spark, tmp_path):
    a = spark.createDataFrame([(0, 0, 1.5), (1, 1, 2.5)], "i int, j int, v double")
    sinks.save_array(a, str(tmp_path / "a"))
    assert sorted(map(tuple, readers.load_array(spark, str(tmp_path / "a")).collect())) == sorted(map(tuple, a.collect()))
    codes = prep.encoders(spark.createDataFrame([("y",), ("n",)], "c string"), ["c"])
    sinks.save_encoders(codes, str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).count() == 2


def test_scalar_goldens(spark):
    assert one(spark, S.floor_div(F.lit(-7), F.lit(3))) == -3
    assert one(spark, S.floor_mod(F.lit(-7), F.lit(3))) == 2
    assert one(spark, S.grade(F.lit(85))) == "B"
    assert one(spark, S.simple_interest(F.lit(10000.0), F.lit(5), F.lit(2))) == 1000.0
    assert math.isclose(one(spark, S.instalment(F.lit(50000.0), F.lit(10.0), F.lit(24))), 2307.246317, abs_tol=1e-6)
    assert one(spark, S.instalment(F.lit(1200.0), F.lit(0.0), F.lit(12))) == 100.0
    assert one(spark, S.running_balance(F.array(*[F.lit(float(x)) for x in (100, -150, -40, 10)]))) == 70.0


def test_statistics_goldens(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 3, 45, 5, 6)], "x double")
    r = df.agg(F.avg("x").alias("m"), F.var_pop("x").alias("v"), F.stddev_pop("x").alias("s")).first()
    assert [round(x, 6) for x in r] == [9.285714, 215.061224, 14.664966]
    assert profile.most_frequent(df, "x").first().asDict() == {"mode": 3.0, "n": 2}


def test_profile_of_nothing(spark):
    df = spark.createDataFrame([], "k string, x double")
    assert profile.describe(df, ["x"]).first()["count"] == 0
    assert profile.histogram(df, "x", 5).count() == 0
    assert profile.value_counts(df, "k").count() == 0
    assert profile.n_duplicated(df, ["k"]).first()[0] == 0


def test_histogram_counts_every_value_once(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 10, 10)] + [(None,)], "x double")
    bins = {r.bin: r.n for r in profile.histogram(df, "x", 5).collect()}
    assert bins == {0: 2, 1: 1, 2: 0, 3: 0, 4: 2}
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert sum(r.n for r in profile.histogram(same, "x", 4).collect()) == 2


def test_null_semantics(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", None), (None, 3.0), ("a", 5.0)], "k string, x double")
    assert {r.k: r.n for r in profile.value_counts(df, "k").collect()} == {"a": 2, "b": 1}
    assert {r.k: r.mean_x for r in profile.group_means(df, ["k"], ["x"]).collect()} == {"a": 5.0, "b": 1.0}
    assert len(profile.group_means(df, ["k"], ["x"], keep_null=True).collect()) == 3
    filled = prep.impute(df, {"x": "mean", "k": "mode"}).collect()
    assert sorted((r.k, r.x) for r in filled) == [("a", 3.0), ("a", 3.0), ("a", 5.0), ("b", 1.0)]
    codes = prep.encode(df, ["k"], prep.encoders(df, ["k"]))
    assert sorted((r.k or "", r.k_code) for r in codes.collect()) == [("", -1), ("a", 0), ("a", 0), ("b", 1)]
    flags = prep.dummies(df, "k")
    assert sorted((r.k_a, r.k_b) for r in flags.collect()) == [(0, 0), (0, 1), (1, 0), (1, 0)]
    with pytest.raises(ValueError):
        prep.labels_of(df, "k", most=1)


def test_scaling(spark):
    df = spark.createDataFrame([(float(x), 7.0) for x in (1, 2, 3, 4)] + [(None, 7.0)], "x double, c double")
    fit = prep.scale_fit(df, ["x", "c"])
    z = prep.scale(df, ["x", "c"], fit)
    r = z.agg(F.avg("x"), F.stddev_pop("x"), F.max("c")).first()
    assert math.isclose(r[0], 0, abs_tol=1e-12) and math.isclose(r[1], 1) and r[2] == 0.0
    back = prep.unscale_minmax(prep.scale(df, ["x"], fit, "minmax"), ["x"], fit)
    assert sorted(r.x for r in back.collect() if r.x is not None) == [1, 2, 3, 4]


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_splits_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(103).select("id", (F.col("id") % 3).alias("y")).repartition(partitions)
    test = {r.id for r in split.train_test_split(df, ["id"], 0.3).where("is_test").collect()}
    assert len(test) == 31
    assert test == {r.id for r in split.train_test_split(df.repartition(2), ["id"], 0.3).where("is_test").collect()}
    strata = split.train_test_split(df, ["id"], 0.25, stratify=["y"]).where("is_test").groupBy("y").count().collect()
    assert {r.y: r["count"] for r in strata} == {0: 9, 1: 9, 2: 9}
    skewed = df.withColumn("y", (F.col("id") < 10).cast("int"))
    assert {r.y: r["count"] for r in split.undersample(skewed, "y", ["id"]).groupBy("y").count().collect()} == {0: 10, 1: 10}
    over = split.oversample(skewed, "y", ["id"])
    assert {r.y: r["count"] for r in over.groupBy("y").count().collect()} == {0: 93, 1: 93}
    assert over.where("copy = 0").count() == 103


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_series_across_chunks(spark, chunk):
    df = spark.range(20).select("id", F.pow("id", F.lit(2)).alias("v"))
    out = {r.id: (r.next_value, r.target) for r in timeseries.next_value_target(df, "v", ["id"], chunk).collect()}
    assert len(out) == 20 and out[3] == (16.0, 1) and out[19] == (None, 0)
    windows = timeseries.sliding_windows(df, "v", ["id"], 4, chunk).collect()
    assert len(windows) == 16
    assert all(r.window == [float((r.id - k) ** 2) for k in (4, 3, 2, 1)] and r.target == r.id**2 for r in windows)


def test_stop_rule(spark):
    table = lambda costs: spark.createDataFrame([(k + 1, float(c)) for k, c in enumerate(costs)], "k int, cost double")
    assert timeseries.chosen_k(table([100, 50, 49, 48, 47, 30])).first()[0] == 6
    assert timeseries.chosen_k(table([100, 50, 25, 12])).first()[0] == 4
    assert timeseries.chosen_k(table([100, 50, 49, 48, 47])).first()[0] == 5


def test_array_goldens(spark):
    a, b = F.array(*[F.lit(x) for x in (1, 2, 3, 4, 5)]), F.array(*[F.lit(x) for x in (4, 5, 6, 7, 8)])
    assert one(spark, A.intersect(a, b)) == [4, 5]
    assert one(spark, A.difference(b, a)) == [6, 7, 8]
    assert one(spark, A.normalised(F.array(F.lit(0.0), F.lit(0.0)))) == [0.0, 0.0]
    assert one(spark, A.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(0.0)))) == 0.0
    m = lambda rows: spark.createDataFrame([(i, j, float(v)) for i, r in enumerate(rows) for j, v in enumerate(r)], "i int, j int, v double")
    x, y = m([[1, 2, 3], [4, 5, 6], [7, 8, 9]]), m([[10, 11], [12, 13], [14, 15]])
    assert {(r.i, r.j): r.v for r in A.matmul(x, y).collect()} == {(0, 0): 76, (0, 1): 82, (1, 0): 184, (1, 1): 199, (2, 0): 292, (2, 1): 316}
    z = {(r.i, r.j): r.v for r in A.matmul(A.transpose(y), x).collect()}
    assert [z[0, j] for j in range(3)] == [156, 192, 228] and [z[1, j] for j in range(3)] == [168, 207, 246]


def test_text(spark):
    df = spark.createDataFrame([(1, "The café, the CAFÉ"), (2, "a b"), (3, None)], "id int, t string")
    assert {(r.id, r.term): r.tf for r in text.term_counts(df, "id", "t").collect()} == {(1, "the"): 2, (1, "café"): 2}
    w = text.tf_idf(text.term_counts(df, "id", "t", stop_words=text.STOP_WORDS), "id", df.agg(F.count(F.lit(1)).alias("n"))).collect()
    assert [(r.term, r.weight) for r in w] == [("café", 1.0)]


def test_rules_include_every_split(spark):
    df = spark.createDataFrame([(x,) for x in (["a", "b", "c"], ["a", "b", "c"], ["a"], ["b"])], "items array<string>")
    sets = baskets.itemsets(df, 0.5)
    assert sets.count() == 7
    found = {(tuple(r.antecedent), tuple(r.consequent)): (r.confidence, r.lift) for r in baskets.rules(sets).collect()}
    assert len(found) == 12
    assert found[("c",), ("a", "b")] == (1.0, 2.0)
    # A larger set is never more frequent than its parts.
    support = {tuple(r["items"]): r.support for r in sets.collect()}
    assert all(support[k] <= support[k[:-1]] for k in support if len(k) > 1)


def test_auc_of_reversed_scores(spark):
    rows = [(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.4), (0, 0.35), (1, 0.8), (0, 1.7), (1, -0.5), (None, 0.3)]
    df = spark.createDataFrame(rows, "y int, s double")
    auc = metrics.roc_auc(df, "y", "s").first()[0]
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    assert math.isclose(auc, sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg))
    assert math.isclose(metrics.roc_auc(df.withColumn("s", -F.col("s")), "y", "s").first()[0], 1 - auc)
    points = metrics.roc_curve(df, "y", "s").orderBy("fpr", "tpr").collect()
    assert (points[0].fpr, points[0].tpr) == (0, 0) and (points[-1].fpr, points[-1].tpr) == (1, 1)


def test_confusion_sums_to_rows(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 0)], "y int, p int")
    cells = metrics.confusion(df, "y", "p").collect()
    assert len(cells) == 9 and sum(c.n for c in cells) == 3


def test_f_tail(spark):
    inf, nan = float("inf"), float("nan")
    cases = [(4.0, 1, 10, 0.07338803477074), (0.0, 1, 5, 1.0), (inf, 1, 5, 0.0), (None, 1, 5, None), (nan, 1, 5, None), (3.0, 1, 0, None)]
    # Closed forms: degrees 1 and 1, and 2 above.
    cases += [(f, 1, 1, 1 - 2 / math.pi * math.atan(math.sqrt(f))) for f in (0.01, 1.0, 20.0)]
    cases += [(f, 2, n, (1 + 2 * f / n) ** (-n / 2)) for f in (0.01, 0.5, 3.0, 7.5) for n in (1, 2, 3, 40, 1_000_000)]
    df = spark.createDataFrame([(k, *c[:3]) for k, c in enumerate(cases)], "k int, f double, d1 int, d2 int")
    found = {r.k: r.p for r in df.select("k", select.f_tail(F.col("f"), F.col("d1"), F.col("d2")).alias("p")).collect()}
    for k, (*_, p) in enumerate(cases):
        assert found[k] is None if p is None else math.isclose(found[k], p, abs_tol=1e-10), cases[k]


def test_elbow_never_rises(spark):
    df = spark.range(60).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("y"))
    costs = [r.cost for r in cluster.elbow(df, ["x", "y"], range(1, 5), starts=2).orderBy("k").collect()]
    assert len(costs) == 4 and all(a >= b for a, b in zip(costs, costs[1:]))


def test_nearest_neighbours_break_ties_by_key(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0], 5), (2, [1.0, 0.0], 7), (3, [0.0, 1.0], 6), (4, [9.0, 9.0], 6)], "id int, v array<double>, y int")
    found = models.neighbours(df.where("id = 1"), df.where("id > 1"), "id", "v", "y", 2)
    assert [(r.place, r.label) for r in found.orderBy("place").collect()] == [(1, 7), (2, 6)]
    assert models.vote(found, 2).first().predicted == 6


@pytest.mark.parametrize("accuracy", [10_000, 100])
def test_quantiles_of_groups(spark, monkeypatch, accuracy):
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    rng = random.Random(21)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, float("inf"), rng.gauss(0, 1), rng.randint(0, 3) * 1.0]), rng.gauss(5, 2)) for _ in range(3000)] + [("c", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    at = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    found = {(r.g, r.column): r["values"] for r in Q.quantiles(df, ["x", "y"], at, ["g"]).collect()}
    for g in ("a", "b", None, "c"):
        for k, c in ((1, "x"), (2, "y")):
            own = [r[k] for r in rows if r[0] == g and r[k] is not None]
            if not own:
                assert (g, c) not in found
                continue
            own.sort()
            for p, v in zip(at, found[g, c]):
                i = p * (len(own) - 1)
                low, high = own[math.floor(i)], own[math.ceil(i)]
                assert v == pytest.approx(low + (high - low) * (i % 1)) or (math.isinf(low) and not math.isfinite(v))
    assert Q.quantiles(df.limit(0), ["x"], [0.5]).count() == 0


def test_places_over_many_buckets(spark):
    rng = random.Random(22)
    rows = [(rng.choice([None, rng.randint(0, 50)]), k, rng.choice(["x", "yy", "", "x\u00e9"])) for k in range(500)]
    df = spark.createDataFrame(rows, "a int, k int, s string").repartition(5)
    for first in ("a", "s"):
        out = split.with_place(df, [first, "k"], 20).collect()
        order = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0) if first == "a" else r[2].encode(), r[1]))
        assert [(r.a, r.k) for r in sorted(out, key=lambda r: r["__place"])] == [(r[0], r[1]) for r in order]


def test_places_of_every_type(spark):
    rng = random.Random(24)
    rows = [(k, rng.choice([None, rng.randint(-9, 9)])) for k in range(300)]
    df = spark.createDataFrame(rows, "k int, n int").repartition(5)
    kinds = ["cast(n as decimal(30,4))", "n > 0", "timestamp_ntz '1969-12-31 23:00:00' + make_interval(0,0,0,0,n)", "timestamp '2024-03-31 00:00:00' + make_interval(0,0,0,0,n)", "date '1970-01-01' + n", "cast(cast(100 + n as string) as binary)", "cast(n as float)"]
    for kind in kinds:
        out = split.with_place(df.withColumn("x", F.expr(kind)), ["x", "k"], 20).orderBy("__place").collect()
        assert [r["__place"] for r in out] == list(range(1, 301))
        key = [((r.x is not None, r.x or 0) if not isinstance(r.x, bytes | bytearray) and not hasattr(r.x, "year") else (True, r.x) if r.x is not None else (False,), r.k) for r in out]
        assert key == sorted(key)
    with pytest.raises(TypeError):
        split.with_place(df.withColumn("x", F.array("n")), ["x"], 20)


@pytest.mark.parametrize("size", [4096, 7])
def test_itemsets_by_difference_sets(spark, size):
    rng = random.Random(25)
    rows = [(f"b{k}", rng.sample("abcdefgh", rng.randint(0, 7))) for k in range(90)] + [("none", None), ("null", [None, "a", "a"])]
    df = spark.createDataFrame(rows, "basket string, items array<string>")
    whole = baskets.itemsets(df.select(F.coalesce(F.array_distinct(F.array_compact("items")), F.array().cast("array<string>")).alias("items")), 0.1)
    found = baskets.vertical_itemsets(df, 0.1, size)
    key = lambda out: sorted((tuple(r["items"]), r.freq) for r in out.collect())
    assert key(found) == key(whole) and max(r["length"] for r in found.collect()) >= 4
    assert baskets.vertical_itemsets(df.limit(0), 0.1).count() == 0


def test_itemsets_level_by_level(spark):
    rng = random.Random(23)
    rows = [(k, rng.sample("abcdefgh", rng.randint(0, 6))) for k in range(80)]
    df = spark.createDataFrame(rows, "id int, items array<string>")
    key = lambda out: sorted((tuple(r["items"]), r.freq) for r in out.collect())
    whole = key(baskets.itemsets(df, 0.1))
    for n in (1, 2, 3):
        assert key(baskets.itemsets(df, 0.1, n)) == [x for x in whole if len(x[0]) <= n]
    assert max(len(x[0]) for x in whole) >= 3


def test_svms_beat_the_majority(spark):
    rng = random.Random(24)
    rows = [(rng.uniform(-1, 1), rng.uniform(-1, 1)) for _ in range(500)]
    df = spark.createDataFrame([(x, y, float(x - 2 * y > 0), float(x * x + y * y < 0.6)) for x, y in rows], "x double, y double, side double, ring double").repartition(2).cache()
    train, test = df.where("x < 0.6"), df.where("x >= 0.6")
    right = lambda model, label, of=test: metrics.accuracy(model.transform(of), label, "prediction").first()[0]
    plain = cluster.assembled(train, ["x", "y"])
    assert right(models.linear_svm("side").fit(plain), "side", cluster.assembled(test, ["x", "y"])) > 0.93
    for kernel in ("rbf", "poly"):
        model = models.kernel_svm(df, ["x", "y"], "ring", kernel, reg=0.0001)
        assert right(model, "ring", df) > 0.93
        assert model.transform(df).where("probability IS NULL").count() == 0
    assert right(models.linear_svm("ring").fit(cluster.assembled(df, ["x", "y"])), "ring", cluster.assembled(df, ["x", "y"])) < 0.8
    df.unpersist()


def test_components_are_those_of_the_covariance(spark):
    import numpy as np

    rng = np.random.default_rng(25)
    x = rng.normal(size=(200, 4)) @ rng.normal(size=(4, 4)) + 7
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ["a", "b", "c", "d"])
    found = np.array([r.components.toArray() for r in models.pca(["a", "b", "c", "d"], 2).fit(df).transform(df).collect()])
    centred = x - x.mean(axis=0)
    _, _, v = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.sort(np.abs(found), axis=0), np.sort(np.abs(centred @ v[:2].T), axis=0), atol=1e-6)


@pytest.mark.parametrize("kind", ["double", "decimal(10,2)"])
def test_running_balances_in_chunks(spark, kind):
    random.seed(5)
    # One account holds half of the moves; one has a move without an amount, and a move has no account.
    rows = [(1 if random.random() < 0.5 else random.randint(2, 6), k, float(random.randint(-50, 45))) for k in range(200)] + [(7, 1, None), (7, 2, 5.0), (7, 3, -6.0), (None, 1, 9.0)]
    want = {}
    for u, _, a in rows[:-1]:
        b, n = want.get(u, (0, 0))
        want[u] = (b + (a or 0) if b + (a or 0) >= 0 else b, n + 1)
    df = spark.createDataFrame(rows, "u int, k int, a double").withColumn("a", F.col("a").cast(kind))
    for options in ({}, {"chunk": 3, "rows_a_range": 20}):
        assert {r.u: (float(r.balance), r.n_moves) for r in balance.running_balances(df, "u", ["k"], "a", **options).collect()} == want
    assert balance.running_balances(df.limit(0), "u", ["k"], "a").count() == 0


@pytest.mark.parametrize("size, copies", [(1, 1), (3, 2), (16, 8)])
def test_block_matmul(spark, size, copies):
    random.seed(1)
    # Indices below 0, repeated cells, zeros, cells without a value or an index.
    cells = lambda n, m: [(random.randint(-n, n), random.randint(-m, m), random.choice([None, 1.5, -2.0, 0.0])) for _ in range(120)] + [(None, 1, 1.0), (1, None, 1.0)]
    a, b = (spark.createDataFrame(cells(n, m), "i int, j int, v double") for n, m in ((9, 14), (14, 9)))
    plain = {(r.i, r.j): r.v for r in A.matmul(a.dropna(), b.dropna()).collect()}
    assert len(plain) > 100
    assert {(r.i, r.j): r.v for r in A.block_matmul(a, b, size, copies).collect()} == plain
    assert A.block_matmul(a.limit(0), b, size, copies).count() == 0
