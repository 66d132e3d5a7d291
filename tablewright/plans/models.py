"""Metrics on deterministic scores, feature selection, exact models in SQL, and Spark ML models."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..operators import cluster, metrics, models, neighbours, select, split, timeseries
from ..session import shared_dir
from ..sources import readers, sinks
from ..sources.readers import read_table
from .profiles import rounded
from .registry import example, query


def scored(spark, d):
    """Labels with a score between 0 and 1 that depends on the document's length."""
    docs = read_table(spark, d, "documents").select("doc_id", "n_chars")
    score = F.round(F.col("n_chars") / (F.col("n_chars") + 2000), 3)
    return read_table(spark, d, "labels").join(docs, "doc_id").select("doc_id", F.col("quality").alias("y"), score.alias("score"))


SCORED = "s AS (SELECT doc_id, quality AS y, round(n_chars / (n_chars + 2000)::DOUBLE, 3) AS score FROM labels JOIN documents USING (doc_id))"
PREDICTED = SCORED + ", p AS (SELECT *, CASE WHEN score > 0.3 THEN 1 ELSE 0 END AS p FROM s)"


def predicted(spark, d, threshold=0.3):
    return scored(spark, d).withColumn("p", metrics.thresholded(F.col("score"), threshold))


@query(f"WITH {SCORED} SELECT doc_id, CASE WHEN score > 0.8 THEN 1 ELSE 0 END::INT AS p FROM s")
def threshold_08(spark, d):
    """Predictions by a strict threshold (M7)."""
    return predicted(spark, d, 0.8).select("doc_id", "p")


@query(f"WITH {PREDICTED} SELECT round(avg((y = p)::INT), 6) AS accuracy FROM p")
def accuracy(spark, d):
    """Share of right predictions (M1)."""
    return rounded(metrics.accuracy(predicted(spark, d), "y", "p"), 6, "accuracy")


@query(f"WITH {PREDICTED} SELECT doc_id, y AS actual, p AS predicted FROM p")
def actual_vs_predicted(spark, d):
    """Actual beside predicted values."""
    return predicted(spark, d).select("doc_id", F.col("y").alias("actual"), F.col("p").alias("predicted"))


@query(f"WITH {PREDICTED} SELECT a AS actual, b AS predicted, count(y)::BIGINT AS n FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(a, b) LEFT JOIN p ON y = a AND p = b GROUP BY 1, 2")
def confusion_matrix(spark, d):
    """Counts of actual and predicted labels, empty cells included (M5)."""
    return metrics.confusion(predicted(spark, d), "y", "p")


@query(f"""WITH {PREDICTED}
, c AS (SELECT l, count(*) FILTER (y = l) AS support, count(*) FILTER (p = l) AS said, count(*) FILTER (y = l AND p = l) AS tp FROM p, (VALUES (0), (1)) t(l) GROUP BY 1)
, r AS (SELECT l::VARCHAR AS label, CASE WHEN said > 0 THEN tp / said::DOUBLE ELSE 0 END AS precision, CASE WHEN support > 0 THEN tp / support::DOUBLE ELSE 0 END AS recall, support FROM c)
, f AS (SELECT label, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1, support FROM r)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support) FROM f""")
def classification_report(spark, d):
    """Precision, recall, F1 and support by label and averaged (M6)."""
    return rounded(metrics.report(predicted(spark, d), "y", "p"), 6, "precision", "recall", "f1")


@query(f"WITH {SCORED} SELECT round(sum(CASE WHEN a.score > b.score THEN 1 WHEN a.score = b.score THEN 0.5 ELSE 0 END) / count(*), 6)::DOUBLE AS auc FROM s a, s b WHERE a.y = 1 AND b.y = 0")
def roc_auc(spark, d):
    """Area under the ROC curve, ties counting half (M8)."""
    return rounded(metrics.roc_auc(scored(spark, d), "y", "score"), 6, "auc")


@query(f"""WITH {SCORED}, t AS (SELECT DISTINCT score FROM s)
SELECT t.score AS threshold, round(count(*) FILTER (y = 0 AND s.score >= t.score) / (SELECT count(*) FROM s WHERE y = 0)::DOUBLE, 6) AS fpr, round(count(*) FILTER (y = 1 AND s.score >= t.score) / (SELECT count(*) FROM s WHERE y = 1)::DOUBLE, 6) AS tpr FROM t, s GROUP BY 1
UNION ALL SELECT 'Infinity'::DOUBLE, 0, 0""")
def roc_curve(spark, d):
    """Points of the ROC curve."""
    return rounded(metrics.roc_curve(scored(spark, d), "y", "score"), 6, "fpr", "tpr")


@query("""WITH p AS (SELECT l_extendedprice AS y, 1500.0 * l_quantity AS p FROM lineitem)
SELECT round(avg((y - p) ^ 2), 3) AS mse, round(sqrt(avg((y - p) ^ 2)), 5) AS rmse, round(avg(abs(y - p)), 5) AS mae, round(1 - avg((y - p) ^ 2) / var_pop(y), 6) AS r2 FROM p""")
def regression_metrics(spark, d):
    """Squared and absolute errors and R2 (M2-M4)."""
    df = read_table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("y"), (1500.0 * F.col("l_quantity")).alias("p"))
    return rounded(rounded(rounded(metrics.regression_metrics(df, "y", "p"), 3, "mse"), 5, "rmse", "mae"), 6, "r2")


FEATURES = ("l_quantity", "l_discount", "l_tax", "l_linenumber")
F_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, round(r * r / (1 - r * r) * (n - 2), 4) AS f FROM (SELECT corr({c}, l_extendedprice) AS r, count(*) AS n FROM lineitem)" for c in FEATURES)


def f_scores(spark, d):
    return select.f_regression(read_table(spark, d, "lineitem"), FEATURES, "l_extendedprice")


@query(F_SQL)
def f_regression(spark, d):
    """F statistics of each feature."""
    return rounded(f_scores(spark, d).drop("df2"), 4, "f")


@query()
def f_regression_p(spark, d):
    """F statistics with their p values."""
    return select.with_p_values(f_scores(spark, d))


@query(f"SELECT * FROM ({F_SQL}) ORDER BY f DESC, feature LIMIT 3")
def select_k_best(spark, d):
    """The three best features."""
    return rounded(select.select_features(f_scores(spark, d), "k_best", 3), 4, "f")


@query(f"SELECT * FROM ({F_SQL}) ORDER BY f DESC, feature LIMIT 2")
def select_percentile(spark, d):
    """The best half of the features."""
    return rounded(select.select_features(f_scores(spark, d), "percentile", 50), 4, "f")


@query("SELECT round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem")
def linear_fit_1d(spark, d):
    """A line fitted to one feature (L1)."""
    return rounded(rounded(models.line_fit(read_table(spark, d, "lineitem"), "l_quantity", "l_extendedprice"), 5, "slope"), 4, "intercept")


NB = [f"e{k}" for k in range(64)]


def vectors(spark, d):
    return read_table(spark, d, "embeddings").select("vec_id", "label", *[F.col("embedding")[k].cast("double").alias(c) for k, c in enumerate(NB)])


NB_ROWS = "e AS (SELECT vec_id, label, " + ", ".join(f"embedding[{k + 1}]::DOUBLE AS {c}" for k, c in enumerate(NB)) + " FROM embeddings)"


@query(f"""WITH {NB_ROWS}, v AS (SELECT greatest({', '.join(f'var_pop({c})' for c in NB)}) * 1e-9 AS eps, count(*) AS n FROM e)
, c AS (SELECT label, count(*) / any_value(n)::DOUBLE AS prior, {', '.join(f'avg({c}) AS m_{c}, var_pop({c}) + any_value(eps) AS v_{c}' for c in NB)} FROM e, v GROUP BY 1)
, s AS (SELECT vec_id, c.label, ln(prior) {' '.join(f'- 0.5 * (ln(2 * pi() * v_{c}) + ({c} - m_{c}) ^ 2 / v_{c})' for c in NB)} AS ll FROM e, c)
SELECT vec_id, label AS predicted FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY ll DESC, label) = 1""")
def gaussian_nb(spark, d):
    """Gaussian naive Bayes from class means and variances."""
    df = vectors(spark, d)
    return models.gaussian_nb_predict(df, "vec_id", NB, models.gaussian_nb(df, NB, "label"))


D2 = "round(list_sum([(a[1]::DOUBLE - a[2]::DOUBLE) * (a[1]::DOUBLE - a[2]::DOUBLE) FOR a IN list_zip(q.embedding, t.embedding)]), 9)"
KNN = f"n AS (SELECT q.vec_id AS query, q.label AS actual, t.label, row_number() OVER (PARTITION BY q.vec_id ORDER BY {D2}, t.vec_id) AS place FROM embeddings q, embeddings t WHERE q.vec_id % 50 = 0 AND t.vec_id % 50 <> 0)"


def found(spark, d, k):
    df = read_table(spark, d, "embeddings")
    return neighbours.neighbours(df.where("vec_id % 50 = 0"), df.where("vec_id % 50 <> 0"), "vec_id", "embedding", "label", k)


@query(f"WITH {KNN} SELECT query, label AS predicted FROM (SELECT query, label, count(*) AS n FROM n WHERE place <= 5 GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY query ORDER BY n DESC, label) = 1")
def knn_vote(spark, d):
    """Five nearest neighbours vote."""
    return models.vote(found(spark, d, 5), 5)


@query(f"""WITH {KNN}, v AS (SELECT k, query, any_value(actual) AS actual, label, count(*) AS n FROM n, range(1, 21) t(k) WHERE place <= k GROUP BY k, query, label)
, p AS (SELECT k, actual, label FROM v QUALIFY row_number() OVER (PARTITION BY k, query ORDER BY n DESC, label) = 1)
SELECT k::INT AS k, round(avg((actual = label)::INT), 6) AS accuracy FROM p GROUP BY 1""")
def knn_k_sweep(spark, d):
    """Accuracy for 1 to 20 neighbours."""
    near = found(spark, d, 20)
    every = near.withColumn("k", F.explode(F.sequence("place", F.lit(20))))
    counts = every.groupBy("k", "query", "label").agg(F.count(F.lit(1)).alias("n"))
    votes = counts.groupBy("k", "query").agg((-F.max(F.struct("n", (-F.col("label")).alias("l")))["l"]).alias("predicted"))
    actual = read_table(spark, d, "embeddings").select(F.col("vec_id").alias("query"), "label")
    return rounded(votes.join(actual, "query").groupBy("k").agg(F.avg((F.col("label") == F.col("predicted")).cast("double")).alias("accuracy")), 6, "accuracy")


@query("SELECT round(count(*) * (var_pop(l_quantity) + var_pop(l_discount)), 3) AS cost FROM lineitem")
def wcss_k1(spark, d):
    """The cost of a single cluster."""
    return rounded(cluster.single_cost(read_table(spark, d, "lineitem"), ["l_quantity", "l_discount"]), 3, "cost")


CENTRES = [(10.0, 0.02), (25.0, 0.05), (40.0, 0.08)]


@query("""WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, """ + ", ".join(f"(l_quantity - {a}) ^ 2 + (l_discount - {b}) ^ 2 AS d{k}" for k, (a, b) in enumerate(CENTRES)) + """ FROM lineitem)
SELECT CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END::INT AS cluster, count(*)::BIGINT AS n, round(sum(least(d0, d1, d2)), 3) AS cost FROM f GROUP BY 1""")
def nearest_centre(spark, d):
    """Rows at given centres and their cost."""
    df = cluster.assign(read_table(spark, d, "lineitem"), ["l_quantity", "l_discount"], CENTRES)
    return rounded(df.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("distance2").alias("cost")), 3, "cost")


def balances(spark, d):
    return read_table(spark, d, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"))


@query()
def kmeans_profile(spark, d):
    """k-means with the best of several seeds, and each cluster's means."""
    df = balances(spark, d)
    model = cluster.kmeans(df, ["c_acctbal", "nation"], 5, starts=10)
    labelled = model.transform(cluster.assembled(df, ["c_acctbal", "nation"]))
    return labelled.groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean_balance"), F.round(F.avg("nation"), 4).alias("mean_nation"))


@query()
def kmeans_elbow(spark, d):
    """Cost by number of clusters."""
    return cluster.elbow(balances(spark, d), ["c_acctbal", "nation"], range(1, 6), starts=1)


@query()
def automatic_k(spark, d):
    """The number of clusters by the stop rule."""
    return timeseries.chosen_k(cluster.elbow(balances(spark, d), ["c_acctbal", "nation"], range(1, 9), starts=1))


def labelled(spark, d):
    return scored_features(spark, d).withColumnRenamed("y", "label")


def scored_features(spark, d):
    text = F.col("text")
    docs = read_table(spark, d, "documents").select("doc_id", "lang", F.length(text).cast("double").alias("chars"), (F.regexp_count(text, F.lit("[#$%&|*!]")) / F.greatest(F.length(text), F.lit(1))).alias("symbols"), (F.regexp_count(text, F.lit("[A-Z]")) / F.greatest(F.length(text), F.lit(1))).alias("capitals"))
    return read_table(spark, d, "labels").join(docs, "doc_id").select("doc_id", F.col("quality").cast("double").alias("y"), "lang", "chars", "symbols", "capitals")


NUMBERS, CATEGORIES = ("chars", "symbols", "capitals"), ("lang",)


def parts(spark, d):
    """Train and test rows, assembled by a preprocessor that is fitted on train."""
    df = labelled(spark, d)
    train, test = df.where(F.crc32(F.col("doc_id").cast("string")) % 10 >= 3), df.where(F.crc32(F.col("doc_id").cast("string")) % 10 < 3)
    fitted = models.preprocessor(NUMBERS, CATEGORIES).fit(train)
    return fitted.transform(train), fitted.transform(test), train, test


def measured(model, test):
    return metrics.accuracy(model.transform(test), "label", "prediction")


@query()
def logistic_model(spark, d):
    """Imputed, scaled and one-hot features, logistic regression, accuracy on unseen rows."""
    train, test, *_ = parts(spark, d)
    return measured(models.logistic_regression(train.count()).fit(train), test)


@query()
def linear_svm_model(spark, d):
    """A linear SVM, one class against the rest (L3)."""
    train, test, *_ = parts(spark, d)
    return measured(models.linear_svm().fit(train), test)


@query()
def tree_models(spark, d):
    """A decision tree, a random forest and boosted trees."""
    train, test, *_ = parts(spark, d)
    made = {"tree": models.decision_tree(), "forest": models.random_forest(trees=100, depth=6), "boosted": models.boosted_trees(rounds=20, depth=4)}
    out = [measured(m.fit(train), test).select(F.lit(name).alias("model"), "accuracy") for name, m in made.items()]
    return out[0].union(out[1]).union(out[2])


@query()
def kernel_svms(spark, d):
    """Approximate kernel SVMs with probabilities (L4)."""
    *_, train, test = parts(spark, d)
    scale = lambda df: df.withColumn("chars", F.log1p("chars") / 10)
    out = [measured(models.kernel_svm(scale(train), NUMBERS, "label", kernel), scale(test)).select(F.lit(kernel).alias("kernel"), "accuracy") for kernel in ("rbf", "poly")]
    return out[0].union(out[1])


@query()
def regressions(spark, d):
    """Linear regression and a forest on several features, measured on unseen rows."""
    df = cluster.assembled(read_table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"]).select("features", F.col("l_extendedprice").alias("label"), (F.crc32(F.concat_ws("-", "l_orderkey", "l_linenumber")) % 10).alias("part"))
    train, test = df.where("part >= 3"), df.where("part < 3")
    out = [metrics.regression_metrics(m.fit(train).transform(test), "label", "prediction").select(F.lit(name).alias("model"), "rmse", "mae", "r2") for name, m in (("linear", models.linear_regression()), ("forest", models.forest_regressor(trees=20, depth=6)))]
    return out[0].union(out[1])


@query()
def pca_project(spark, d):
    """Centred principal components, first two."""
    df = vectors(spark, d)
    return models.pca(NB, 2).fit(df).transform(df).select("vec_id", F.round(F.abs(models.vector_to_array("components")[0]), 6).alias("c0"), F.round(F.abs(models.vector_to_array("components")[1]), 6).alias("c1"))


@query()
def grid_search(spark, d):
    """Two-fold search of nine points (C and gamma) of a kernel SVM, refitted on all training rows."""
    *_, train, test = parts(spark, d)
    scale = lambda df: df.withColumn("chars", F.log1p("chars") / 10).withColumn("fold", F.crc32(F.concat("doc_id", F.lit("fold"))) % 2)
    rows, unseen = models.sized(scale(train)).cache(), scale(test)
    try:
        n = rows.count()
        fit = lambda df, c, gamma: models.kernel_svm(df, NUMBERS, "label", "rbf", gamma=gamma, reg=1 / (c * n), max_iter=10)
        score = lambda k, p: metrics.accuracy(fit(rows.where(F.col("fold") != k), **p).transform(rows.where(F.col("fold") == k)), "label", "prediction").first()[0]
        points = [{"c": c, "gamma": g} for c in (0.1, 1.0, 10.0) for g in (0.1, 1.0, 10.0)]
        found = models.each_of(points, lambda p: sum(score(k, p) for k in (0, 1)) / 2)
        best = max(zip(found, range(len(points))), key=lambda x: (x[0], -x[1]))[1]
        return measured(fit(rows, **points[best]), unseen).select(F.lit(points[best]["c"]).alias("c"), F.lit(points[best]["gamma"]).alias("gamma"), F.lit(len(points)).alias("points"), "accuracy")
    finally:
        rows.unpersist()


@query()
def validated_search(spark, d):
    """Scores of each of 81 points of a grid of a forest regressor, on rows apart from those of the fit."""
    df = cluster.assembled(read_table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice", (F.length("p_name")).alias("name")), ["p_size", "name"]).select("features", F.col("p_retailprice").alias("label"), (F.crc32(F.col("p_partkey").cast("string")) % 10).alias("part"))
    df = models.sized(df).cache()
    try:
        train, valid = df.where("part >= 3"), df.where("part < 3")
        grid = {"trees": [2, 4, 6], "depth": [2, 3, 4], "leaf": [1, 2, 4], "seed": [1, 2, 3]}
        make = lambda **p: models.forest_regressor(**p)
        found = list(models.searched(train, valid, make, grid, lambda p: metrics.regression_metrics(p, "label", "prediction").first()["rmse"]))
        return spark.createDataFrame([(*p.values(), s) for p, s in found], "trees int, depth int, leaf int, seed int, rmse double")
    finally:
        df.unpersist()


@query()
def window_forecast(spark, d):
    """A linear model of the next value from the ten before it, fitted on the first 70 percent and measured on the rest."""
    df = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    windows = split.sequential_split(timeseries.sliding_windows(df, "o_totalprice", ["o_orderdate", "o_orderkey"], 10).select("o_orderdate", "o_orderkey", "window", "target"), ["o_orderdate", "o_orderkey"], 0.7)
    return metrics.regression_metrics(models.window_regression(windows, 10).fit(windows.where("is_train")).transform(windows.where("NOT is_train")), "target", "prediction")


@query()
def saved_model(spark, d):
    """A fitted pipeline saved, read again and applied to one row."""
    *_, train, test = parts(spark, d)
    model = Pipeline(stages=[*models.preprocessor(NUMBERS, CATEGORIES).getStages(), models.logistic_regression(train.count())]).fit(train)
    path = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    sinks.save_model(model, path)
    row = spark.createDataFrame([(1, "en", 1200.0, 0.0, 0.02)], "doc_id int, lang string, chars double, symbols double, capitals double")
    return sinks.load_model(path).transform(row).select("doc_id", "prediction", models.score_of().alias("probability"))


@query()
def decision_mesh(spark, d):
    """Predictions over a mesh of two features."""
    df = cluster.assembled(labelled(spark, d), ["symbols", "capitals"])
    model = models.logistic_regression(df.count()).fit(df)
    axis = lambda name: spark.range(11).select((F.col("id") / 10).alias(name))
    return model.transform(cluster.assembled(axis("symbols").crossJoin(axis("capitals")), ["symbols", "capitals"])).select("symbols", "capitals", "prediction")


@example()
def generated_regression(spark, d):
    """Generated rows and their F statistics."""
    return select.f_regression(readers.make_regression(spark, 1000, 4, 1.0, informative=2), ["x0", "x1", "x2", "x3"], "y").drop("df2")
