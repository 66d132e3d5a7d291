"""Learners that Spark has no twin of, measured on rows that they haven't seen; similar documents; rules of any length."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import baskets, boosting, kernel, metrics, recurrent, similarity, split, text, timeseries
from ..sources.readers import read_table
from ..staging import Staging
from .models import NUMBERS, labelled
from .profiles import rounded
from .registry import query
from .texts import BASKETS, TOKENS, brand_baskets, documents


def apart(df, key, folds=4):
    """Train and test rows, by a hash of the key."""
    part = F.crc32(F.col(key).cast("string")) % folds
    return df.where(part > 0), df.where(part == 0)


@query()
def boosted_classes(spark, d):
    """Second-order boosted trees of three classes of embeddings (L8): loss on unseen rows beside what the shares of the classes give.

    The table's own labels don't depend on its vectors, so a class is which of the first three components is the largest.
    """
    x = F.col("embedding").cast("array<double>")
    df = read_table(spark, d, "embeddings").select("vec_id", x.alias("x"), F.array_position(F.slice(x, 1, 3), F.array_max(F.slice(x, 1, 3))).alias("y"))
    train, test = apart(df, "vec_id")
    model = boosting.boost(train, "x", "y", rounds=10, depth=3, bins=32)
    return rounded(boosting.log_loss(boosting.boosted_scores(test, model, "x"), model, "y"), 6, "log_loss", "accuracy", "majority_log_loss")


@query()
def recurrent_forecast(spark, d):
    """Two layers of LSTM cells on windows of 60 values, fitted on the first 70 percent (L12): error on the rest beside that of the last value."""
    order = ["o_orderdate", "o_orderkey"]
    df = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    windows = timeseries.sliding_windows(df, "o_totalprice", order, 60).select(*order, "window", "target")
    marked = split.sequential_split(windows, order, 0.7)
    model = recurrent.train(marked.where("is_train"), 60, hidden=8, layers=2, epochs=2, parts=6, rate=0.02)
    scored = recurrent.forecasts(marked.where("NOT is_train"), model).select("target", "forecast", F.element_at("window", -1).alias("before"))
    scored = Staging().__enter__()(scored)  # measured twice; this table is the result's own and stays
    ours = metrics.regression_metrics(scored, "target", "forecast").select("mse", "rmse", "mae")
    last = scored.agg(F.avg(F.pow(F.col("before") - F.col("target"), 2)).alias("last_value_mse"))
    return ours.crossJoin(last)  # one row each


@query()
def kernel_machines(spark, d):
    """Support vector machines of two kernels with their duality gaps (L4): accuracy on unseen rows beside the commoner label's share."""
    scaled = F.array(F.log1p("chars") / 10, *[F.col(c) for c in NUMBERS[1:]])
    # The texts are read once; this table is the result's own and stays.
    train, test = apart(Staging().__enter__()(labelled(spark, d).select("doc_id", "label", scaled.alias("x"))), "doc_id")
    out = None
    for name, own in (("rbf", {}), ("poly", {"degree": 3, "offset": 1.0})):
        model = kernel.fit(train, "x", "label", kernel=name, landmarks=100, **own)
        fitted = kernel.platt(kernel.with_margin(train, model, "x"), "margin", "label")
        scored = kernel.with_margin(test, model, "x").withColumn("p", kernel.probability("margin", fitted))
        right, ups = ((F.col("margin") > 0).cast("double") == F.col("label")).cast("double"), F.avg("label")
        row = scored.agg(F.avg(right).alias("accuracy"), F.greatest(ups, 1 - ups).alias("majority"), F.avg(F.pow(F.col("p") - F.col("label"), 2)).alias("brier"))
        row = row.select(F.lit(name).alias("kernel"), F.lit(float(model.gap)).alias("gap"), "accuracy", "majority", "brier")
        out = row if out is None else out.unionByName(row)
    return out


LINKED = f"""
WITH {TOKENS}, c AS MATERIALIZED (SELECT doc_id, term, count(*)::BIGINT AS tf FROM tok GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM documents), df AS (SELECT term, count(*) AS df FROM c GROUP BY 1)
, raw AS (SELECT doc_id, term, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS raw FROM c JOIN df USING (term), n)
, h AS (SELECT doc_id, list((term, tf) ORDER BY term) AS v FROM c GROUP BY 1), m AS MATERIALIZED (SELECT doc_id, min(doc_id) OVER (PARTITION BY v) AS class FROM h)
, w AS MATERIALIZED (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw WHERE doc_id IN (SELECT class FROM m))
, p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM w a JOIN w b USING (term) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2 HAVING round(sum(a.weight * b.weight), 9) >= 0.8)
SELECT doc_id, class, coalesce(k, 0)::BIGINT AS n_links FROM m LEFT JOIN (SELECT a AS class, count(*) AS k FROM p GROUP BY 1) USING (class)"""


@query(LINKED)
def similar_documents(spark, d):
    """All documents whose TF-IDF vectors, of all terms, have a cosine of 0.8 (W4, W6): each with its class of equal ones, and the classes that it is linked with."""
    df = documents(spark, d)
    with Staging() as keep:
        counts = keep(text.term_counts(df, "doc_id", "text"))
        weights = text.tf_idf(counts, "doc_id", df.agg(F.count(F.lit(1)).alias("n")))
        return similarity.similar_documents(counts, weights, "doc_id", 0.8)


def sets_of(k):
    """SQL of the sets of k items; an order has seven lines at most."""
    joins = "".join(f" JOIN b b{i} ON b{i}.l_orderkey = b1.l_orderkey AND b{i - 1}.item < b{i}.item" for i in range(2, k + 1))
    return f"SELECT [{', '.join(f'b{i}.item' for i in range(1, k + 1))}] AS items, count(*) AS freq FROM b b1{joins} GROUP BY ALL"


ANY_RULES = f"""
WITH {BASKETS}, least AS (SELECT ceil(round(n * 0.002, 9)) AS least FROM n)
, sets AS (SELECT items, freq FROM ({" UNION ALL ".join(map(sets_of, range(1, 8)))}), least WHERE freq >= least)
, parts AS (SELECT items, freq, list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS antecedent, list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 0) AS consequent FROM (SELECT *, unnest(range(1, (1 << len(items)) - 1)) AS mask FROM sets WHERE len(items) > 1))
SELECT antecedent, consequent, round(p.freq / n::DOUBLE, 9) AS support, round((p.freq / n::DOUBLE) / (a.freq / n::DOUBLE), 9) AS confidence, round((p.freq / n::DOUBLE) / (a.freq / n::DOUBLE) / (c.freq / n::DOUBLE), 6) AS lift
FROM parts p JOIN sets a ON a.items = antecedent JOIN sets c ON c.items = consequent, n WHERE len(consequent) = 2 OR (p.freq / n::DOUBLE) / (a.freq / n::DOUBLE) >= 0.15"""


@query(ANY_RULES)
def rules_of_any_length(spark, d):
    """Rules from all frequent sets of brands in orders, those with two items on the right among them (Q2, Q4)."""
    sets = baskets.vertical_itemsets(brand_baskets(spark, d).withColumnRenamed("l_orderkey", "basket"), 0.002)
    found = baskets.rules(sets).where("size(consequent) = 2 OR confidence >= 0.15")
    return found.select("antecedent", "consequent", F.round("support", 9).alias("support"), F.round("confidence", 9).alias("confidence"), F.round("lift", 6).alias("lift"))
