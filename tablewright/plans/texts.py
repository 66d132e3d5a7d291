"""Term counts, TF-IDF, similarities; itemsets and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..operators import baskets, blocks, text
from ..sources.readers import read_table
from .profiles import rounded
from .registry import example, query

TOKENS = r"tok AS (SELECT doc_id, t AS term FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+')) AS t FROM documents) WHERE length(t) >= 2)"
STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)
TOP = f"WITH {TOKENS}, v AS (SELECT term FROM tok WHERE term NOT IN ({STOP}) GROUP BY 1 ORDER BY count(*) DESC, term LIMIT 100), c AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM tok JOIN v USING (term) GROUP BY 1, 2)"
WEIGHTS = TOP + """, n AS (SELECT count(*) AS n FROM documents), df AS (SELECT term, count(*) AS df FROM c GROUP BY 1)
, raw AS (SELECT doc_id, term, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS raw FROM c JOIN df USING (term), n)
, w AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


def documents(spark, d):
    return read_table(spark, d, "documents").select("doc_id", "text")


def top_counts(spark, d):
    return text.term_counts(documents(spark, d), "doc_id", "text", text.STOP_WORDS, 100)


def weights(spark, d):
    df = documents(spark, d)
    return text.tf_idf(top_counts(spark, d), "doc_id", df.agg(F.count(F.lit(1)).alias("n")))


@query(f"WITH {TOKENS} SELECT term, count(*)::BIGINT AS n, count(DISTINCT doc_id)::BIGINT AS n_docs FROM tok GROUP BY 1")
def token_counts(spark, d):
    """Counts of all terms."""
    counts = text.term_counts(documents(spark, d), "doc_id", "text")
    return counts.groupBy("term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("n_docs"))


@query(TOP + " SELECT * FROM c")
def count_vectors(spark, d):
    """Counts of the 100 most frequent terms without stop words."""
    return top_counts(spark, d)


@query(WEIGHTS + " SELECT doc_id, term, round(weight, 6) AS weight FROM w")
def tfidf_topk(spark, d):
    """Smoothed TF-IDF weights, each document of length 1."""
    return rounded(weights(spark, d), 6, "weight")


# At 6 digits, no more than 120,000 cosines lie between two of these; more would not fit a file's dictionary
# of 1 MB. Cosines of texts in different languages are small and many, so bands are narrow there.
EDGES = (0.01, 0.02, 0.06, 0.12, 0.24, 0.36, 0.48, 0.6, 0.72, 0.84, 0.92)


@query(WEIGHTS + " SELECT a.doc_id AS a, b.doc_id AS b, round(sum(a.weight * b.weight), 6) AS cosine FROM w a JOIN w b USING (term) WHERE a.doc_id % 50 = 0 AND a.doc_id <> b.doc_id GROUP BY 1, 2")
def query_cosine(spark, d):
    """Similarity of a stated set of query documents to all others."""
    w = weights(spark, d)
    return text.similarities(w, "doc_id", queries=w.where("doc_id % 50 = 0"), digits=6, edges=EDGES)


NEW_TEXTS = [(-1, "the committee will report on the market and the weather in the capital"), (-2, "zzz no term of these is known zzzz"), (-3, "house water school house music water house")]
NEW = ", ".join(f"({k}, '{x}')" for k, x in NEW_TEXTS)


@query(WEIGHTS + rf"""
, q AS (SELECT id, t AS term, count(*) AS tf FROM (SELECT id, unnest(regexp_split_to_array(lower(txt), '[^\p{{L}}\p{{N}}_]+')) AS t FROM (VALUES {NEW}) t(id, txt)) GROUP BY 1, 2)
, qr AS (SELECT id, term, q.tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS raw FROM q JOIN df USING (term), n)
, qw AS (SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM qr)
SELECT qw.id AS a, w.doc_id AS b, round(sum(qw.weight * w.weight), 6) AS cosine FROM qw JOIN w USING (term) GROUP BY 1, 2""")
def new_text_cosine(spark, d):
    """New texts, weighed by the vocabulary and frequencies of the corpus, against all its documents."""
    counts = top_counts(spark, d)
    fit = text.idf(counts, documents(spark, d).agg(F.count(F.lit(1)).alias("n")))
    new = spark.createDataFrame(NEW_TEXTS, "doc_id long, text string")
    queries = text.weighted(text.term_counts(new, "doc_id", "text", known=F.broadcast(fit)), "doc_id", fit)  # at most 100 terms
    return rounded(text.similarities(text.weighted(counts, "doc_id", fit), "doc_id", queries=queries), 6, "cosine")


@query(WEIGHTS + " SELECT a.doc_id AS a, b.doc_id AS b, round(sum(a.weight * b.weight), 6) AS cosine FROM w a JOIN w b USING (term) WHERE a.doc_id % 50 = 0 AND b.doc_id % 50 = 0 AND a.doc_id < b.doc_id GROUP BY 1, 2 HAVING sum(a.weight * b.weight) >= 0.3")
def document_matrix(spark, d):
    """The matrix of similarities of a stated set of documents, where it is at least 0.3."""
    return rounded(text.similarities(weights(spark, d).where("doc_id % 50 = 0"), "doc_id", 0.3), 6, "cosine")


SIMILAR_LABELS = """
WITH t AS (SELECT label, k, sum(x) AS x FROM (SELECT label, unnest(range(64)) AS k, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY 1, 2)
SELECT a.label AS a, b.label AS b, round(sum(a.x * b.x), 5) AS cosine FROM t a JOIN t b USING (k) WHERE a.label < b.label GROUP BY 1, 2"""


@query(SIMILAR_LABELS)
def doc_similarity(spark, d):
    """Products of all pairs of term vectors, here those of labels."""
    long = A.to_long(read_table(spark, d, "embeddings"), "label", "embedding").groupBy(F.col("i").alias("label"), F.col("j").alias("term")).agg(F.sum(F.col("v").cast("double")).alias("weight"))
    return rounded(text.similarities(long, "label", least=float("-inf")), 5, "cosine")


@query("""
WITH e AS (SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings)
SELECT q.vec_id AS query, e.vec_id, round(list_cosine_similarity(q.v, e.v), 6) AS cosine FROM e q, e WHERE q.vec_id % 50 = 0 AND q.vec_id <> e.vec_id""")
def cosine_pairs(spark, d):
    """Cosine of query vectors and all others."""
    df = read_table(spark, d, "embeddings").select("vec_id", "embedding")
    return blocks.vector_cosines(df.where("vec_id % 50 = 0"), df, "vec_id", "embedding", 64, 6).select(F.col("a").alias("query"), F.col("b").alias("vec_id"), "cosine")


def brand_baskets(spark, d):
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    return baskets.from_long(lines.join(read_table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")), "l_orderkey", "p_brand")


BASKETS = "b AS (SELECT DISTINCT l_orderkey, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey), n AS (SELECT count(DISTINCT l_orderkey) AS n FROM b), one AS (SELECT item, count(*) AS freq FROM b GROUP BY 1), two AS (SELECT x.item AS i, y.item AS j, count(*) AS freq FROM b x JOIN b y USING (l_orderkey) WHERE x.item < y.item GROUP BY 1, 2)"


@query(f"WITH {BASKETS} SELECT l_orderkey, list(item ORDER BY item) AS items FROM b GROUP BY 1")
def baskets_of_orders(spark, d):
    """Distinct items by basket, in order."""
    return brand_baskets(spark, d)


@example("SELECT * FROM (VALUES (1, ['ale', 'bread']), (2, ['ale']), (3, [])) t(id, items)")
def baskets_from_wide(spark, d):
    """Baskets from a wide table with blanks and repeats (Q1)."""
    df = spark.createDataFrame([(1, "bread", "ale", "bread"), (2, None, "ale", None), (3, None, None, None)], "id int, a string, b string, c string")
    return baskets.from_wide(df, "id", ["a", "b", "c"])


@query(f"WITH {BASKETS} SELECT [item] AS items, freq::BIGINT AS freq, round(freq / n::DOUBLE, 6) AS support, 1::INT AS length FROM one, n WHERE freq >= ceil(0.01 * n) UNION ALL SELECT [i, j], freq, round(freq / n::DOUBLE, 6), 2 FROM two, n WHERE freq >= ceil(0.01 * n)")
def frequent_pairs(spark, d):
    """Itemsets of at most two items with a support of at least 0.01 (Q4, Q5, Q6)."""
    return rounded(baskets.itemsets(brand_baskets(spark, d), 0.01, max_length=2), 6, "support")


@query(f"""WITH {BASKETS}, r AS (SELECT i AS x, j AS y, freq FROM two UNION ALL SELECT j, i, freq FROM two)
, m AS (SELECT [x] AS antecedent, [y] AS consequent, r.freq / n::DOUBLE AS support, r.freq / ox.freq::DOUBLE AS confidence, r.freq / ox.freq::DOUBLE / (oy.freq / n::DOUBLE) AS lift, r.freq, n FROM r JOIN one ox ON ox.item = x JOIN one oy ON oy.item = y, n)
SELECT antecedent, consequent, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM m WHERE freq >= ceil(0.01 * n) AND confidence >= 0.1""")
def rules_lift(spark, d):
    """Rules of two items with support, confidence and lift (Q2, Q3)."""
    return rounded(baskets.rules(baskets.itemsets(brand_baskets(spark, d), 0.01, max_length=2), 0.1), 6, "support", "confidence", "lift")


# Five baskets whose itemsets are well known.
MEALS = [["Milk", "Onion", "Nutmeg", "Kidney Beans", "Eggs", "Yogurt"], ["Dill", "Onion", "Nutmeg", "Kidney Beans", "Eggs", "Yogurt"], ["Milk", "Apple", "Kidney Beans", "Eggs"], ["Milk", "Unicorn", "Corn", "Kidney Beans", "Yogurt"], ["Corn", "Onion", "Kidney Beans", "Ice cream", "Eggs"]]
VALUES = ", ".join(f"({k}, '{x}')" for k, xs in enumerate(MEALS) for x in xs)
SETS = f"""b AS (SELECT * FROM (VALUES {VALUES}) t(id, item)), one AS (SELECT [item] AS items, count(*)::BIGINT AS freq FROM b GROUP BY 1)
, two AS (SELECT [x.item, y.item] AS items, count(*)::BIGINT AS freq FROM b x JOIN b y USING (id) WHERE x.item < y.item GROUP BY 1)
, three AS (SELECT [x.item, y.item, z.item] AS items, count(*)::BIGINT AS freq FROM b x JOIN b y USING (id) JOIN b z USING (id) WHERE x.item < y.item AND y.item < z.item GROUP BY 1)
, s AS (SELECT items, freq, freq / 5.0::DOUBLE AS support, len(items)::INT AS length FROM (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three) WHERE freq >= 3)"""


def meals(spark):
    return baskets.itemsets(spark.createDataFrame([(m,) for m in MEALS], "items array<string>"), 0.6)


@example(f"WITH {SETS} SELECT items, freq, round(support, 6) AS support, length FROM s")
def itemsets_golden(spark, d):
    """Itemsets of five baskets (Q4)."""
    return rounded(meals(spark), 6, "support")


@example(f"WITH {SETS} SELECT items, round(support, 6) AS support FROM s WHERE length = 2 AND support >= 0.8")
def itemsets_of_two(spark, d):
    """Itemsets by size and support, and one by its items in any order."""
    sets = meals(spark).where("length = 2 AND support >= 0.8")
    return rounded(sets.where(F.array_sort("items") == F.array_sort(F.array(F.lit("Kidney Beans"), F.lit("Eggs")))).select("items", "support"), 6, "support")


@example(f"""WITH {SETS}
, split AS (SELECT s.items, s.support, a.items AS antecedent, a.support AS sa, list_sort(list_filter(s.items, lambda x: NOT list_contains(a.items, x))) AS consequent FROM s JOIN s a ON a.length < s.length AND list_has_all(s.items, a.items))
SELECT antecedent, consequent, round(split.support, 6) AS support, round(split.support / sa, 6) AS confidence, round(split.support / sa / c.support, 6) AS lift FROM split JOIN s c ON c.items = consequent""")
def rules_golden(spark, d):
    """All rules of five baskets, consequents of several items included (Q2)."""
    return rounded(baskets.rules(meals(spark)), 6, "support", "confidence", "lift")
