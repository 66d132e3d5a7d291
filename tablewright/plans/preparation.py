"""Imputation, recoding, label codes, dummies, scaling, splits and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prep, split
from ..sources.readers import read_table
from .profiles import HOLED, holed_customer, rounded
from .registry import example, query


@query(f"SELECT * FROM ({HOLED}) WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL AND c_nationkey IS NOT NULL")
def drop_any_null(spark, d):
    """Rows without a null."""
    return holed_customer(spark, d).dropna("any")


@query(f"SELECT * FROM ({HOLED}) WHERE c_mktsegment IS NOT NULL")
def drop_null_subset(spark, d):
    """Rows with a value in one column."""
    return holed_customer(spark, d).dropna(subset=["c_mktsegment"])


@query(f"SELECT c_acctbal FROM ({HOLED}) WHERE c_acctbal IS NOT NULL")
def column_present(spark, d):
    """A column's values that aren't null."""
    return holed_customer(spark, d).select("c_acctbal").dropna()


@query(f"WITH h AS ({HOLED}) SELECT c_custkey, round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM h)), 4) AS c_acctbal FROM h")
def mean_impute(spark, d):
    """Nulls filled with the mean."""
    return rounded(prep.impute(holed_customer(spark, d).select("c_custkey", "c_acctbal"), {"c_acctbal": "mean"}), 4, "c_acctbal")


@query(f"""WITH h AS ({HOLED})
SELECT c_custkey, coalesce(c_mktsegment, (SELECT c_mktsegment FROM h WHERE c_mktsegment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS c_mktsegment,
  coalesce(c_nationkey, (SELECT c_nationkey FROM h WHERE c_nationkey IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS c_nationkey FROM h""")
def mode_impute(spark, d):
    """Nulls of text and numbers filled with the mode."""
    return prep.impute(holed_customer(spark, d).select("c_custkey", "c_mktsegment", "c_nationkey"), {"c_mktsegment": "mode", "c_nationkey": "mode"})


@query(f"WITH h AS ({HOLED}), m AS (SELECT avg(c_acctbal) AS m FROM h WHERE c_custkey % 4 <> 0) SELECT c_custkey, round(coalesce(c_acctbal, m), 4) AS c_acctbal FROM h, m")
def impute_fit_on_train(spark, d):
    """A mean fitted on the training rows fills all."""
    h = holed_customer(spark, d).select("c_custkey", "c_acctbal")
    return rounded(prep.impute(h, {"c_acctbal": "mean"}, fit_on=h.where("c_custkey % 4 <> 0")), 4, "c_acctbal")


@query(f"WITH h AS ({HOLED}) SELECT c_custkey, round(coalesce(c_acctbal, (SELECT quantile_cont(c_acctbal, 0.5) FROM h)), 4) AS c_acctbal FROM h")
def median_impute(spark, d):
    """Nulls filled with the exact median."""
    return rounded(prep.impute(holed_customer(spark, d).select("c_custkey", "c_acctbal"), {"c_acctbal": "median"}), 4, "c_acctbal")


@query(f"SELECT c_custkey, coalesce(c_mktsegment, 'missing') AS c_mktsegment FROM ({HOLED})")
def const_impute(spark, d):
    """Nulls filled with a constant."""
    return prep.impute(holed_customer(spark, d).select("c_custkey", "c_mktsegment"), {"c_mktsegment": "constant"}, constant="missing")


@query("SELECT p_partkey, CASE p_brand WHEN 'Brand#11' THEN 1 WHEN 'Brand#12' THEN 2 END::INT AS code FROM part")
def recode_map(spark, d):
    """Values recoded by a table, others null."""
    return read_table(spark, d, "part").select("p_partkey", prep.recode(F.col("p_brand"), {"Brand#11": 1, "Brand#12": 2}).alias("code"))


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' ELSE c_mktsegment END AS segment FROM customer")
def replace_keep(spark, d):
    """Values replaced by a table, others kept."""
    return read_table(spark, d, "customer").select("c_custkey", prep.recode(F.col("c_mktsegment"), {"BUILDING": "B", "MACHINERY": "M"}, keep_others=True).alias("segment"))


CODES = f"WITH h AS ({HOLED}), e AS (SELECT c_mktsegment, (row_number() OVER (ORDER BY c_mktsegment) - 1)::INT AS code FROM (SELECT DISTINCT c_mktsegment FROM h WHERE c_mktsegment IS NOT NULL))"


@query(CODES + " SELECT c_custkey, coalesce(code, -1)::INT AS c_mktsegment_code FROM h LEFT JOIN e USING (c_mktsegment)")
def label_encode_segment(spark, d):
    """Codes in the order of labels, -1 for null."""
    h = holed_customer(spark, d).select("c_custkey", "c_mktsegment")
    return prep.encode(h, ["c_mktsegment"], prep.encoders(h, ["c_mktsegment"])).select("c_custkey", "c_mktsegment_code")


@query(CODES + " SELECT 'c_mktsegment' AS \"column\", c_mktsegment AS label, code FROM e")
def encoder_table(spark, d):
    """The fitted labels as a table."""
    return prep.encoders(holed_customer(spark, d), ["c_mktsegment"])


@query(f"SELECT c_custkey, c_mktsegment AS c_mktsegment_label FROM ({HOLED})")
def decode_labels(spark, d):
    """Codes turned back into labels."""
    h = holed_customer(spark, d).select("c_custkey", "c_mktsegment")
    table = prep.encoders(h, ["c_mktsegment"])
    return prep.decode(prep.encode(h, ["c_mktsegment"], table), "c_mktsegment", "c_mktsegment_code", table).select("c_custkey", "c_mktsegment_label")


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def flags(labels):
    return ", ".join(f"coalesce((c_mktsegment = '{v}')::INT, 0) AS \"c_mktsegment_{v}\"" for v in labels)


@query(f"SELECT c_custkey, {flags(SEGMENTS)} FROM ({HOLED})")
def one_hot_segment(spark, d):
    """A dummy for each label; null is all zeros."""
    return prep.dummies(holed_customer(spark, d).select("c_custkey", "c_mktsegment"), "c_mktsegment")


@query(f"SELECT c_custkey, {flags(SEGMENTS[1:])} FROM ({HOLED})")
def one_hot_drop_first(spark, d):
    """Dummies without the first label's."""
    return prep.dummies(holed_customer(spark, d).select("c_custkey", "c_mktsegment"), "c_mktsegment", drop_first=True)


FRUIT = ["apple", "banana", "orange", "apple", "grape"]


@example("SELECT ['apple', 'banana', 'grape', 'orange'] AS vocabulary, [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 0, 1], [1, 0, 0, 0], [0, 0, 1, 0]]::INT[][] AS rows")
def one_hot_vocabulary(spark, d):
    """One-hot rows over a sorted vocabulary."""
    df = spark.createDataFrame([(FRUIT,)], "words array<string>").withColumn("vocabulary", F.array_sort(F.array_distinct("words")))
    return df.select("vocabulary", prep.one_hot_of(F.col("words"), F.col("vocabulary")).alias("rows"))


@query("""SELECT l_orderkey, """ + ", ".join(f"max((p_type = '{t}')::INT) AS \"{t}\"" for t in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")) + """ FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def basket_matrix(spark, d):
    """Baskets as a 0/1 matrix of items in order."""
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(read_table(spark, d, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return prep.baskets_matrix(lines, "l_orderkey", "p_type")


@query("SELECT n_name, CASE n_regionkey WHEN 0 THEN [0.1, 0.2] WHEN 1 THEN [0.3, 0.4] END::DOUBLE[] AS vector FROM nation")
def embedding_lookup(spark, d):
    """Vectors from a look-up table, null if there is none."""
    table = spark.createDataFrame([(0, [0.1, 0.2]), (1, [0.3, 0.4])], "n_regionkey int, vector array<double>")
    return read_table(spark, d, "nation").join(F.broadcast(table), "n_regionkey", "left").select("n_name", "vector")  # two rows


@query("SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal FROM customer")
def standard_scale_acctbal(spark, d):
    """Mean 0 and population deviation 1."""
    df = read_table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return rounded(prep.scale(df, ["c_acctbal"], prep.scale_fit(df, ["c_acctbal"])), 6, "c_acctbal")


@query("WITH f AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer WHERE c_custkey % 4 <> 0) SELECT c_custkey, round((c_acctbal - m) / s, 6) AS c_acctbal FROM customer, f")
def scale_fit_on_train(spark, d):
    """A scaler fitted on the training rows scales all."""
    df = read_table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return rounded(prep.scale(df, ["c_acctbal"], prep.scale_fit(df.where("c_custkey % 4 <> 0"), ["c_acctbal"])), 6, "c_acctbal")


@query("SELECT c_custkey, round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 6) AS c_acctbal FROM customer")
def minmax_acctbal(spark, d):
    """Scaled to 0..1."""
    df = read_table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return rounded(prep.scale(df, ["c_acctbal"], prep.scale_fit(df, ["c_acctbal"]), "minmax"), 6, "c_acctbal")


@query("SELECT c_custkey, round(c_acctbal, 4) AS c_acctbal FROM customer")
def minmax_inverse(spark, d):
    """Scaled to 0..1 and back."""
    df = read_table(spark, d, "customer").select("c_custkey", "c_acctbal")
    fit = prep.scale_fit(df, ["c_acctbal"])
    return rounded(prep.unscale_minmax(prep.scale(df, ["c_acctbal"], fit, "minmax"), ["c_acctbal"], fit), 4, "c_acctbal")


RANK = "row_number() OVER ({by} ORDER BY md5({key}::VARCHAR || '#42'), {key})"


@query(f"SELECT c_custkey, {RANK.format(by='', key='c_custkey')} <= ceil(count(*) OVER () * 0.3) AS is_test FROM customer")
def train_test_split(spark, d):
    """An exact split in hash order."""
    return split.train_test_split(read_table(spark, d, "customer").select("c_custkey"), ["c_custkey"], 0.3)


@query(f"SELECT c_custkey, c_mktsegment, {RANK.format(by='PARTITION BY c_mktsegment', key='c_custkey')} <= ceil(count(*) OVER (PARTITION BY c_mktsegment) * 0.3) AS is_test FROM customer")
def stratified_split(spark, d):
    """An exact split of each stratum."""
    return split.train_test_split(read_table(spark, d, "customer").select("c_custkey", "c_mktsegment"), ["c_custkey"], 0.3, stratify=["c_mktsegment"])


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor(0.7 * count(*) OVER ()) AS is_train FROM orders")
def sequential_split(spark, d):
    """The first 70 percent by time."""
    df = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return split.sequential_split(df, ["o_orderdate", "o_orderkey"], 0.7).select("o_orderkey", "is_train")


@query(f"WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) SELECT o_orderkey, o_orderstatus FROM (SELECT o_orderkey, o_orderstatus, {RANK.format(by='PARTITION BY o_orderstatus', key='o_orderkey')} AS k FROM orders) WHERE k <= (SELECT min(n) FROM c)")
def undersample(spark, d):
    """As many rows of each label as of the rarest (T4)."""
    return split.undersample(read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["o_orderkey"])


@query(f"""
WITH r AS (SELECT o_orderkey, o_orderstatus, {RANK.format(by='PARTITION BY o_orderstatus', key='o_orderkey')} AS k, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
, m AS (SELECT max(n) AS most FROM r)
SELECT o_orderkey, o_orderstatus, unnest(range((most // n + CASE WHEN k <= most % n THEN 1 ELSE 0 END)::BIGINT))::INT AS copy FROM r, m""")
def oversample(spark, d):
    """Rows repeated so that each label has as many as the commonest (T5)."""
    return split.oversample(read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["o_orderkey"])


@query("SELECT c_custkey, c_acctbal, c_nationkey FROM customer")
def features_without_label(spark, d):
    """Features apart from the label."""
    return read_table(spark, d, "customer").drop("c_mktsegment", "c_name").select("c_custkey", "c_acctbal", "c_nationkey")
