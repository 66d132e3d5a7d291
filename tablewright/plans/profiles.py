"""Profiles, aggregates and what plots draw."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile
from ..operators.quantiles import quantiles
from ..sources.readers import read_table
from .registry import example, query


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def holed(df, key, columns, tables=16):
    """Sets values to null for keys whose hash begins with 0 and the column's own digit; the tables have no nulls."""
    return df.withColumns({c: F.when(F.substring(F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit(c))), 1, 1) != "0", F.col(c)) for c in columns})


def holed_sql(table, key, columns, rest=""):
    cells = ", ".join(f"CASE WHEN substr(md5({key}::VARCHAR || '#{c}'), 1, 1) <> '0' THEN {c} END AS {c}" for c in columns)
    return f"SELECT {key}, {cells}{rest} FROM {table}"


HOLED = holed_sql("customer", "c_custkey", ("c_acctbal", "c_mktsegment", "c_nationkey"))


def holed_customer(spark, d):
    return holed(read_table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"), "c_custkey", ("c_acctbal", "c_mktsegment", "c_nationkey"))


@query("SELECT (SELECT count(*) FROM customer)::BIGINT AS n_rows, 5::BIGINT AS n_columns")
def table_shape(spark, d):
    """Rows and columns (F1, F2)."""
    return profile.shape(read_table(spark, d, "customer"))


@query(f"""WITH h AS ({HOLED})
SELECT 'c_custkey' AS "column", 'bigint' AS type, count(c_custkey)::BIGINT AS n_present FROM h UNION ALL SELECT 'c_acctbal', 'double', count(c_acctbal) FROM h
UNION ALL SELECT 'c_mktsegment', 'string', count(c_mktsegment) FROM h UNION ALL SELECT 'c_nationkey', 'int', count(c_nationkey) FROM h""")
def table_info(spark, d):
    """Types and how many values are present."""
    return profile.info(holed_customer(spark, d))


DESCRIBED = "count({c})::BIGINT AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.5) AS median, quantile_cont({c}::DOUBLE, 0.75) AS q3, max({c})::DOUBLE AS max"


@query("SELECT \"column\", count, mean, std, min, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, max FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {DESCRIBED.format(c=c)} FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount")) + ")")
def describe(spark, d):
    """Count, mean, deviation, extremes and quartiles."""
    return rounded(profile.describe(read_table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]), 6, "mean", "std", "q1", "median", "q3")


@query(f"WITH h AS ({HOLED}) SELECT c_custkey, c_acctbal IS NULL AS no_balance, c_mktsegment IS NULL AS no_segment FROM h")
def null_mask(spark, d):
    """Which values are missing."""
    return holed_customer(spark, d).select("c_custkey", F.col("c_acctbal").isNull().alias("no_balance"), F.col("c_mktsegment").isNull().alias("no_segment"))


@query(f"""WITH h AS ({HOLED}) SELECT 'c_custkey' AS "column", count(*) FILTER (c_custkey IS NULL)::BIGINT AS n_null FROM h UNION ALL SELECT 'c_acctbal', count(*) FILTER (c_acctbal IS NULL) FROM h
UNION ALL SELECT 'c_mktsegment', count(*) FILTER (c_mktsegment IS NULL) FROM h UNION ALL SELECT 'c_nationkey', count(*) FILTER (c_nationkey IS NULL) FROM h""")
def null_counts(spark, d):
    """Missing values by column, in one pass."""
    return profile.null_counts(holed_customer(spark, d))


@query(f"WITH h AS ({HOLED}) SELECT bool_or(c_acctbal IS NULL OR c_mktsegment IS NULL) AS any_null FROM h")
def any_null(spark, d):
    """Whether anything is missing."""
    return holed_customer(spark, d).agg(F.bool_or(F.col("c_acctbal").isNull() | F.col("c_mktsegment").isNull()).alias("any_null"))


@query("SELECT sum(n - 1)::BIGINT AS n_duplicated FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderpriority)")
def duplicated(spark, d):
    """Rows beyond the first of their key (F8)."""
    return profile.n_duplicated(read_table(spark, d, "orders"), ["o_custkey", "o_orderpriority"])


@query(f"WITH h AS ({HOLED}) SELECT c_mktsegment, count(*)::BIGINT AS n FROM h WHERE c_mktsegment IS NOT NULL GROUP BY 1")
def value_counts_segment(spark, d):
    """Counts of values, null left out."""
    return profile.value_counts(holed_customer(spark, d), "c_mktsegment")


@query("SELECT round(avg(l_quantity), 6) AS mean, median(l_quantity) AS median, round(var_pop(l_quantity), 6) AS var_pop, round(stddev_pop(l_quantity), 6) AS std_pop, round(var_samp(l_quantity), 6) AS var_samp, round(stddev_samp(l_quantity), 6) AS std_samp FROM lineitem")
def stats_pop_vs_sample(spark, d):
    """Population and sample statistics (A2)."""
    df, x = read_table(spark, d, "lineitem").select("l_quantity"), F.col("l_quantity")
    median = quantiles(df, ["l_quantity"], [0.5]).select(F.col("values")[0].alias("median"))
    moments = df.agg(F.avg(x).alias("mean"), F.var_pop(x).alias("var_pop"), F.stddev_pop(x).alias("std_pop"), F.var_samp(x).alias("var_samp"), F.stddev_samp(x).alias("std_samp"))
    return rounded(moments.crossJoin(F.broadcast(median)).select("mean", "median", "var_pop", "std_pop", "var_samp", "std_samp"), 6, "mean", "var_pop", "std_pop", "var_samp", "std_samp")


@query("SELECT p_size AS mode, count(*)::BIGINT AS n FROM part GROUP BY 1 ORDER BY n DESC, mode LIMIT 1")
def mode_with_count(spark, d):
    """The mode and its count, the smallest of ties (A3)."""
    return profile.most_frequent(read_table(spark, d, "part"), "p_size")


CENTRAL = [2.1, 3.4, 5.6, 4.5, 3.4, 6.7, 8.9, 4.5, 2.1, 4.5]


@example("SELECT round(4.57, 6)::DOUBLE AS mean, 4.5::DOUBLE AS median, 4.5::DOUBLE AS mode")
def central_tendency(spark, d):
    """Mean, median and mode of given numbers (A1)."""
    df = spark.createDataFrame([(x,) for x in CENTRAL], "x double")
    return df.agg(F.round(F.avg("x"), 6).alias("mean"), F.percentile("x", F.lit(0.5)).alias("median"), F.mode("x", True).alias("mode"))


@query(f"WITH h AS ({HOLED}) SELECT c_mktsegment, round(avg(c_acctbal), 4) AS mean_c_acctbal, round(avg(c_nationkey), 4) AS mean_c_nationkey FROM h WHERE c_mktsegment IS NOT NULL GROUP BY 1")
def group_means(spark, d):
    """Means by group, null keys left out."""
    return rounded(profile.group_means(holed_customer(spark, d), ["c_mktsegment"], ["c_acctbal", "c_nationkey"]), 4, "mean_c_acctbal", "mean_c_nationkey")


@query(f"WITH h AS ({HOLED}) SELECT c_mktsegment, c_nationkey, count(c_acctbal)::BIGINT AS n_c_acctbal FROM h WHERE c_mktsegment IS NOT NULL AND c_nationkey IS NOT NULL GROUP BY 1, 2")
def groupby_nonnull_count(spark, d):
    """Values present by two keys (A5)."""
    return profile.group_present(holed_customer(spark, d), ["c_mktsegment", "c_nationkey"], ["c_acctbal"])


@example("SELECT 21::BIGINT AS total, [5, 7, 9]::BIGINT[] AS columns, [6, 15]::BIGINT[] AS rows")
def matrix_sums(spark, d):
    """Sums of a matrix, of its columns and rows."""
    df = spark.createDataFrame([(0, [1, 2, 3]), (1, [4, 5, 6])], "i int, x array<bigint>")
    whole = df.select(F.posexplode("x").alias("j", "v"))
    columns = whole.groupBy("j").agg(F.sum("v").alias("s")).agg(F.sum("s").alias("total"), F.transform(F.sort_array(F.collect_list(F.struct("j", "s"))), lambda p: p["s"]).alias("columns"))
    rows = df.select("i", F.aggregate("x", F.lit(0).cast("long"), lambda a, x: a + x).alias("s")).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "s"))), lambda p: p["s"]).alias("rows"))
    return columns.crossJoin(rows)


CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in CORR for b in CORR))
def corr_matrix(spark, d):
    """Pearson correlations in long form."""
    return rounded(profile.correlations(read_table(spark, d, "lineitem"), CORR), 6, "r")


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for k, a in enumerate(CORR) for b in CORR[k + 1 :]) + ") WHERE r > 0.5")
def corr_above(spark, d):
    """Pairs with a correlation over a limit."""
    return rounded(profile.correlations(read_table(spark, d, "lineitem"), CORR, symmetric=False), 6, "r").where("r > 0.5")


@query("SELECT l_returnflag, min(l_quantity) - 1 AS low, max(l_quantity) + 1 AS high FROM lineitem GROUP BY 1")
def padded_bounds(spark, d):
    """Bounds with a margin."""
    return read_table(spark, d, "lineitem").groupBy("l_returnflag").agg((F.min("l_quantity") - 1).alias("low"), (F.max("l_quantity") + 1).alias("high"))


@query("SELECT CAST(o_orderdate AS DATE)::VARCHAR AS day, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def line_points(spark, d):
    """Points of a line plot, one for each day (V1)."""
    return read_table(spark, d, "orders").groupBy(F.to_date("o_orderdate").cast("string").alias("day")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


def histogram_sql(table, column, bins):
    return f"""WITH b AS (SELECT min({column})::DOUBLE AS lo, (max({column}) - min({column})) / {bins}.0::DOUBLE AS w FROM {table})
, c AS (SELECT least(floor(({column} - lo) / w), {bins - 1})::INT AS bin, count(*)::BIGINT AS n FROM {table}, b GROUP BY 1)
SELECT i::INT AS bin, round(lo + i * w, 6) AS "left", coalesce(n, 0)::BIGINT AS n FROM b, range({bins}) t(i) LEFT JOIN c ON c.bin = i"""


@query(histogram_sql("customer", "c_acctbal", 20))
def hist_balance(spark, d):
    """A histogram of 20 bins (V3)."""
    return rounded(profile.histogram(read_table(spark, d, "customer"), "c_acctbal", 20), 6, "left")


@query(histogram_sql("orders", "o_totalprice", 10))
def hist_price(spark, d):
    """A histogram of 10 bins (V5)."""
    return rounded(profile.histogram(read_table(spark, d, "orders"), "o_totalprice", 10), 6, "left")


@query("SELECT i::INT AS bin, count(l_quantity)::BIGINT AS n FROM range(4) t(i) LEFT JOIN lineitem ON CASE i WHEN 0 THEN l_quantity >= 1 AND l_quantity < 10 WHEN 1 THEN l_quantity >= 10 AND l_quantity < 20 WHEN 2 THEN l_quantity >= 20 AND l_quantity < 35 ELSE l_quantity >= 35 AND l_quantity <= 50 END GROUP BY 1")
def hist_edges(spark, d):
    """A histogram with given edges, the last closed (V4)."""
    return profile.histogram_edges(read_table(spark, d, "lineitem"), "l_quantity", [1, 10, 20, 35, 50])


@query("SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2")
def count_by_flag_status(spark, d):
    """Counts by two columns (V6)."""
    return profile.value_counts(read_table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


@query("""
WITH q AS (SELECT c_mktsegment, quantile_cont(c_acctbal, 0.25) AS q1, quantile_cont(c_acctbal, 0.5) AS median, quantile_cont(c_acctbal, 0.75) AS q3 FROM customer GROUP BY 1)
SELECT c_mktsegment, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, min(c_acctbal) FILTER (c_acctbal BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS low,
  max(c_acctbal) FILTER (c_acctbal BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS high, count(*) FILTER (c_acctbal NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::BIGINT AS n_outside
FROM customer JOIN q USING (c_mktsegment) GROUP BY 1, 2, 3, 4""")
def box_by_segment(spark, d):
    """Quartiles, whiskers and outliers by group (V7)."""
    return rounded(profile.box_stats(read_table(spark, d, "customer"), "c_mktsegment", "c_acctbal"), 6, "q1", "median", "q3")


@query("SELECT p_partkey, 'p_size' AS a, 'p_retailprice' AS b, p_size::DOUBLE AS x, p_retailprice AS y FROM part")
def pair_points(spark, d):
    """Points of a pair plot, and of a scatter plot."""
    return profile.pairs_long(read_table(spark, d, "part"), ["p_partkey"], ["p_size", "p_retailprice"])


@query("SELECT x::DOUBLE AS x, round(avg(exp(-0.5 * (((p_size - x) / 2.0::DOUBLE) ^ 2)) / (2.0 * sqrt(2 * pi()))), 6) AS density FROM part, range(0, 60, 10) t(x) GROUP BY x")
def density_points(spark, d):
    """A Gaussian kernel density (V9)."""
    return rounded(profile.density(read_table(spark, d, "part"), "p_size", range(0, 60, 10), 2.0), 6, "density")


@query("SELECT p_type, count(*)::BIGINT AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM part GROUP BY 1")
def pie_share(spark, d):
    """Shares of all."""
    return rounded(profile.shares(read_table(spark, d, "part"), "p_type"), 6, "share")
