"""Projections, predicates, dates, strings and ordered series over orders, customer, part, lineitem and events."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators import balance, profile, timeseries
from ..sources.readers import read_table
from .registry import example, query


def month(column: str):
    return F.date_trunc("month", column)


@query("""
SELECT year(o_orderdate)::INT AS year, count(*)::BIGINT AS n_orders, round(avg(o_totalprice), 4) AS mean_price,
  sum(CASE WHEN month(o_orderdate) % 3 = 0 THEN 1 ELSE 0 END)::BIGINT AS n_quarter_end, max(quarter(o_orderdate))::INT AS last_quarter
FROM orders GROUP BY 1""")
def year_quarter_profile(spark, d):
    """Date parts, quarter-end months and yearly means."""
    df = read_table(spark, d, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    return df.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.avg("o_totalprice"), 4).alias("mean_price"),
        F.sum(F.when(F.col("month") % 3 == 0, 1).otherwise(0)).alias("n_quarter_end"), F.max(F.quarter("o_orderdate")).alias("last_quarter"),
    )


@query("""
SELECT o_orderkey, split_part(s, '-', 1)::INT AS year, split_part(s, '-', 2)::INT AS month, split_part(s, '-', 3)::INT AS day,
  strftime(strptime(s, '%Y-%m-%d'), '%d.%m.%Y') AS shown FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS s FROM orders)""")
def date_parts(spark, d):
    """A text date split and cast, and parsed again."""
    df = read_table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("s"))
    part = F.split("s", "-")
    return df.select("o_orderkey", *[part[k].cast("int").alias(n) for k, n in enumerate(("year", "month", "day"))], F.date_format(F.to_date("s"), "dd.MM.yyyy").alias("shown"))


@query("SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'")
def select_filter(spark, d):
    """Columns by name and a conjunction."""
    return read_table(spark, d, "customer").where((F.col("c_acctbal") > 0) & (F.col("c_mktsegment") == "BUILDING")).select("c_custkey", "c_acctbal", "c_mktsegment")


@query("SELECT c_custkey, c_name, c_nationkey FROM customer ORDER BY c_custkey LIMIT 3")
def rows_by_position(spark, d):
    """Rows 0 to 2 in key order and columns 0 to 2 by position."""
    df = read_table(spark, d, "customer")
    return df.select(*df.columns[0:3]).orderBy("c_custkey").limit(3)


@query("SELECT * EXCLUDE (p_name, p_type) FROM part ORDER BY p_partkey LIMIT 5")
def head_without_columns(spark, d):
    """The first five rows in key order, without some columns."""
    return read_table(spark, d, "part").drop("p_name", "p_type").orderBy("p_partkey").limit(5)


@query("SELECT event_type, count(*)::BIGINT AS n FROM events WHERE value > 50 GROUP BY 1")
def filter_then_counts(spark, d):
    """A filter, then counts of a column (P10)."""
    return profile.value_counts(read_table(spark, d, "events").where("value > 50"), "event_type")


@query("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END::INT AS has_balance FROM customer")
def balance_flag(spark, d):
    """A 0/1 flag from a condition."""
    return read_table(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("has_balance"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice - l_extendedprice * l_discount, 4) AS net, round(l_extendedprice * (1 + l_tax), 4) AS gross FROM lineitem")
def column_arithmetic(spark, d):
    """Arithmetic between columns."""
    price = F.col("l_extendedprice")
    return read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(price - price * F.col("l_discount"), 4).alias("net"), F.round(price * (1 + F.col("l_tax")), 4).alias("gross"))


@example("""
SELECT x, y, x + y AS plus, x - y AS minus, x * y AS times, round(x / y::DOUBLE, 6) AS div, floor(x / y::DOUBLE)::BIGINT AS floor_div,
  (x - y * floor(x / y::DOUBLE))::BIGINT AS floor_mod, (x::DOUBLE ^ 2) AS power, x = y AS eq, x <> y AS ne, x > y AS gt, x < y AS lt, x <= y AS le, x >= y AS ge
FROM (VALUES (7, 3), (-7, 3), (7, -3), (6, 3), (0, 5)) t(x, y)""")
def arithmetic(spark, d):
    """Arithmetic and comparisons with floor division."""
    x, y = F.col("x"), F.col("y")
    df = spark.createDataFrame([(7, 3), (-7, 3), (7, -3), (6, 3), (0, 5)], "x int, y int")
    return df.select(
        "x", "y", (x + y).alias("plus"), (x - y).alias("minus"), (x * y).alias("times"), F.round(x / y, 6).alias("div"), S.floor_div(x, y).alias("floor_div"), S.floor_mod(x, y).alias("floor_mod"), F.pow(x.cast("double"), F.lit(2)).alias("power"),
        (x == y).alias("eq"), (x != y).alias("ne"), (x > y).alias("gt"), (x < y).alias("lt"), (x <= y).alias("le"), (x >= y).alias("ge"),
    )


@query("SELECT p_partkey, round(pi() * p_size ^ 2, 6) AS area FROM part")
def circle_areas(spark, d):
    """A formula with a constant."""
    return read_table(spark, d, "part").select("p_partkey", F.round(S.circle_area(F.col("p_size")), 6).alias("area"))


@query("SELECT c_custkey, CASE WHEN s >= 90 THEN 'A' WHEN s >= 80 THEN 'B' WHEN s >= 70 THEN 'C' WHEN s >= 60 THEN 'D' ELSE 'F' END AS grade, CASE WHEN s >= 60 THEN 'pass' ELSE 'fail' END AS result FROM (SELECT c_custkey, c_acctbal / 100 AS s FROM customer)")
def grade_band(spark, d):
    """Banded labels and a threshold."""
    s = F.col("c_acctbal") / 100
    return read_table(spark, d, "customer").select("c_custkey", S.grade(s).alias("grade"), F.when(s >= 60, "pass").otherwise("fail").alias("result"))


@query("""
WITH RECURSIVE e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, CASE WHEN event_id % 2 = 0 THEN value ELSE -value END AS amount FROM events)
, b AS (
  SELECT user_id, 1::BIGINT AS k, CASE WHEN amount >= 0 THEN amount ELSE 0 END AS balance FROM e WHERE k = 1
  UNION ALL SELECT e.user_id, e.k, CASE WHEN b.balance + e.amount >= 0 THEN b.balance + e.amount ELSE b.balance END FROM b JOIN e ON e.user_id = b.user_id AND e.k = b.k + 1)
SELECT user_id, count(*)::BIGINT AS n_moves, round(arg_max(balance, k), 4) AS balance FROM b GROUP BY user_id""")
def running_balance(spark, d):
    """Deposits and withdrawals in order, those that aren't covered refused."""
    moves = read_table(spark, d, "events").select("user_id", "ts", "event_id", F.when(F.col("event_id") % 2 == 0, F.col("value")).otherwise(-F.col("value")).alias("amount"))
    return balance.running_balances(moves, "user_id", ["ts", "event_id"], "amount").withColumn("balance", F.round("balance", 4))


@query("""
SELECT p_partkey, round(p_retailprice * 5 * 2 / 100, 6) AS interest,
  round(p_retailprice * r * (1 + r) ^ n / ((1 + r) ^ n - 1), 6) AS emi FROM (SELECT *, 10 / 1200.0::DOUBLE AS r, 12 + p_size % 24 AS n FROM part)""")
def interest_emi(spark, d):
    """Simple interest and equal monthly instalments."""
    price = F.col("p_retailprice")
    return read_table(spark, d, "part").select("p_partkey", F.round(S.simple_interest(price, F.lit(5), F.lit(2)), 6).alias("interest"), F.round(S.instalment(price, F.lit(10.0), 12 + F.col("p_size") % 24), 6).alias("emi"))


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 7.5 WHEN 'MACHINERY' THEN 9.0 ELSE 8.0 END::DOUBLE AS rate FROM customer")
def rate_lookup(spark, d):
    """A look-up with a default (P20)."""
    return read_table(spark, d, "customer").select("c_custkey", S.looked_up(F.col("c_mktsegment"), {"BUILDING": 7.5, "MACHINERY": 9.0}, 8.0).alias("rate"))


@query("""
SELECT c_custkey, printf('%s owes %.2f', c_name, c_acctbal) AS line, c_name || '/' || c_mktsegment AS joined, format('{:,.2f}', c_acctbal) AS grouped,
  rpad(c_mktsegment, 12, '.') AS ljust, lpad(c_mktsegment, 12, '.') AS rjust FROM customer""")
def formatted(spark, d):
    """Formatted text, padding, grouped digits."""
    return read_table(spark, d, "customer").select(
        "c_custkey", F.format_string("%s owes %.2f", "c_name", "c_acctbal").alias("line"), F.concat_ws("/", "c_name", "c_mktsegment").alias("joined"), F.format_number("c_acctbal", 2).alias("grouped"),
        F.rpad("c_mktsegment", 12, ".").alias("ljust"), F.lpad("c_mktsegment", 12, ".").alias("rjust"),
    )


@query("SELECT p_partkey, (p_size >= 10 AND p_retailprice > 1000) AS eligible FROM part")
def eligible(spark, d):
    """A boolean of two conditions."""
    return read_table(spark, d, "part").select("p_partkey", ((F.col("p_size") >= 10) & (F.col("p_retailprice") > 1000)).alias("eligible"))


@query('SELECT r_regionkey AS "key", r_name AS "name" FROM region')
def renamed(spark, d):
    """Columns renamed by position."""
    return read_table(spark, d, "region").toDF("key", "name")


@query("SELECT p_partkey, p_size, p_retailprice FROM part")
def numeric_only(spark, d):
    """Columns by type (P25)."""
    df = read_table(spark, d, "part")
    return df.select(*profile.columns_of(df, T.NumericType))


@query("SELECT p_partkey, p_size::VARCHAR AS size_text, p_retailprice::BIGINT AS price_whole, p_size::DOUBLE AS size_real FROM (SELECT *, trunc(p_retailprice) AS p FROM part) t(p_partkey, p_name, p_brand, p_type, p_size, x, p_retailprice)")
def casts(spark, d):
    """Casts between text, whole and real numbers."""
    return read_table(spark, d, "part").select("p_partkey", F.col("p_size").cast("string").alias("size_text"), F.col("p_retailprice").cast("long").alias("price_whole"), F.col("p_size").cast("double").alias("size_real"))


@query("SELECT count(*) FILTER (l_linenumber = l_quantity)::BIGINT AS n_equal, count(*)::BIGINT AS n FROM lineitem")
def equal_columns(spark, d):
    """How often two columns are equal."""
    return read_table(spark, d, "lineitem").agg(F.count_if(F.col("l_linenumber") == F.col("l_quantity")).alias("n_equal"), F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_totalprice, lead(o_totalprice) OVER w AS next_value, CASE WHEN lead(o_totalprice) OVER w > o_totalprice THEN 1 ELSE 0 END::INT AS target FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey)")
def next_value_target(spark, d):
    """The next value in order and whether it is higher."""
    df = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return timeseries.next_value_target(df, "o_totalprice", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_totalprice", "next_value", "target")


@query("""
SELECT o_orderkey, round(list_sum(w), 2) AS total, w[1] AS oldest, w[60] AS newest, target FROM (
  SELECT o_orderkey, o_totalprice AS target, list(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS w FROM orders) WHERE len(w) = 60""")
def sliding_window(spark, d):
    """Windows of 60 earlier values with the value after them (A10)."""
    df = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    out = timeseries.sliding_windows(df, "o_totalprice", ["o_orderdate", "o_orderkey"], 60)
    return out.select("o_orderkey", F.round(F.aggregate("window", F.lit(0.0), lambda s, x: s + x), 2).alias("total"), F.col("window")[0].alias("oldest"), F.col("window")[59].alias("newest"), "target")


@query("""
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)
SELECT month, total, round((total - lag(total) OVER (ORDER BY month)) / lag(total) OVER (ORDER BY month) * 100, 6) AS change FROM m""")
def pct_change(spark, d):
    """Percent change of monthly totals."""
    months = read_table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    out = timeseries.percent_change(months, "total", ["month"])
    return out.select("month", "total", F.round("change", 6).alias("change"))


WCSS = [(1, 1000.0), (2, 600.0), (3, 400.0), (4, 390.0), (5, 380.0), (6, 372.0), (7, 365.0), (8, 360.0), (9, 250.0)]


@example("SELECT 7::INT AS k")
def stop_rule(spark, d):
    """The number of clusters after three small changes of cost in a row."""
    return timeseries.chosen_k(spark.createDataFrame(WCSS, "k int, cost double")).select(F.col("k").cast("int").alias("k"))


@query("SELECT o_custkey, n, total FROM (SELECT o_custkey, count(*)::BIGINT AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) ORDER BY total DESC, o_custkey LIMIT 1")
def best_by_score(spark, d):
    """The row of the greatest score, the first of ties."""
    sums = read_table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return profile.first_of(sums, "total", ["o_custkey"])


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INT) AS k, starts_with(event_type, 'p') AS p, ends_with(event_type, 'k') AS ends FROM events")
def text_tests(spark, d):
    """A number read from text, and prefix and suffix tests (G5, 1.4)."""
    return read_table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"), F.startswith("event_type", F.lit("p")).alias("p"), F.endswith("event_type", F.lit("k")).alias("ends"))


@example("SELECT unnest(range(0, 10, 2))::BIGINT AS i")
def counting(spark, d):
    """A counting loop."""
    return spark.range(0, 10, 2).withColumnRenamed("id", "i")
