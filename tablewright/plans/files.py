"""Files: delimited text, numbers in text, arrays; each is written to the shared folder and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import prep
from ..session import shared_dir
from ..sources import readers, sinks, workbooks
from ..sources.readers import read_table
from .registry import example, query
from .texts import BASKETS, brand_baskets


def place(spark, name: str) -> str:
    return f"{shared_dir(spark)}/files-{uuid.uuid4().hex}/{name}"


def written(df, name: str, header: bool = False, sep: str = ",", null: str = "") -> str:
    path = place(df.sparkSession, name)
    df.write.option("header", header).option("sep", sep).option("nullValue", null).csv(path)
    return path


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_with_header(spark, d):
    """Delimited text with a header and a schema."""
    path = written(read_table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), "nation.csv", header=True)
    return readers.read_csv(spark, path, read_table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey").schema)


@query("SELECT c_custkey::BIGINT AS c_custkey, c_mktsegment, round(c_acctbal, 2) AS c_acctbal FROM customer")
def csv_inferred(spark, d):
    """A header, and types found by reading."""
    path = written(read_table(spark, d, "customer").select("c_custkey", "c_mktsegment", F.round("c_acctbal", 2).alias("c_acctbal")), "customer.csv", header=True)
    df = readers.read_csv(spark, path)
    return df.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("SELECT r_regionkey::INT AS _c0, r_name AS _c1 FROM region")
def csv_without_header(spark, d):
    """No header: columns are numbered."""
    path = written(read_table(spark, d, "region").select(F.col("r_regionkey").cast("int"), "r_name"), "region.csv")
    return readers.read_csv(spark, path, header=False)


@query("SELECT r_regionkey::INT AS id, r_name AS title FROM region")
def csv_named(spark, d):
    """No header, and names that are given (S3)."""
    path = written(read_table(spark, d, "region").select(F.col("r_regionkey").cast("int"), "r_name"), "region.csv")
    return readers.read_csv(spark, path, header=False, names=["id", "title"])


@query("SELECT n_nationkey::INT AS id, n_name AS title FROM nation")
def tab_separated(spark, d):
    """Tabs between the columns."""
    path = written(read_table(spark, d, "nation").select(F.col("n_nationkey").cast("int"), "n_name"), "nation.tsv", sep="\t")
    return readers.read_csv(spark, path, header=False, sep="\t", names=["id", "title"])


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer")
def csv_null_mark(spark, d):
    """A mark that stands for null."""
    df = read_table(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"))
    return readers.read_csv(spark, written(df, "customer.csv", header=True, null="?"), df.schema, null_value="?")


@query("SELECT s_acctbal AS value FROM supplier")
def numbers_of_text(spark, d):
    """All numbers of a file, parted by white space."""
    path = place(spark, "numbers.txt")
    read_table(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_join(F.collect_list(F.col("s_acctbal").cast("string")), "  ").alias("line")).select("line").write.text(path)
    return readers.read_numbers(spark, path)


@query("SELECT s_acctbal AS value FROM supplier")
def numbers_of_ragged_csv(spark, d):
    """All numbers of lines of unequal length."""
    path = place(spark, "numbers.csv")
    read_table(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_join(F.collect_list(F.col("s_acctbal").cast("string")), ", ").alias("line")).select("line").write.text(path)
    return readers.read_numbers(spark, path)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def rows_of_workbooks(spark, d):
    """Workbooks of up to 10,000 suppliers each, and their lines read again."""
    df = read_table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal").withColumn("book", F.floor(F.col("s_suppkey") / 10_000))
    made = workbooks.workbooks(df, "book", ["s_suppkey", "s_name", "s_acctbal"])
    return workbooks.table(workbooks.cells(made), {"s_suppkey": "long", "s_name": "string", "s_acctbal": "double"}).drop("path", "sheet", "row")


@example("SELECT * FROM (VALUES (1, 'pen', 2.5::DOUBLE), (2, 'cup', NULL), (3, NULL, 4.0)) t(id, thing, price)")
def table_of_columns(spark, d):
    """A table from a mapping of names to values."""
    return readers.from_columns(spark, {"id": [1, 2, 3], "thing": ["pen", "cup", None], "price": [2.5, None, 4.0]}, "id int, thing string, price double")


@query("SELECT p_partkey AS i, p_retailprice AS v FROM part")
def saved_array(spark, d):
    """An array written and read again."""
    path = place(spark, "array")
    sinks.save_array(read_table(spark, d, "part").select(F.col("p_partkey").alias("i"), F.col("p_retailprice").alias("v")), path)
    return readers.load_array(spark, path)


@query(f"WITH {BASKETS}, c AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS code FROM (SELECT DISTINCT item FROM b)) SELECT l_orderkey, list(code::INT ORDER BY code) AS codes FROM b JOIN c USING (item) GROUP BY 1")
def sparse_baskets(spark, d):
    """Baskets as the sorted codes of their items, the places of ones in a sparse row."""
    items = brand_baskets(spark, d).select("l_orderkey", F.explode("items").alias("item"))
    return prep.sparse_rows(items, "l_orderkey", "item", prep.encoders(items, ["item"]))
