"""Helpers shared by the corpus operators: reading tables, staging results in the shared folder, column names, words."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: A run of ASCII white space: U+0020 and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"
#: Bounds the rows of a broadcast that thins out documents before a join.
BUCKETS = 2**20
Keep = Callable[[DataFrame], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(column: str) -> Column:
    """The column of just this name, whatever characters the name has."""
    return F.col("`" + column.replace("`", "``") + "`")


def packed(documents: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (a string), more, and __own: each row's own columns as one, whatever their names."""
    own = F.struct(*[named(c) for c in documents.columns]).alias("__own")
    return documents.select("doc_id", F.col("text").cast("string").alias("text"), *more, own)


def unpacked(df: DataFrame, documents: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of documents from __own, but for those that are replaced."""
    return df.select(*[replaced.get(c, F.col("__own").getField(c)).alias(c) for c in documents.columns])


def bucket_of(*key: str | Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS))


def buckets_of(keys: DataFrame, *key: str) -> DataFrame:
    """(__bucket): of all keys, for a broadcast of at most BUCKETS rows, whatever the corpus."""
    return F.broadcast(keys.select(bucket_of(*key).alias("__bucket")).distinct())


def staged(df: DataFrame) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: cuts the lineage, and survives lost executors."""
    return Temporary().staged(df)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, even where a filter pulls the expression into its condition."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def space_words(text: Column) -> Column:
    """The words between runs of white space, as an array without empty strings."""
    return F.array_remove(F.split(text, SPACES), "")


class Temporary:
    """Staged tables that are deleted together once what was made of them is staged itself."""

    def __init__(self):
        self.paths: list[tuple[SparkSession, str]] = []

    def staged(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
        self.paths.append((spark, path))
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        for spark, path in self.paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        self.paths.clear()

    def last(self, df: DataFrame) -> DataFrame:
        """df staged, which is what remains, and all that was staged before deleted."""
        before, self.paths = self.paths, []
        out = self.staged(df)
        self.paths = before
        self.release()
        return out
