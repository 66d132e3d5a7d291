"""Tables of intermediate rows, kept in the shared folder while an iterative job needs them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import shared_dir


class Staging:
    """with Staging() as keep: keep(df) writes df and reads it again, which cuts its lineage and survives lost executors; all is deleted at the end, also after an error.

    keep(df, old) deletes what old read, which df has replaced.
    """

    def __enter__(self) -> Staging:
        self.paths: dict[int, tuple[SparkSession, str]] = {}
        return self

    def __call__(self, df: DataFrame, old: DataFrame | None = None, by: list[str] | None = None) -> DataFrame:
        spark = df.sparkSession
        path = f"{shared_dir(spark)}/staging-{uuid.uuid4().hex}"
        (df.write.partitionBy(*by) if by else df.write).parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (spark, path)
        if old is not None:
            self.drop(*self.paths.pop(id(old)))
        return out

    @staticmethod
    def drop(spark: SparkSession, path: str) -> None:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

    def __exit__(self, *error) -> None:
        for spark, path in self.paths.values():
            self.drop(spark, path)
        self.paths.clear()
