"""Sinks: arrays, encoder tables and fitted pipelines, and what reads them again."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_array(array: DataFrame, path: str) -> None:
    """Writes an array in long form."""
    array.write.mode("overwrite").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Writes a fitted pipeline, its preprocessing included."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_encoders(encoders: DataFrame, path: str) -> None:
    """Writes the table (column, label, code) of label encoders."""
    encoders.write.mode("overwrite").parquet(path)


def load_encoders(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
