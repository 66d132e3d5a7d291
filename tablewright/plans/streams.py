"""Scoring of rows that come as a stream."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..operators import models, prep
from ..session import shared_dir
from ..sources import sinks
from ..sources.readers import read_table, stream_table
from ..staging import Staging
from ..streaming import scoring
from .registry import query


@query("""
WITH t AS (SELECT * FROM events WHERE event_type <> 'error'), e AS (SELECT label, (row_number() OVER (ORDER BY label) - 1)::INT AS code FROM (SELECT DISTINCT event_type AS label FROM t))
, m AS (SELECT regr_slope(value, code) AS slope, regr_intercept(value, code) AS intercept FROM t JOIN e ON event_type = label)
SELECT event_id, event_type, coalesce(code, -1)::INT AS event_type_code, CASE WHEN code IS NOT NULL AND value IS NOT NULL THEN round(intercept + slope * code, 6) END AS prediction,
  CASE WHEN event_type IS NULL THEN 'missing label' WHEN code IS NULL THEN 'unknown label' WHEN value IS NULL THEN 'missing number' END AS reason
FROM events LEFT JOIN e ON event_type = label, m""")
def scored_stream(spark, d):
    """All events as a stream, scored by encoders and a pipeline that were saved and read again; both were fitted on events that are no errors, so errors are kept apart."""
    folder = f"{shared_dir(spark)}/scored-{uuid.uuid4().hex}"
    events = read_table(spark, d, "events").select("event_id", "event_type", "value")
    known = events.where("event_type <> 'error'")
    sinks.save_encoders(prep.encoders(known, ["event_type"]), f"{folder}/tools/encoders")
    codes = sinks.load_encoders(spark, f"{folder}/tools/encoders")
    features = VectorAssembler(inputCols=["event_type_code"], outputCol="features")
    sinks.save_model(Pipeline(stages=[features, models.linear_regression("value")]).fit(prep.encode(known.dropna(), ["event_type"], codes)), f"{folder}/tools/model")
    stream = stream_table(spark, d, "events").select(*events.columns)
    started = scoring.score_stream(stream, codes, sinks.load_model(f"{folder}/tools/model"), ["event_type"], ["value"], f"{folder}/rows", f"{folder}/tools/checkpoint")
    started.awaitTermination()
    Staging.drop(spark, f"{folder}/tools")
    return spark.read.parquet(f"{folder}/rows").select("event_id", "event_type", "event_type_code", F.round("prediction", 6).alias("prediction"), "reason")
