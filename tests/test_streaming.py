"""Scoring of a stream: same rows as the batch, none twice after a restart, reasons for those without a score."""

from pathlib import Path

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler

from tablewright.operators import models, prep
from tablewright.streaming import scoring

SCHEMA = "id int, kind string, x double"
FIRST = [(1, "a", 1.0), (2, "b", 2.0), (3, None, 1.0), (4, "z", 1.0), (5, "a", None), (6, "b", float("nan")), (7, None, None), (1, "a", 1.0)]
SECOND = [(8, "b", -1.0), (9, "z", None), (10, "a", 4.0)]


def fitted(spark):
    train = spark.createDataFrame([(k, "ab"[k % 2], float(k * k % 7), float(k)) for k in range(20)], "id int, kind string, x double, y double")
    encoders = prep.encoders(train, ["kind"])
    features = VectorAssembler(inputCols=["kind_code", "x"], outputCol="features")
    return encoders, Pipeline(stages=[features, models.linear_regression("y")]).fit(prep.encode(train, ["kind"], encoders))


def rows(df):
    return sorted(map(str, df.collect()))


def test_reasons(spark):
    encoders, model = fitted(spark)
    found = [(r.id, r.reason, r.prediction is None, r.kind_code) for r in scoring.scored(spark.createDataFrame(FIRST, SCHEMA), encoders, model, ["kind"], ["x"]).collect()]
    label, unknown, number = scoring.MISSING_LABEL, scoring.UNKNOWN_LABEL, scoring.MISSING_NUMBER
    assert sorted(found, key=str) == sorted([(1, None, False, 0), (2, None, False, 1), (3, label, True, -1), (4, unknown, True, -1), (5, number, True, 0), (6, number, True, 1), (7, label, True, -1), (1, None, False, 0)], key=str)
    assert scoring.scored(spark.createDataFrame([], SCHEMA), encoders, model, ["kind"], ["x"]).count() == 0


def test_restart_repeats_nothing(spark, tmp_path):
    encoders, model = fitted(spark)
    source, out, checkpoint = (str(tmp_path / n) for n in ("source", "out", "checkpoint"))

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        scoring.score_stream(stream, encoders, model, ["kind"], ["x"], out, checkpoint).awaitTermination()
        return rows(spark.read.parquet(out))

    batch = lambda data: rows(scoring.scored(spark.createDataFrame(data, SCHEMA), encoders, model, ["kind"], ["x"]))
    spark.createDataFrame(FIRST, SCHEMA).coalesce(1).write.parquet(source)
    assert run() == batch(FIRST)
    assert run() == batch(FIRST)
    spark.createDataFrame(SECOND, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    assert run() == batch(FIRST + SECOND)
    # As if the query had been stopped after the rows of its last batch were written, before it was marked as done.
    commits = Path(checkpoint, "commits")
    last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (commits / f".{last.name}.crc").unlink(missing_ok=True)
    assert run() == batch(FIRST + SECOND)
    assert int(last.name) >= 1
