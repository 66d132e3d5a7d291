"""Rows scored as they come, by a saved pipeline and saved label encoders; what can't be scored is kept apart with the reason.

Scored rows and others go by one stream into one table, parted by `reason`: the file sink's log makes each batch appear
once, also when a query is stopped in the middle of one and started again with the same checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.prep import encode

#: Why a row has no score.
MISSING_LABEL, UNKNOWN_LABEL, MISSING_NUMBER = "missing label", "unknown label", "missing number"


def scored(df: DataFrame, encoders: DataFrame, model: PipelineModel, labels: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """df, of either kind, with c_code for each of labels, prediction and reason.

    reason is null for a scored row, else the first of: a label is null, a label isn't in the encoders, a number is null or
    NaN; prediction is null then. encoders is a table (column, label, code) that doesn't grow with df; the model reads
    the codes and numbers, and sees 0 in place of numbers that are missing.
    """
    coded = encode(df, labels, encoders)
    gone = lambda c: F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    some = lambda conditions: F.array_contains(F.array(F.lit(False), *conditions), True)
    reason = F.when(some([F.col(c).isNull() for c in labels]), MISSING_LABEL).when(some([F.col(f"{c}_code") < 0 for c in labels]), UNKNOWN_LABEL).when(some([gone(c) for c in numbers]), MISSING_NUMBER)
    own = {f"__{c}": F.col(c) for c in numbers}
    filled = coded.withColumn("reason", reason).withColumns(own).withColumns({c: F.when(gone(c), F.lit(0.0)).otherwise(F.col(c).cast("double")) for c in numbers})
    out = model.transform(filled).withColumn("prediction", F.when(F.col("reason").isNull(), F.col("prediction")))
    return out.select(*[(F.col(f"__{c}").alias(c) if c in numbers else F.col(f"`{c}`")) for c in df.columns], *[f"{c}_code" for c in labels], "prediction", "reason")


def score_stream(stream: DataFrame, encoders: DataFrame, model: PipelineModel, labels: Sequence[str], numbers: Sequence[str], path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Starts the query that adds scored() rows of stream to the table at path; all that is there is taken, then it ends, unless another trigger is given.

    checkpoint is a folder that outlives the query; read the table with spark.read, which heeds the sink's log.
    """
    rows = scored(stream, encoders, model, labels, numbers)
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
