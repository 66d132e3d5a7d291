"""Sources: delimited files, numbers in text, literal rows, generated rows, arrays saved as Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class UnsupportedFormat(ValueError):
    """The file's extension is none that can be read."""


class MissingFile(FileNotFoundError):
    """There is nothing at the path."""


class InvalidData(ValueError):
    """A value that should be a number isn't one."""


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def stream_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """read_table()'s rows as a stream."""
    # A pattern, as a stream takes a plain path for a folder while a table may be one file.
    return spark.readStream.schema(read_table(spark, directory, name).schema).parquet(f"{directory}/{name}.parque[t]")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True, sep: str = ",", null_value: str | None = None, names: Sequence[str] | None = None) -> DataFrame:
    """Delimited text with a schema, or with types inferred by a second read. Blanks are null, NaN becomes null.

    With null_value, blanks before a value are left out first, so that " ?" is "?" too.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if null_value is not None:
        reader = reader.option("nullValue", null_value).option("ignoreLeadingWhiteSpace", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if names is not None:
        df = df.toDF(*names)
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType | T.FloatType)]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) for c in floats}) if floats else df


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    """All numbers of a .txt (parted by white space) or .csv file (ragged lines allowed), a row each in column value.

    Raises UnsupportedFormat for other files, MissingFile where there is none and InvalidData where something isn't a number.
    """
    if not path.endswith((".txt", ".csv")):
        raise UnsupportedFormat(path)
    parts = F.split(F.trim("value"), r"\s+" if path.endswith(".txt") else r"\s*,\s*")
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingFile(path) from error
        raise
    words = lines.select(F.explode(parts).alias("word")).where("word <> ''")
    numbers = words.select("word", F.expr("try_cast(word AS double)").alias("value"))
    bad = numbers.where("value IS NULL").select("word").head(1)
    if bad:
        raise InvalidData(f"not a number: {bad[0][0]!r}")
    return numbers.select("value")


def from_columns(spark: SparkSession, columns: Mapping[str, Sequence], schema: T.StructType | str | None = None) -> DataFrame:
    """A small table from a mapping of names to values."""
    rows = list(zip(*columns.values(), strict=True))
    return spark.createDataFrame(rows, schema or list(columns))


def make_regression(spark: SparkSession, rows: int, features: int, noise: float = 0.0, seed: int = 0, informative: int | None = None) -> DataFrame:
    """Generated rows: features x0.. are standard normal, y is a weighted sum of the first informative ones plus noise."""
    df = spark.range(rows).select("id", *[F.randn(seed + k).alias(f"x{k}") for k in range(features)])
    weights = [10.0 * (k + 1) for k in range(features if informative is None else informative)]
    y = sum((F.col(f"x{k}") * w for k, w in enumerate(weights)), F.lit(0.0))
    return df.withColumn("y", y + F.randn(seed + features) * noise)


def load_array(spark: SparkSession, path: str) -> DataFrame:
    """Rows (i, v) or (i, j, v) that save_array() wrote."""
    return spark.read.parquet(path)
