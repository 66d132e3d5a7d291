"""Exact, reproducible splits and resampling: rows are ordered by a hash of their key, so partitions don't matter.

To take the first n of a table in hash order, rows are counted by a prefix of the hash; only the rows of the one prefix
in which the limit falls are ranked, which gives the last row that is taken. All others are then compared with that one.
No step sorts the whole table, shuffles its rows or brings it to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX = 4


def hash_of(key: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("#", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))


def first_in_hash_order(df: DataFrame, key: Sequence[str], limit: DataFrame, by: Sequence[str] = (), seed: int = 42, name: str = "chosen") -> DataFrame:
    """Adds a boolean: whether the row is among the first __limit rows of its group in hash order.

    limit: a row for each group with the columns of by and __limit. Groups are a few rows, joined as Spark sees fit.
    """
    by = list(by)
    hashed = df.select(*by, *key).withColumn("__h", hash_of(key, seed)).withColumn("__prefix", F.substring("__h", 1, PREFIX))
    counts = hashed.groupBy(*by, "__prefix").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy("__prefix").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counts.withColumn("__before", before)
    placed = placed.join(limit, by) if by else placed.crossJoin(F.broadcast(limit))
    left = F.col("__limit") - F.col("__before")
    cut = placed.where((left > 0) & (left <= F.col("__n"))).select(*by, "__prefix", left.alias("__left"))
    # The place of a row in hash order, and of the last one taken in each group; without one the limit is beyond the end.
    place = F.struct("__h", *key)
    rank = F.row_number().over(Window.partitionBy(*by, "__prefix").orderBy("__h", *key))
    last = hashed.join(cut, [*by, "__prefix"]).withColumn("__rank", rank).where("__rank = __left").select(*by, place.alias("__last"))
    ends = limit.join(last, by, "left") if by else limit.crossJoin(last.agg(F.max("__last").alias("__last")))
    taken = F.when(F.col("__limit") > 0, F.col("__last").isNull() | (place <= F.col("__last")))
    marked = df.withColumn("__h", hash_of(key, seed))
    marked = marked.join(ends, by, "left") if by else marked.crossJoin(F.broadcast(ends))  # one row
    return marked.withColumn(name, F.coalesce(taken, F.lit(False))).select(*df.columns, name)


def sizes(df: DataFrame, part: Column, by: Sequence[str] = ()) -> DataFrame:
    """__limit for each group; part is an expression of its size __size."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("__size")).select(*by, part.cast("long").alias("__limit"))


def train_test_split(df: DataFrame, key: Sequence[str], test: float, seed: int = 42, stratify: Sequence[str] = ()) -> DataFrame:
    """Adds is_test: exactly ceil(test * n) rows, in each stratum if there are strata. key must be unique."""
    return first_in_hash_order(df, key, sizes(df, F.ceil(F.round(F.col("__size") * test, 9)), stratify), stratify, seed, "is_test")


def number_of(df: DataFrame, column: str) -> Column:
    """A number that never falls while the column rises; null for null. Of strings the first six bytes count."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.col(column).cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        # Whole seconds by the clock that the value shows, so no time zone comes in.
        seconds = F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
        return (F.unix_date(F.col(column).cast("date")).cast("long") * 86_400 + seconds).cast("double")
    if isinstance(kind, T.BooleanType):
        return F.col(column).cast("int").cast("double")
    if isinstance(kind, T.BinaryType):
        return F.conv(F.rpad(F.hex(F.substring(column, 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    raise TypeError(f"series can't be ordered by {column}, of type {kind.simpleString()}")


#: Rows that one task puts in order.
ROWS_A_BUCKET = 100_000


def with_place(df: DataFrame, order: Sequence[str], rows_a_bucket: int | None = None) -> DataFrame:
    """Adds __place: the row's number from 1 in the order (nulls first).

    Rows are dealt to buckets by ranges of the first column, as many as give about rows_a_bucket rows each (ROWS_A_BUCKET
    if not given; at most 4,096 bounds, from a sketch), and numbered within; the count of rows in earlier buckets is added. So the table is never
    sorted in one task, however large; rows that are equal in the first column share one.
    """
    x = number_of(df, order[0])
    n = df.count()
    parts = min(4096, -(-n // (rows_a_bucket or ROWS_A_BUCKET)))
    bounds = df.agg(F.percentile_approx(x, [k / parts for k in range(1, parts)], 10_000)).first()[0] if parts > 1 else None
    bounds = sorted(set(bounds or []))
    if bounds:
        df = df.withColumn("__x", F.coalesce(x, F.lit(float("-inf"))))
        dealt = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="__x", outputCol="__bucket").transform(df).drop("__x")
    else:
        dealt = df.withColumn("__bucket", F.lit(0.0))
    counts = dealt.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__bucket", F.coalesce(F.sum("__n").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__bucket").orderBy(*order))
    # At most 4,096 rows.
    return dealt.withColumn("__k", place).join(F.broadcast(before), "__bucket").withColumn("__place", (F.col("__k") + F.col("__before")).cast("long")).drop("__bucket", "__k", "__before")


def sequential_split(df: DataFrame, order: Sequence[str], train: float) -> DataFrame:
    """Adds is_train: the first floor(train * n) rows in order."""
    n = df.agg(F.count(F.lit(1)).alias("__n"))
    placed = with_place(df, order).crossJoin(F.broadcast(n))
    return placed.withColumn("is_train", F.col("__place") <= F.floor(F.round(F.col("__n") * train, 9))).select(*df.columns, "is_train")


def undersample(df: DataFrame, label: str, key: Sequence[str], seed: int = 42) -> DataFrame:
    """As many rows of each label as the rarest one has."""
    counts = sizes(df, F.col("__size"), [label])
    least = counts.agg(F.min("__limit").alias("__least"))
    limit = counts.crossJoin(F.broadcast(least)).select(label, F.col("__least").alias("__limit"))
    return first_in_hash_order(df, key, limit, [label], seed).where("chosen").drop("chosen")


def oversample(df: DataFrame, label: str, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Repeats rows so that each label has as many as the commonest one; adds copy, 0 for the original.

    Every row is repeated equally often, and the first ones in hash order once more.
    """
    counts = sizes(df, F.col("__size"), [label])
    most = counts.agg(F.max("__limit").alias("__most"))
    quota = counts.crossJoin(F.broadcast(most)).select(label, F.floor(F.col("__most") / F.col("__limit")).alias("__times"), (F.col("__most") % F.col("__limit")).alias("__limit"))
    chosen = first_in_hash_order(df, key, quota.select(label, "__limit"), [label], seed)
    times = chosen.join(quota.select(label, "__times"), label).withColumn("__times", F.col("__times") + F.col("chosen").cast("int"))
    return times.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("__times") - 1).cast("int")))).select(*df.columns, "copy")
