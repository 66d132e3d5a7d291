"""Profiles of a table: shapes, nulls, descriptions, counts, correlations, histograms, box plots, densities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quantiles import quantiles


def columns_of(df: DataFrame, include: type | tuple = (), exclude: type | tuple = ()) -> list[str]:
    """Names of columns by their Spark type, in order."""
    return [f.name for f in df.schema.fields if (not include or isinstance(f.dataType, include)) and not (exclude and isinstance(f.dataType, exclude))]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.NumericType)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def unpivoted(df: DataFrame, values: dict[str, list[Column]], names: Sequence[str]) -> DataFrame:
    """One row for each key of values from a single aggregation of df: (column, *names)."""
    one = df.agg(*[v.alias(f"{k}_{i}") for k, (_, vs) in enumerate(values.items()) for i, v in enumerate(vs)])
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{k}_{i}").alias(n) for i, n in enumerate(names)]) for k, c in enumerate(values)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_counts(df: DataFrame) -> DataFrame:
    return unpivoted(df, {c: [F.count_if(F.col(c).isNull())] for c in df.columns}, ["n_null"])


def info(df: DataFrame) -> DataFrame:
    return unpivoted(df, {f.name: [F.lit(f.dataType.simpleString()), F.count(f.name)] for f in df.schema.fields}, ["type", "n_present"])


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and interpolated quartiles."""
    x = {c: F.col(c).cast("double") for c in columns}
    moments = unpivoted(df, {c: [F.count(c), F.avg(x[c]), F.stddev_samp(x[c]), F.min(x[c]), F.max(x[c])] for c in columns}, ["count", "mean", "std", "min", "max"])
    found = quantiles(df, columns, (0.25, 0.5, 0.75)).select("column", *[F.col("values")[k].alias(n) for k, n in enumerate(("q1", "median", "q3"))])
    return moments.join(found, "column", "left").select("column", "count", "mean", "std", "min", "q1", "median", "q3", "max")


def n_duplicated(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicated"))


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Count of each value; null isn't one."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def shares(df: DataFrame, column: str) -> DataFrame:
    """value_counts() with each value's share of all."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return counts.crossJoin(F.broadcast(total)).select(column, "n", (F.col("n") / F.col("total")).alias("share"))


def group_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str], keep_null: bool = False) -> DataFrame:
    """Means of columns by key; rows with a null key are left out unless keep_null."""
    rows = df if keep_null else df.dropna(subset=list(keys))
    return rows.groupBy(*keys).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def group_present(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """How many values of each column aren't null, by key."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*[F.count(c).alias(f"n_{c}") for c in columns])


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The mode, the smallest on ties, with its count."""
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(1).select(F.col(column).alias("mode"), "n")


def correlations(df: DataFrame, columns: Sequence[str], symmetric: bool = True) -> DataFrame:
    """Pearson correlation of each pair in long form (a, b, r), in one pass; pairs with a null are left out."""
    pairs = [(a, b) for i, a in enumerate(columns) for j, b in enumerate(columns) if symmetric or i < j]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{k}") for k, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{k}").alias("r")) for k, (a, b) in enumerate(pairs)]
    return one.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins from the least to the greatest value; the last one holds the greatest. Empty bins are listed."""
    x = F.col(column).cast("double")
    bounds = df.agg(F.min(x).alias("low"), F.max(x).alias("high"))  # one row
    width = (F.col("high") - F.col("low")) / bins
    place = F.when(width > 0, F.least(F.floor((x - F.col("low")) / width), F.lit(bins - 1))).otherwise(0).cast("int")
    counted = df.where(x.isNotNull()).crossJoin(F.broadcast(bounds)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = bounds.where("low IS NOT NULL").select("low", width.alias("width"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(counted, "bin", "left").select("bin", (F.col("low") + F.col("bin") * F.col("width")).alias("left"), F.coalesce("n", F.lit(0)).alias("n"))


def histogram_edges(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Counts between given edges; the last bin is closed, values outside aren't counted."""
    x = F.col(column)
    place = F.when(x == edges[-1], len(edges) - 2)
    for k in range(len(edges) - 1):
        place = place.when((x >= edges[k]) & (x < edges[k + 1]), k)
    one = df.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).where("bin IS NOT NULL")
    frame = df.sparkSession.range(len(edges) - 1).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(one), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def box_stats(df: DataFrame, key: str, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles by key, whiskers (extremes within reach times the quartiles' distance) and how many values lie outside."""
    x = F.col(column).cast("double")
    q = quantiles(df, [column], (0.25, 0.5, 0.75), [key]).select(key, *[F.col("values")[k].alias(n) for k, n in enumerate(("q1", "median", "q3"))])
    low, high = F.col("q1") - reach * (F.col("q3") - F.col("q1")), F.col("q3") + reach * (F.col("q3") - F.col("q1"))
    inside = x.between(low, high)
    return df.join(q, key).groupBy(key, "q1", "median", "q3").agg(F.min(F.when(inside, x)).alias("low"), F.max(F.when(inside, x)).alias("high"), F.count_if(~inside).alias("n_outside"))


def density(df: DataFrame, column: str, points: Sequence[float], bandwidth: float) -> DataFrame:
    """Gaussian kernel density at given points: one pass with a sum for each point."""
    x = F.col(column).cast("double")
    scale = 1 / (bandwidth * (2 * 3.141592653589793) ** 0.5)
    one = df.agg(*[F.avg(F.exp(-F.pow((x - p) / bandwidth, 2) / 2) * scale).alias(f"d{k}") for k, p in enumerate(points)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(float(p)).alias("x"), F.col(f"d{k}").alias("density")) for k, p in enumerate(points)])).alias("p")).select("p.*")


def pairs_long(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(key, a, b, x, y) for each pair of columns, as a pair plot draws them."""
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    return df.select(*key, F.explode(F.array(*pairs)).alias("p")).select(*key, "p.*")


def first_of(df: DataFrame, score: str, order: Sequence[str]) -> DataFrame:
    """The row with the greatest score; of ties the first in order."""
    return df.orderBy(F.desc(score), *order).limit(1)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "k") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
