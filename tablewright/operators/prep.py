"""Preparation of columns: nulls, recoding, label codes, dummies, scaling. Fitted values are small tables or one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import quantiles


def mode_of(column: str) -> Column:
    """The most frequent value, the smallest of ties."""
    return F.mode(F.col(column), True)


def fitted(column: str, strategy: str, constant=None) -> Column:
    """What fills a column's nulls, as an aggregate."""
    x = F.col(column)
    return {"mean": lambda: F.avg(x), "mode": lambda: mode_of(column), "constant": lambda: F.lit(constant)}[strategy]()


def impute(df: DataFrame, strategies: Mapping[str, str], fit_on: DataFrame | None = None, constant=None) -> DataFrame:
    """Fills nulls of each column by its strategy (mean, median, mode, constant), fitted on fit_on or df itself.

    All strategies but medians are fitted in one pass; the fit is a single row, which is broadcast.
    """
    base = df if fit_on is None else fit_on
    medians = [c for c, s in strategies.items() if s == "median"]
    values = base.agg(F.lit(1).alias("__one"), *[fitted(c, s, constant).alias(f"__fill_{c}") for c, s in strategies.items() if s != "median"])
    if medians:
        found = quantiles(base, medians, [0.5]).agg(*[F.max(F.when(F.col("column") == c, F.col("values")[0])).alias(f"__fill_{c}") for c in medians])
        values = values.crossJoin(F.broadcast(found))  # one row each
    values = values.drop("__one")
    filled = df.crossJoin(F.broadcast(values)).withColumns({c: F.coalesce(c, f"__fill_{c}") for c in strategies})
    return filled.drop(*[f"__fill_{c}" for c in strategies])


def recode(column: Column, table: Mapping, keep_others: bool = False) -> Column:
    """Replaces values by a table; others become null, or stay with keep_others (then keys and values have one type)."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(pairs, column)
    return F.coalesce(found, column) if keep_others else found


def encoders(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, label, code): codes from 0 in the order of the labels, of all labels that aren't null."""
    parts = [df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")).dropna().distinct() for c in columns]
    labels = parts[0]
    for part in parts[1:]:
        labels = labels.unionByName(part)
    return labels.withColumn("code", (F.row_number().over(Window.partitionBy("column").orderBy("label")) - 1).cast("int"))


def encode(df: DataFrame, columns: Sequence[str], table: DataFrame) -> DataFrame:
    """Adds c_code for each column: its code, -1 for null and unknown labels."""
    for c in columns:
        own = table.where(F.col("column") == c).select(F.col("label").alias(f"__{c}"), F.col("code").alias(f"{c}_code"))
        df = df.join(own, F.col(c).cast("string") == F.col(f"__{c}"), "left").drop(f"__{c}").fillna(-1, [f"{c}_code"])
    return df


def decode(df: DataFrame, column: str, code: str, table: DataFrame) -> DataFrame:
    """Adds c_label: the label of a code."""
    own = table.where(F.col("column") == column).select(F.col("code").alias(code), F.col("label").alias(f"{column}_label"))
    return df.join(own, code, "left")


def labels_of(df: DataFrame, column: str, most: int = 1000) -> list:
    """The column's values in order. Their number is checked, as each becomes a column."""
    values = [r[0] for r in df.select(column).dropna().distinct().limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values; use encoders() and sparse vectors instead")
    return sorted(values)


def dummies(df: DataFrame, column: str, drop_first: bool = False, labels: Sequence | None = None) -> DataFrame:
    """A 0/1 column c_label for each label, the first one left out with drop_first; null is all zeros."""
    labels = labels_of(df, column) if labels is None else labels
    flags = {f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in labels[1 if drop_first else 0 :]}
    return df.withColumns(flags).drop(column)


def baskets_matrix(df: DataFrame, key: str, item: str, items: Sequence[str] | None = None) -> DataFrame:
    """A 0/1 column for each item, in their order, and a row for each basket."""
    items = labels_of(df, item) if items is None else items
    return df.groupBy(key).agg(*[F.max(F.coalesce((F.col(item) == v).cast("int"), F.lit(0))).alias(str(v)) for v in items])


def sparse_rows(df: DataFrame, key: str, item: str, table: DataFrame) -> DataFrame:
    """(key, codes): for each basket the sorted codes of its items by a table of encoders()."""
    own = table.where(F.col("column") == item).select(F.col("label").alias("__label"), "code")
    return df.join(own, F.col(item).cast("string") == F.col("__label")).groupBy(key).agg(F.array_sort(F.collect_set("code")).alias("codes"))


def one_hot_of(values: Column, vocabulary: Column) -> Column:
    """For an array of values, arrays of 0 and 1 over a sorted vocabulary."""
    return F.transform(values, lambda x: F.transform(vocabulary, lambda v: (v == x).cast("int")))


def scale_fit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with mean, population deviation, least and greatest value of each column."""
    x = {c: F.col(c).cast("double") for c in columns}
    return df.agg(*[f(x[c]).alias(f"__{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))])


def scale(df: DataFrame, columns: Sequence[str], fit: DataFrame, how: str = "standard", suffix: str = "") -> DataFrame:
    """Scales columns by a row of scale_fit(): "standard" to mean 0 and population deviation 1, "minmax" to 0..1.

    A constant column becomes 0.
    """
    joined = df.crossJoin(F.broadcast(fit))

    def scaled(c: str) -> Column:
        x = F.col(c).cast("double")
        low, width = (f"__mean_{c}", F.col(f"__std_{c}")) if how == "standard" else (f"__min_{c}", F.col(f"__max_{c}") - F.col(f"__min_{c}"))
        return F.when(x.isNotNull(), F.when(width == 0, 0.0).otherwise((x - F.col(low)) / width))

    return joined.withColumns({f"{c}{suffix}": scaled(c) for c in columns}).drop(*fit.columns)


def unscale_minmax(df: DataFrame, columns: Sequence[str], fit: DataFrame) -> DataFrame:
    """The inverse of scale(how="minmax")."""
    joined = df.crossJoin(F.broadcast(fit))
    return joined.withColumns({c: F.col(c) * (F.col(f"__max_{c}") - F.col(f"__min_{c}")) + F.col(f"__min_{c}") for c in columns}).drop(*fit.columns)
