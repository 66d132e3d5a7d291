"""Ordered series: next values, sliding windows, changes, and a stop rule over them.

Rows get a place in the order (see split.with_place), then are dealt out in chunks of places; what a window needs beyond
its chunk's edge is copied there. So no window runs over the whole table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .split import with_place

CHUNK = 100_000


def chunked(df: DataFrame, order: Sequence[str], back: int, ahead: int, chunk: int = CHUNK) -> DataFrame:
    """df with __place and __chunk, each row also in the chunks that need it; __own tells where it belongs."""
    placed = with_place(df, order)
    low, high = F.floor((F.col("__place") - ahead) / chunk), F.floor((F.col("__place") + back) / chunk)
    placed = placed.withColumn("__chunk", F.explode(F.sequence(F.greatest(low, F.lit(0)), high)))
    return placed.withColumn("__own", F.floor(F.col("__place") / chunk) == F.col("__chunk"))


def with_neighbour(df: DataFrame, value: str, order: Sequence[str], by: int, name: str, chunk: int = CHUNK) -> DataFrame:
    """Adds the value by places later (earlier if negative); null beyond the ends."""
    dealt = chunked(df, order, max(-by, 0), max(by, 0), chunk)
    window = Window.partitionBy("__chunk").orderBy("__place")
    return dealt.withColumn(name, F.lead(value, by).over(window) if by > 0 else F.lag(value, -by).over(window)).where("__own").select(*df.columns, "__place", name)


def next_value_target(df: DataFrame, value: str, order: Sequence[str], chunk: int = CHUNK) -> DataFrame:
    """Adds next_value and target: 1 where it is greater; the last row has 0."""
    out = with_neighbour(df, value, order, 1, "next_value", chunk)
    return out.withColumn("target", F.when(F.col("next_value") > F.col(value), 1).otherwise(0))


def sliding_windows(df: DataFrame, value: str, order: Sequence[str], size: int = 60, chunk: int = CHUNK) -> DataFrame:
    """Rows with size earlier values: window (those, in order) and target (the row's own value)."""
    dealt = chunked(df, order, size, 0, chunk)
    window = Window.partitionBy("__chunk").orderBy("__place").rowsBetween(-size, -1)
    return dealt.withColumn("window", F.collect_list(value).over(window)).where("__own").where(F.size("window") == size).select(*df.columns, "__place", "window", F.col(value).alias("target"))


def percent_change(df: DataFrame, value: str, order: Sequence[str]) -> DataFrame:
    """Adds change in percent of the earlier value; null for the first row and where that value is 0."""
    out = with_neighbour(df, value, order, -1, "__earlier")
    return out.withColumn("change", F.when(F.col("__earlier") != 0, (F.col(value) - F.col("__earlier")) / F.col("__earlier") * 100)).drop("__earlier")


def chosen_k(costs: DataFrame, limit: float = 5.0, run: int = 3) -> DataFrame:
    """From a table (k, cost) with a row for each number of clusters: the k at which to stop.

    It is the k after the first run of changes under limit percent, the table's last k if there is none after it or no
    such run. The table is small (a row for each k), so one task holds it.
    """
    order = Window.orderBy("k")
    change = F.abs((F.col("cost") - F.lag("cost").over(order)) / F.lag("cost").over(order) * 100)
    small = costs.withColumn("change", change).where("change IS NOT NULL").withColumn("worst", F.max("change").over(order.rowsBetween(1 - run, 0))).withColumn("held", F.count("change").over(order.rowsBetween(1 - run, 0))).withColumn("following", F.lead("k").over(order))
    stop = small.where((F.col("worst") < limit) & (F.col("held") == run) & F.col("following").isNotNull()).agg(F.min("following").alias("stop"))
    return stop.crossJoin(costs.agg(F.max("k").alias("last"))).select(F.coalesce("stop", "last").alias("k"))
