"""Exact interpolated quantiles that no task has to hold all values for.

A sketch of bounded size gives, for each quantile, a narrow band of values that must hold it. One more pass counts the
values below each band and the distinct ones within it, on the map side; only what lies in a band is put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The sketch's ranks are off by at most one in so many; of so few values all are put in order.
ACCURACY = 10_000
#: A band reaches so many times that to either side.
REACH = 4
#: A group of more rows never comes together in one task.
HOT = 1_000_000


def quantiles(df: DataFrame, columns: Sequence[str], at: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by, column, values): for each column (and group) the quantiles at the given shares, as linear interpolations.

    Nulls are left out; a column (of a group) without values has no row.
    """
    keys = [*by, "column"]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])
    long = df.select(*by, F.explode(cells).alias("v")).select(*by, "v.column", "v.x").where("x IS NOT NULL")
    edges = [min(max(p + side * REACH / ACCURACY, 0.0), 1.0) for p in at for side in (-1, 1)]
    sketch = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.percentile_approx("x", edges, ACCURACY).alias("__edges"))
    same = _same(keys, "__s_")
    side = sketch.select(*[F.col(k).alias(f"__s_{k}") for k in keys], "__edges", "__n")
    placed = long.join(F.broadcast(side), same) if not by else _beside(long, side, same)  # a row for each column
    # For each quantile a value below its band counts as one below (null), one in it as itself, one above it not at all.
    few = F.col("__n") <= ACCURACY
    reaches, passes = (lambda i: few | (F.col("x") >= F.get("__edges", 2 * i))), (lambda i: ~few & (F.col("x") > F.get("__edges", 2 * i + 1)))
    parts = F.transform(F.sequence(F.lit(0), F.lit(len(at) - 1)), lambda i: F.when(~passes(i), F.struct(i.alias("q"), F.when(reaches(i), F.col("x")).alias("x"))))
    counted = placed.select(*keys, "__n", F.explode(F.array_compact(parts)).alias("c")).groupBy(*keys, "c.q", "c.x").agg(F.count(F.lit(1)).alias("__k"), F.max("__n").alias("__n"))
    end = F.sum("__k").over(Window.partitionBy(*keys, "q").orderBy(F.col("x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("__end", end)
    rank = F.element_at(F.array(*[F.lit(float(p)) for p in at]), F.col("q") + 1) * (F.col("__n") - 1)
    holds = lambda r: (F.col("__end") > r) & (F.col("__end") - F.col("__k") <= r)
    ends = ranked.withColumn("__rank", rank).groupBy(*keys, "q").agg(
        F.max("__rank").alias("__rank"),
        F.max(F.when(holds(F.floor("__rank")), F.col("x"))).alias("__low"),
        F.max(F.when(holds(F.ceil("__rank")), F.col("x"))).alias("__high"),
    )
    value = F.col("__low") + (F.col("__high") - F.col("__low")) * (F.col("__rank") - F.floor("__rank"))
    listed = F.array_sort(F.collect_list(F.struct("q", value.alias("v"))))
    return ends.groupBy(*keys).agg(F.transform(listed, lambda x: x["v"]).alias("values"))


def _beside(long: DataFrame, side: DataFrame, same: Column) -> DataFrame:
    """long with its group's row of side: to large groups, which are few, it is broadcast; rows of the others meet it by their group."""
    hot = F.broadcast(side.where(F.col("__n") > HOT))
    return long.join(hot, same).unionByName(long.join(hot, same, "left_anti").join(side.where(F.col("__n") <= HOT), same))


def _same(keys: Sequence[str], prefix: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return out
