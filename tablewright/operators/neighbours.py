"""Exact nearest neighbours by pivots: bounds from the triangle inequality leave most pairs unopened.

1. Every row belongs to its nearest pivot, at a distance r from it. Of each pivot's rows only their number, the greatest r
   and the k least r are known to the driver.
2. A query at distance d from a pivot has that pivot's rows within d + r, so the k-th least of these sums, over all pivots,
   is a distance within which its k neighbours are for certain. A pivot whose rows are all further away, or all on the far
   side of the plane between it and the query's own pivot, is not opened.
3. Queries meet the rows of the pivots that they open, in blocks of bounded size on both sides, however many rows a pivot
   holds. Within a block only rows whose r allows it are compared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import Staging
from .sums import lists, matrix

PIVOTS = 64
#: Rows, and queries, that meet in one task at once, about.
BLOCK = 4096
#: Distances carry rounding errors; bounds are widened by this much of themselves.
SLACK = 1e-9


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(np.stack([((x - p) ** 2).sum(axis=1) for p in pivots], axis=1), 0))


def dealt(train: DataFrame, pivots: np.ndarray) -> DataFrame:
    """train (t, v, ...) with its pivot and the distance r from it."""

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = distances(matrix(batch.column("v"), pivots.shape[1]), pivots)
            own = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32()), pa.array(d[np.arange(len(d)), own])], names=[*batch.schema.names, "pivot", "r"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in train.schema)
    return train.mapInArrow(deal, f"{fields}, pivot int, r double")


def opened(queries: DataFrame, pivots: np.ndarray, far: np.ndarray, least: np.ndarray, k: int) -> DataFrame:
    """(query, q, pivot, d, within): for each of queries (query, q) the pivots to open, d from them, and what its neighbours are within."""
    between = distances(pivots, pivots)

    def open_(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch.column("q"), pivots.shape[1])
            d = distances(q, pivots)
            sums = (d[:, :, None] + least).reshape(len(d), -1)
            within = (np.partition(sums, k - 1, axis=1)[:, k - 1] if k <= sums.shape[1] else np.full(len(d), np.inf)) * (1 + SLACK) + SLACK
            own = d.argmin(axis=1)
            gap = between[own]
            with np.errstate(divide="ignore", invalid="ignore"):
                behind = np.where(gap > 0, (d**2 - d[np.arange(len(d)), own][:, None] ** 2) / (2 * gap), 0.0)
            row, pivot = np.nonzero((np.maximum(d - far, behind * (1 - SLACK)) <= within[:, None]) & (far >= 0))
            yield pa.RecordBatch.from_arrays([batch.column("query").take(pa.array(row)), lists(q[row]), pa.array(pivot, pa.int32()), pa.array(d[row, pivot]), pa.array(within[row])], names=["query", "q", "pivot", "d", "within"])

    kind = queries.schema["query"].dataType.simpleString()
    return queries.mapInArrow(open_, f"query {kind}, q array<double>, pivot int, d double, within double")


def compared(queries: DataFrame, train: DataFrame, key: str, vector: str, k: int, keep: tuple[str, ...] = (), pivots: int = PIVOTS, block: int = BLOCK, staging: Staging | None = None) -> DataFrame:
    """(query, t, d2, keep, n_compared): from each block that a query opens its k nearest rows of it; n_compared (rows compared) is on the first of them."""
    clean = lambda df: df.where(F.col(key).isNotNull() & F.coalesce(~F.exists(vector, lambda x: x.isNull()), F.lit(False)))
    own = clean(train).select(F.col(key).alias("t"), F.col(vector).cast("array<double>").alias("v"), *keep)
    asked = clean(queries).select(F.col(key).alias("query"), F.col(vector).cast("array<double>").alias("q"))
    at = np.array([r[0] for r in own.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(pivots).collect()], float)
    kind = train.schema[key].dataType.simpleString()
    kept = [f"`{c}` {train.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([f"query {queries.schema[key].dataType.simpleString()}", f"t {kind}", "d2 double", *kept, "n_compared long"])
    if not len(at):
        return queries.sparkSession.createDataFrame([], schema)
    rows = staging(dealt(own, at)) if staging else dealt(own, at)
    place = F.row_number().over(Window.partitionBy("pivot").orderBy("r"))
    far, least, sizes = np.full(len(at), -1.0), np.full((len(at), k), np.inf), np.zeros(len(at), int)
    for r in rows.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("far")).collect():
        far[r["pivot"]], sizes[r["pivot"]] = r["far"], r["n"]
    for r in rows.select("pivot", "r", place.alias("k")).where(F.col("k") <= k).collect():
        least[r["pivot"], r["k"] - 1] = r["r"]
    asked = opened(asked, at, far, least, k)
    asked = staging(asked) if staging else asked
    asks = {r["pivot"]: r["n"] for r in asked.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Blocks of a pivot's rows, and of the queries that open it.
    cut = lambda n: F.array(*[F.lit(max(1, -(-int(x) // block))) for x in n])
    row_blocks, query_blocks = F.get(cut(sizes), F.col("pivot")), F.get(cut([asks.get(p, 0) for p in range(len(at))]), F.col("pivot"))
    each = lambda n, name: F.explode(F.sequence(F.lit(0), n - 1)).alias(name)
    left = asked.withColumn("own", F.pmod(F.xxhash64("query"), query_blocks).cast("int")).select("*", each(row_blocks, "part"))
    right = rows.withColumn("part", F.pmod(F.xxhash64("t"), row_blocks).cast("int")).select("*", each(query_blocks, "own"))

    names = ["t", *keep]

    def meet(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found: dict[str, list] = {n: [] for n in ("query", "t", "d2", *keep, "n_compared")}
        if len(asking) and len(held):
            held = held.sort_values("t", kind="stable")
            v, r, own = np.stack(held["v"].to_numpy()), held["r"].to_numpy(), {n: held[n].tolist() for n in names}
            for query, q, d, within in zip(asking["query"], asking["q"], asking["d"], asking["within"]):
                near = np.flatnonzero(np.abs(r - d) <= within)
                if len(near):
                    d2 = np.round(((v[near] - q) ** 2).sum(axis=1), 9)
                    best = np.argsort(d2, kind="stable")[:k]
                    found["query"] += [query] * len(best)
                    found["d2"] += d2[best].tolist()
                    found["n_compared"] += [len(near)] + [0] * (len(best) - 1)
                    for n in names:
                        found[n] += [own[n][j] for j in near[best]]
        return pd.DataFrame({n: pd.Series(x, dtype=object) for n, x in found.items()})

    by = ["pivot", "part", "own"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(meet, schema)


def nearest(queries: DataFrame, train: DataFrame, key: str, vector: str, k: int, keep: tuple[str, ...] = (), **options) -> DataFrame:
    """(query, place, t, d2, keep): the k nearest rows of train to each row of queries, by squared Euclidean distance rounded to nine places, ties by key.

    vector is an array of numbers of one length. Rows with a null key, a null array or a null in it are left out; queries
    have fewer than k neighbours where train has fewer rows. keep names columns of train to bring along.
    """
    found = compared(queries, train, key, vector, k, keep, **options)
    place = F.row_number().over(Window.partitionBy("query").orderBy("d2", "t"))
    return found.select("query", place.alias("place"), "t", "d2", *keep).where(F.col("place") <= k)


def neighbours(queries: DataFrame, train: DataFrame, key: str, vector: str, label: str, k: int) -> DataFrame:
    """(query, place, label) of the k nearest rows; see nearest()."""
    return nearest(queries, train.select(key, vector, F.col(label).alias("label")), key, vector, k, ("label",)).select("query", "place", "label")
