"""Products of all rows of one table with all rows of another, in blocks: rows are packed some hundreds to a block, every
pair of blocks is one row, and its products are one matrix product. No pair of rows is ever shuffled or kept.

Blocks meet by a cross join, so a task holds a few pairs of blocks at a time, whatever the tables' size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sums import matrix

#: Rows of a block, and partitions of blocks for each core.
BLOCK = 1024
PARTS = 2
#: Pairs looked at, at once, and terms of a dense part.
STRIP, TERMS = 128, 2048
#: Parts of the left side of banded pairs; PARTS for each core in all, for each band.
SHARES = 3
#: Rows of a band that are put in order of their cosines, before all others.
FIRST = 500_000
#: A cosine within this of the place where it is rounded up is summed up again in the order of its elements.
TIE = 1e-4


def listed(kind: T.DataType) -> str:
    return f"array<{kind.simpleString()}>"


def dealt(df: DataFrame, column: str) -> DataFrame:
    """Rows dealt to all cores by a column, however few files or partitions they come from."""
    return df.repartition(PARTS * df.sparkSession.sparkContext.defaultParallelism, column)


def packed(df: DataFrame, side: str, size: int | None = None) -> DataFrame:
    """Each column of df as an array of `size` rows' values, named by side; the last block of a partition is shorter."""
    size = size or BLOCK
    names = [f"{side}_{c}" for c in df.columns]

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def whole(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows).combine_chunks()
            columns = [c.chunk(0) for c in table.columns]
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns], names=names)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - n)
                held, n, at = [*held, part], n + part.num_rows, at + part.num_rows
                if n == size:
                    yield whole(held)
                    held, n = [], 0
        if n:
            yield whole(held)

    return df.mapInArrow(pack, ", ".join(f"{name} {listed(f.dataType)}" for name, f in zip(names, df.schema.fields, strict=True)))


def made(pairs: DataFrame, of: Callable[[dict[str, pa.Array]], Iterator[tuple]], schema: str) -> DataFrame:
    """The rows (a, b, cosine) that of() makes of each pair of blocks; it gets the columns of both, and yields columns."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from (pa.RecordBatch.from_arrays(list(c), names=["a", "b", "cosine"]) for c in of({n: batch.column(n)[k].values for n in batch.schema.names}))

    return pairs.mapInArrow(make, schema)


def met(left: DataFrame, right: DataFrame, of: Callable[[dict[str, pa.Array]], Iterator[tuple]], schema: str) -> DataFrame:
    """made() of all pairs; Spark broadcasts a side only within its own size limit."""
    return made(left.crossJoin(right), of, schema)


def banded(left: DataFrame, right: DataFrame, n: int) -> DataFrame:
    """All pairs of blocks in each of n bands, and the band's number in column z; no task has two bands.

    Blocks are dealt out as they are packed, since a task for each pair of partitions reads them.
    """
    spark = left.sparkSession
    parts, whole = max(1, PARTS * spark.sparkContext.defaultParallelism // SHARES), "shuffle_replicate_nl"
    bands = spark.range(0, n, 1, n).select(F.array(F.col("id")).alias("z"))
    # Partitions of blocks are alike, as rows were dealt out by a key.
    spread = lambda df, k: df.withColumn("p", F.spark_partition_id()).repartitionById(k, "p").drop("p").hint(whole)
    return bands.crossJoin(spread(left, SHARES)).crossJoin(spread(right, parts))


def in_bands(pairs: DataFrame, of: Callable[[dict[str, pa.Array]], Iterator[tuple]], schema: str) -> DataFrame:
    """made() of banded() pairs, where the first rows of a task come in order of their cosines.

    A column writer judges by its first rows whether a dictionary of values pays, and these repeat theirs.
    """

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, waits = [], 0, True

        def ordered() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            return rows.take(np.argsort(rows["cosine"].to_numpy(), kind="stable")).combine_chunks().to_batches()[0]

        for batch in batches:
            for k in range(batch.num_rows):
                for c in of({name: batch.column(name)[k].values for name in batch.schema.names}):
                    rows = pa.RecordBatch.from_arrays(list(c), names=["a", "b", "cosine"])
                    if not waits:
                        yield rows
                        continue
                    held, n = [*held, rows], n + rows.num_rows
                    if n >= FIRST:
                        yield ordered()
                        held, waits = [], False
        if n and held:
            yield ordered()

    return pairs.mapInArrow(make, schema)


def rounded_up(x: np.ndarray, digits: int) -> np.ndarray:
    """Rounded as SQL does: scaled, halves away from zero, and a small negative number is -0.0."""
    y = x * 10.0**digits
    whole = np.rint(y)
    return np.where(np.abs(y - np.trunc(y)) == 0.5, np.trunc(y) + np.copysign(1, y), whole) / 10.0**digits


def vector_cosines(queries: DataFrame, df: DataFrame, key: str, vector: str, width: int, digits: int) -> DataFrame:
    """(a, b, cosine): of each of queries with each row of another key, rounded to so many digits; vectors of width numbers.

    Null where a vector is null or has a null, NaN where it has no length.
    """
    kind = df.schema[key].dataType.simpleString()
    side = lambda rows, name: packed(dealt(rows.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v")), "k"), name)

    def of(c: dict[str, pa.Array]) -> Iterator[tuple]:
        with np.errstate(all="ignore"):
            a, b = matrix(c["a_v"], width), matrix(c["b_v"], width)
            gone_a, gone_b = (~np.isfinite(x).all(axis=1) for x in (a, b))
            none_a, none_b = (np.array([x is None or None in x for x in v.to_pylist()]) if gone.any() else gone for v, gone in ((c["a_v"], gone_a), (c["b_v"], gone_b)))
            norm_a, norm_b = np.zeros(len(a)), np.zeros(len(b))
            for j in range(width):  # one after another, as a loop over a row does
                norm_a, norm_b = norm_a + a[:, j] * a[:, j], norm_b + b[:, j] * b[:, j]
            for at in range(0, len(a), STRIP):
                part = slice(at, at + STRIP)
                cosine = a[part] @ b.T / np.sqrt(norm_a[part, None] * norm_b)
                scaled = np.abs(cosine) * 10.0**digits
                # Where a product's last bits decide, the sum is made in order.
                i, j = np.nonzero((np.abs(scaled - np.floor(scaled) - 0.5) < TIE) | (np.abs(cosine) < 1e-9))
                exact = np.zeros(len(i))
                for t in range(width):
                    exact += a[at + i, t] * b[j, t]
                cosine[i, j] = exact / np.sqrt(norm_a[at + i] * norm_b[j])
                cosine = np.clip(cosine, -1.0, 1.0)
                i, j = np.divmod(np.arange(cosine.size), cosine.shape[1])
                found = pa.array(rounded_up(cosine.ravel(), digits), mask=(none_a[at + i] | none_b[j]))
                one, two = c["a_k"].take(pa.array(at + i)), c["b_k"].take(pa.array(j))
                other = pc.not_equal(one, two)
                yield one.filter(other), two.filter(other), found.filter(other)

    return met(side(queries, "a"), side(df, "b"), of, f"a {kind}, b {kind}, cosine double")


def coded(terms: pa.Array, book: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.index_in(terms, book), -1).to_numpy(zero_copy_only=False)


def term_cosines(left: DataFrame, right: DataFrame, key: str, both: bool, least: float, digits: int | None = None, edges: Sequence[float] = ()) -> DataFrame:
    """(a, b, sum of products) of vectors (key, term, weight) with a term in common whose sum is at least `least`.

    With both, left and right are the same vectors and only pairs with a < b are given; else those of unequal keys. With
    digits, sums are rounded to so many. With edges, sums between two of them are made apart from others, by tasks of
    their own that multiply all blocks again: the rows are the same, but a file of them holds few distinct sums, so that
    a dictionary of them fits and a row takes less than half of the disk.
    """
    kind = left.schema[key].dataType.simpleString()

    def side(weights: DataFrame, name: str) -> DataFrame:
        rows = weights.where(F.col(key).isNotNull() & F.col("term").isNotNull() & F.col("weight").isNotNull())
        # One vector's terms come together.
        cells = dealt(rows, key).groupBy(F.col(key).alias("k")).agg(F.collect_list(F.struct("term", F.col("weight").cast("double").alias("weight"))).alias("c"))
        return packed(cells.select("k", F.col("c.term").alias("t"), F.col("c.weight").alias("w")), name)

    def cells(c: dict[str, pa.Array], name: str) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        sizes = pc.list_value_length(c[f"{name}_t"]).to_numpy(zero_copy_only=False)
        return np.repeat(np.arange(len(sizes)), sizes), c[f"{name}_t"].flatten(), c[f"{name}_w"].flatten().to_numpy(zero_copy_only=False)

    lows, highs = [float("-inf"), *edges], [*edges, float("inf")]

    def of(c: dict[str, pa.Array]) -> Iterator[tuple]:
        (row_a, term_a, w_a), (row_b, term_b, w_b) = cells(c, "a"), cells(c, "b")
        n, m, total, shared = len(c["a_k"]), len(c["b_k"]), None, None
        band = c["z"][0].as_py() if edges else 0
        book = pc.unique(term_a)
        code_a, code_b = coded(term_a, book), coded(term_b, book)
        # A sum of products that are all above 0 is above 0 where there is one.
        above = min(w_a.min(initial=1), w_b.min(initial=1)) > 1e-150
        for low in range(0, len(book), TERMS):
            wide = min(TERMS, len(book) - low)
            dense = []
            for row, code, w, size in ((row_a, code_a, w_a, n), (row_b, code_b, w_b, m)):
                own = (code >= low) & (code < low + wide)
                flat, place = np.zeros(size * wide), row[own].astype(np.int64) * wide + code[own] - low
                np.add.at(flat, place, w[own])
                held = np.zeros(0 if above else size * wide, np.float32)
                if not above:
                    held[place] = 1
                dense.append((flat.reshape(size, wide), held.reshape(-1, wide)))
            (x, held_x), (y, held_y) = dense
            sums = y @ x.T
            total = sums if total is None else total + sums
            if not above:
                common = held_y @ held_x.T
                shared = common if shared is None else shared + common
        if total is None:
            return
        for at in range(0, m, STRIP):
            part = total[at : at + STRIP]
            wanted = (part >= max(least, lows[band])) & (part < highs[band] if band < len(edges) else True)
            j, i = np.nonzero(wanted & (part > 0 if above else shared[at : at + STRIP] > 0))
            one, two = c["a_k"].take(pa.array(i)), c["b_k"].take(pa.array(at + j))
            apart = pc.less(one, two) if both else pc.not_equal(one, two)
            found = part[j, i]
            yield one.filter(apart), two.filter(apart), pa.array(found if digits is None else rounded_up(found, digits)).filter(apart)

    a, b, schema = side(left, "a"), side(right, "b"), f"a {kind}, b {kind}, cosine double"
    return in_bands(banded(a, b, len(lows)), of, schema) if edges else met(a, b, of, schema)
