"""All pairs of documents whose cosine reaches a bound, without a shuffle of pairs.

Equal vectors are one class, so copies are never paired. The rest meet in blocks, each pair of blocks once (see blocks). A
vector is first put on a bounded number of coordinates: the most frequent terms have one each, the others share some by a
hash, each with the length of what it holds. The product of two such vectors is never below their cosine, so one small
matrix product leaves out most pairs of a block, and only the rest are summed up over all terms, there and then. Terms
of a single vector are in no product and left out. The number of pairs is quadratic; what is shuffled and kept is not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import Staging
from .blocks import coded, dealt, made, packed

#: Vectors of a block.
HELD = 1024
#: Terms with a coordinate of their own, and coordinates that the others share.
FREQUENT, SHARED = 256, 1024
SLACK = 1e-4


def classes(counts: DataFrame, key: str) -> DataFrame:
    """(key, class): the least key of the documents with the same (term, tf)."""
    # One document's terms come together.
    own = counts.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("term", "tf"))).alias("v")).select(key, F.sha2(F.to_json("v"), 256).alias("h"))
    return own.join(own.groupBy("h").agg(F.min(key).alias("class")), "h").select(key, "class")


def placed(weights: DataFrame, key: str) -> DataFrame:
    """(k, t, w, c): a vector's terms, weights and coordinates as arrays; only terms that another vector has too, if it has any."""
    frequency = weights.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # At most FREQUENT rows.
    top = frequency.orderBy(F.desc("df"), "term").limit(FREQUENT).select("term", (F.row_number().over(Window.orderBy(F.desc("df"), "term")) - 1).alias("own"))
    shared = F.lit(FREQUENT) + F.pmod(F.xxhash64("term"), F.lit(SHARED))
    cells = weights.join(frequency.select("term"), "term").join(F.broadcast(top), "term", "left").withColumn("c", F.coalesce("own", shared).cast("int"))
    # One document's terms come together.
    return dealt(cells, key).groupBy(F.col(key).alias("k")).agg(F.collect_list(F.struct("term", "weight", "c")).alias("x")).select("k", F.col("x.term").alias("t"), F.col("x.weight").alias("w"), F.col("x.c").alias("c"))


def linked(weights: DataFrame, key: str, least: float, verified: bool) -> DataFrame:
    """(a, b, cosine), a < b: pairs that reach the bound by their coordinates; if verified, by all their terms."""
    kind, width = weights.schema[key].dataType.simpleString(), FREQUENT + SHARED

    def cells(c: dict[str, pa.Array], name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = pc.list_value_length(c[f"{name}_w"]).to_numpy(zero_copy_only=False)
        w, at = (c[f"{name}_{x}"].flatten().to_numpy(zero_copy_only=False) for x in "wc")
        rows = np.repeat(np.arange(len(sizes)), sizes)
        square = np.bincount(rows * width + at, w * w, len(sizes) * width)
        return np.concatenate([[0], np.cumsum(sizes)]), w, np.sqrt(square).astype(np.float32).reshape(-1, width)

    def of(c: dict[str, pa.Array]) -> Iterator[tuple]:
        (start_a, w_a, x), (start_b, w_b, y) = cells(c, "a"), cells(c, "b")
        i, j = np.nonzero(x @ y.T >= least - SLACK)
        one, two = c["a_k"].take(pa.array(i)), c["b_k"].take(pa.array(j))
        if c["a_k"].equals(c["b_k"]):  # a block and itself
            wanted = pc.less(one, two).to_numpy(zero_copy_only=False)
            i, j = i[wanted], j[wanted]
        if not len(i):
            return
        cosine = np.full(len(i), np.nan)
        if verified:
            book = pc.unique(c["a_t"].flatten())
            code_a, code_b = coded(c["a_t"].flatten(), book), coded(c["b_t"].flatten(), book)
            long = np.zeros(len(book) + 1)  # the last one is for terms that are in no vector of the first block
            ends = np.flatnonzero(np.diff(i, append=-1)) + 1
            for begin, end in zip([0, *ends[:-1]], ends, strict=True):
                own = slice(start_a[i[begin]], start_a[i[begin] + 1])
                long[code_a[own]] = w_a[own]
                for k in range(begin, end):
                    other = slice(start_b[j[k]], start_b[j[k] + 1])
                    cosine[k] = long[code_b[other]] @ w_b[other]
                long[code_a[own]] = 0
            cosine = np.round(cosine, 9)
            i, j, cosine = i[cosine >= least], j[cosine >= least], cosine[cosine >= least]
        one, two = c["a_k"].take(pa.array(i)), c["b_k"].take(pa.array(j))
        rising = pc.less(one, two)
        yield pc.if_else(rising, one, two), pc.if_else(rising, two, one), pa.array(cosine, pa.float64())

    with Staging() as keep:
        # Written once, so that both sides of the join are the same blocks, with the same numbers.
        blocks = keep(packed(placed(keep(weights), key), "a", HELD).withColumn("a_id", F.monotonically_increasing_id()))
        right = blocks.select(*[F.col(n).alias(f"b_{n[2:]}") for n in blocks.columns])
        pairs = blocks.join(right, F.col("a_id") <= F.col("b_id")).drop("a_id", "b_id")
        # This table is the result's own and stays.
        return Staging().__enter__()(made(pairs, of, f"a {kind}, b {kind}, cosine double"))


def candidates(weights: DataFrame, key: str, least: float) -> DataFrame:
    """(a, b), a < b, of the vectors that may have a cosine of `least`."""
    return linked(weights, key, least, False).select("a", "b")


def cosines(weights: DataFrame, key: str, least: float) -> DataFrame:
    """(a, b, cosine), a < b: all pairs of vectors (key, term, weight), each of length 1, whose cosine, to nine places, is at least `least` (above 0)."""
    return linked(weights, key, least, True)


def similar_documents(counts: DataFrame, weights: DataFrame, key: str, least: float) -> DataFrame:
    """(key, class, n_links): of each document with terms its class, and to how many other classes the class has a cosine of `least`.

    counts (key, term, tf) and weights (key, term, weight) are of the same documents; equal counts have equal weights.
    """
    member = Staging().__enter__()(classes(counts, key))  # the result's own, like the pairs
    pairs = cosines(weights.join(member.where(F.col(key) == F.col("class")).select(key), key), key, least)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n_links"))
    return member.join(ends, "class", "left").select(key, "class", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
