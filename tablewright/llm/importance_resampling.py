"""Target-distribution importance resampling: documents are drawn by how much likelier their words are in a target.

Hashed runs of one to three words are counted in the documents and in the target, which gives an integer gain for each of
BUCKETS buckets. A document's weight is the sum of the gains of its runs, looked up in one array; a Gumbel number from a
hash of its id is added, so that the highest scores are a sample without replacement.

Which scores are drawn is read from an exact histogram of the integer scores: how many rows have a greater score is a
suffix sum over it, which is the offset of the score's first rank, and the cutoff is the score where the offsets reach
the size of the draw. Rows of the surviving scores alone are numbered, within each score by doc_id. The histogram is
summed in bands, so neither it nor the rows ever come to one task.

Texts are read twice, for the counts and for the weights, and never shuffled; each task sums its counts to at most
BUCKETS rows, which is also the size of the array that is broadcast. Words are hashed in Arrow batches, as a run's crc32
can go on from that of its first words there; with SQL functions, which hash whole strings, it took six times as long.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Temporary

#: Hash buckets of runs of words: the gains are one array of this size.
BUCKETS = 10_000
#: Ranges of scores whose suffix sums are made apart.
BANDS = 1024
#: A-Z in lower case, and ASCII but for letters and digits, which parts words, as spaces. Bytes above are parts of words.
PLAIN = bytes(k + 32 if 65 <= k <= 90 else k if k > 127 or chr(k).isalnum() else 32 for k in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def runs_of(words: list[bytes]) -> np.ndarray:
    """Bucket of each run of one, two and three consecutive words, joined by a space, with repeats.

    A run's crc32 continues that of the run without its last word, so no run is ever put together.
    """
    one = list(map(crc32, words))
    following = [b" " + w for w in words[1:]]
    two = list(map(crc32, following, one))  # ends with the shorter list
    three = list(map(crc32, following[1:], two))
    return np.array(one + two + three, np.int64) % BUCKETS


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n) over all rows of texts (text); each task sends its sums only."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                if text:
                    sums += np.bincount(runs_of(words_of(text)), minlength=BUCKETS)
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(sums[held], pa.int64())], names=["bucket", "n"])

    counted = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame) -> np.ndarray:
    """Of each bucket 1000 * ln of its smoothed share in target over that in documents, rounded down. The counts that come to the driver are BUCKETS rows at most."""
    s, t = bucket_counts(documents).withColumnRenamed("n", "s"), bucket_counts(target).withColumnRenamed("n", "t")
    held = {r["bucket"]: (r["s"], r["t"]) for r in s.join(t, "bucket", "full").fillna(0, ["s", "t"]).collect()}
    all_s, all_t = (float(sum(x[k] for x in held.values()) + BUCKETS) for k in (0, 1))
    pairs = (held.get(k, (0, 0)) for k in range(BUCKETS))
    return np.array([math.floor(1000 * math.log(((t + 1.0) * all_s) / ((s + 1.0) * all_t))) for s, t in pairs], np.int64)


def gumbel(seed: int) -> Column:
    """1000 times a Gumbel number from a hash of doc_id, rounded down; a null doc_id counts as the empty string."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296
    return F.floor(-1000 * F.log(-F.log(u)))


def scored(documents: DataFrame, target: DataFrame, seed: int, temporary: Temporary) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of each row of documents."""
    fit = documents.sparkSession.sparkContext.broadcast(gains(documents.select("text"), target.select("text")))

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, runs, weights = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words = words_of(text) if text else []
                own = runs_of(words)
                n.append(len(words))
                runs.append(len(own))
                weights.append(int(fit.value[own].sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n, runs, weights))], names=["doc_id", "n_words", "n_features", "weight"])

    df = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {df.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long"
    return temporary.staged(df.mapInArrow(weigh, schema).withColumn("score", F.col("weight") + gumbel(seed)))


def offsets(rows: DataFrame, bounds: list[float]) -> DataFrame:
    """(score, before): of each score how many rows have a greater one; bounds part the scores into bands."""
    histogram = rows.groupBy("score").agg(F.count(F.lit(1)).alias("n")).withColumn("__x", F.col("score").cast("double"))
    banded = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="__x", outputCol="__band").transform(histogram).drop("__x")
    later = lambda by, of: F.coalesce(F.sum(of).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # At most BANDS rows.
    bands = banded.groupBy("__band").agg(F.sum("n").alias("__all")).select("__band", later(Window.orderBy(F.desc("__band")), "__all").alias("__above"))
    own = later(Window.partitionBy("__band").orderBy(F.desc("score")), "n")
    return banded.withColumn("__own", own).join(F.broadcast(bands), "__band").select("score", (F.col("__own") + F.col("__above")).alias("before"))


def with_ranks(rows: DataFrame, eligible: Column, percent: int, temporary: Temporary) -> DataFrame:
    """Adds rank to rows (doc_id, score, ...): of the eligible ones the floor(percent * N / 100) highest scores have 1, 2, 3 and so on, ties by doc_id."""
    mine = rows.where(eligible)
    n, bounds = mine.agg(F.count(F.lit(1)), F.percentile_approx("score", [k / BANDS for k in range(1, BANDS)], BANDS * 10)).first()
    size = percent * n // 100
    none = F.lit(None).cast("long")
    if not size:
        return rows.withColumn("rank", none)
    surviving = temporary.staged(offsets(mine, [float(b) for b in sorted(set(bounds))]).where(F.col("before") < size))
    cutoff = surviving.agg(F.min("score")).first()[0]
    among = eligible & (F.col("score") >= cutoff)
    number = F.row_number().over(Window.partitionBy("score").orderBy("doc_id")) + F.col("before")
    drawn = rows.where(among).join(surviving, "score").withColumn("rank", number.cast("long"))
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= size, F.col("rank"))).drop("before")
    return drawn.unionByName(rows.where(~among).withColumn("rank", none))


def importance_resampling(documents: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42) -> DataFrame:
    """For each row of documents (doc_id, text): n_words, n_features, weight, score and rank (null if not drawn).

    Drawn are percent of the documents of at least min_words words, rounded down, those of the highest scores, ties to the
    smaller doc_id (null first; rows of the same doc_id and score in any order). A null or empty text has no words, no
    features and weight 0. An empty target or table is one without features. Other columns are ignored.
    """
    temporary = Temporary()
    rows = scored(documents, target, seed, temporary)
    return temporary.last(with_ranks(rows, F.col("n_words") >= min_words, percent, temporary))


def resampled(documents: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of documents that are drawn, with their columns. doc_id must be unique and not null."""
    drawn = importance_resampling(documents, target, **options).where("rank IS NOT NULL").select(F.col("doc_id").alias("__drawn"))
    return documents.join(drawn, F.col("doc_id") == F.col("__drawn"), "left_semi")
