"""Benchmark decontamination: which words of a document are inside a window that it shares with a benchmark item.

A prefix-filtered set join. A window of an item is the set of its shingles; a document holds the window only if it holds
every shingle of it, so the rarest one, the prefix of the window, is all that must be joined.

1. Documents are read once. Of a text's shingles those that some item has too are kept with their places; a bit map of
   all shingles of the benchmark, at most MAX_BITS, tells them on the executors. It lets a few others through.
2. Shingles are ordered by how many texts hold them, rarest first, and each window's first one is its prefix.
3. Texts and windows are joined on prefixes. The shingle's places in both say where the window would begin; those that
   would begin before the text or end behind it are passed over.
4. The words there are compared with the window's in the texts of the candidates, which are read again for that.

The benchmark is a table like any other: it is never gathered on the driver, and its size doesn't change the plan. What
a text holds depends on its words alone, so equal texts are compared once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Keep, Temporary, bucket_of, buckets_of, packed, unpacked
from .ngram_jaccard import mixed

WINDOW = 10
#: Words of a shingle; a window of fewer words is one shingle.
SHINGLE = 5
#: Bits for each shingle of the benchmark, and the most in all: 64 MB.
BITS_A_SHINGLE = 16
MAX_BITS = 2**29

#: Bytes of words stay, A to Z in lower case; all others part words.
TO_WORDS = bytes((b | 0x20) if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_RNG = np.random.default_rng(20240502)
_OF_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_OF_PLACE = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_BASE, _SPACE = 0x9E3779B97F4A7C15, 0x20
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(max(n, 2 * len(_POWERS[k])), base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word, from sums of byte values times powers of the place."""
    data = np.frombuffer(text.translate(TO_WORDS), dtype=np.uint8)
    gap = np.concatenate(([True], data == _SPACE, [True]))
    starts, ends = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    up, down = powers(max(len(data), 1))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_OF_BYTE[data] * up[: len(data)])))
    return mixed((sums[ends] - sums[starts]) * down[starts])


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of so many words, in their order."""
    n = max(len(words) - size + 1, 0)
    return mixed(sum((words[k : k + n] * _OF_PLACE[k] for k in range(size)), np.full(n, size, dtype=np.uint64))).view(np.int64)


def windows_of(benchmark: DataFrame) -> DataFrame:
    """(item, window, size, tokens): each window of each item, its words joined by spaces, and its shingles in order."""

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words, hashes = words_of(text or b""), word_hashes(text or b"")
                size = min(WINDOW, len(words))
                tokens = shingles(hashes, min(SHINGLE, size)) if words else None
                for i in range(len(words) - size + 1) if words else ():
                    rows.append((item, b" ".join(words[i : i + size]), size, tokens[i : i + max(size - SHINGLE, 0) + 1]))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.binary(), pa.int32(), pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "window", "size", "tokens"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(windows, "item string, window binary, size int, tokens array<long>")


def bit_map(tokens: DataFrame) -> np.ndarray:
    """One bit for each token (token), by its lowest bits; words of 64 bits, of which only those with any come to the driver."""
    n = tokens.count()
    bits = min(MAX_BITS, 1 << max(10, (BITS_A_SHINGLE * n - 1).bit_length() if n else 0))
    place = F.pmod("token", F.lit(bits))
    words = tokens.select((F.shiftright(place, 6)).alias("at"), F.expr("shiftleft(1L, CAST(pmod(token, 64) AS INT))").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(bits // 64, dtype=np.uint64)
    for batch in words.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy().view(np.uint64)
    return out


def found_in(bits: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    place = tokens.view(np.uint64) & np.uint64(64 * len(bits) - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def scanned(documents: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """(doc_id, a, b, n_words, tokens, places): 128 bits of hash of each text, its words, and the shingles of the given
    sizes that may be of the benchmark, with the places of their first words."""
    given = documents.sparkSession.sparkContext.broadcast(bits)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, tokens, places = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = word_hashes(text or b"")
                own = [(x, np.flatnonzero(found_in(given.value, x))) for x in (shingles(words, size) for size in sizes)]
                n.append(len(words))
                tokens.append(np.concatenate([x[at] for x, at in own] or [np.empty(0, dtype=np.int64)]))
                places.append(np.concatenate([at for _, at in own] or [np.empty(0, dtype=np.int64)]))
            columns = [batch.column(c) for c in ("doc_id", "a", "b")] + [pa.array(n, pa.int64()), pa.array(tokens, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "a", "b", "n_words", "tokens", "places"])

    return keyed(documents).mapInArrow(scan, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, a long, b long, n_words long, tokens array<long>, places array<long>")


def keyed(documents: DataFrame) -> DataFrame:
    """documents with a and b, 128 bits of hash of the text."""
    text = F.coalesce("text", F.lit(""))
    return documents.withColumns({"a": F.xxhash64(text), "b": F.xxhash64(F.lit(7), text)})


def hits(documents: DataFrame, scan: DataFrame, windows: DataFrame, keep: Keep) -> DataFrame:
    """(a, b, places, windows): for each text with windows of items, the words hit and the windows found."""
    texts = scan.where(F.size("tokens") > 0).groupBy("a", "b").agg(F.first("n_words").alias("n_words"), F.first(F.arrays_zip("tokens", "places")).alias("held"))
    postings = keep(texts.select("a", "b", "n_words", F.explode("held").alias("x")).select("a", "b", "n_words", "x.*"))
    frequency = postings.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"))
    # The prefix of each window: its rarest shingle (ties by the shingle), and where in the window it is. A shingle that
    # no text holds leaves the window out.
    own = windows.groupBy("window").agg(F.first("size").alias("size"), F.first("tokens").alias("tokens"))
    places = own.select("window", "size", F.posexplode("tokens").alias("offset", "tokens")).join(frequency, "tokens", "left")
    prefixes = places.groupBy("window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "tokens", "offset")).alias("x"), F.first("size").alias("size")).where("x.n > 0")
    prefixes = keep(prefixes.select("window", "size", F.col("x.tokens").alias("tokens"), F.col("x.offset").alias("offset")))
    joined = postings.join(prefixes.hint("merge"), "tokens").withColumn("start", F.col("places") - F.col("offset"))
    candidates = joined.where("start >= 0 AND start + size <= n_words").select("a", "b", "start", "size", "window")
    # At most all windows that could be in one text come together, a few for each of its words.
    candidates = keep(candidates.groupBy("a", "b").agg(F.collect_list(F.struct("start", "size", "window")).alias("found")))
    # Keeps texts that share no bucket with a candidate out of the shuffle.
    again = keyed(documents.select("text")).withColumn("__bucket", bucket_of("a")).join(buckets_of(candidates, "a"), "__bucket", "left_semi")
    again = again.dropDuplicates(["a", "b"]).join(candidates.hint("merge"), ["a", "b"]).select("a", "b", "text", "found")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for text, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("found").to_pylist()):
                words = words_of(text)
                right = [x for x in found if b" ".join(words[x["start"] : x["start"] + x["size"]]) == x["window"]]
                held.append((sorted({k for x in right for k in range(x["start"], x["start"] + x["size"])}), sorted({x["window"] for x in right})))
            columns = [batch.column("a"), batch.column("b"), pa.array([x[0] for x in held], pa.list_(pa.int64())), pa.array([x[1] for x in held], pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "places", "windows"])

    return keep(again.mapInArrow(verify, "a long, b long, places array<long>, windows array<binary>").where(F.size("places") > 0))


def found_windows(documents: DataFrame, benchmark: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What scanned(), hits() and windows_of() give for documents (doc_id, text)."""
    windows = keep(windows_of(benchmark))
    sizes = sorted({min(SHINGLE, r["size"]) for r in windows.select("size").distinct().collect()})
    bits = bit_map(windows.select(F.explode("tokens").alias("token")).distinct())
    scan = keep(scanned(documents, bits, sizes))
    return scan, hits(documents, scan, windows, keep), windows


def decontamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For each row of documents (doc_id, text): n_words, n_hit, n_items, items_sha256 and contaminated.

    A null or empty text has no words; an item without words has no windows, and items of the same id count once. A null
    item id counts as the empty string. Repeated rows give repeated results; other columns are ignored.
    """
    temporary = Temporary()
    documents = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    scan, found, windows = found_windows(documents, benchmark, temporary.staged)
    items = found.select("a", "b", F.explode("windows").alias("window")).join(windows.select("window", "item").distinct(), "window").select("a", "b", "item").distinct()
    # The contract's digest needs the ids of a text's items in order, in one value.
    items = items.groupBy("a", "b").agg(F.array_sort(F.collect_list("item")).alias("items"))
    of_text = found.select("a", "b", F.size("places").cast("long").alias("n_hit")).join(items, ["a", "b"])
    out = scan.select("doc_id", "a", "b", "n_words").join(of_text, ["a", "b"], "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return temporary.last(out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    ))


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents without a hit word, with all their columns."""
    temporary = Temporary()
    _, found, _ = found_windows(documents.select("doc_id", F.col("text").cast("string").alias("text")), benchmark, temporary.staged)
    hit = temporary.last(found.select("a", "b"))
    # Documents that share no bucket with a hit text don't meet the list of them.
    concerned = buckets_of(hit, "a")
    df = keyed(packed(documents)).withColumn("__bucket", bucket_of("a"))
    near = df.join(concerned, "__bucket", "left_semi").join(hit.hint("merge"), ["a", "b"], "left_anti")
    return unpacked(near.unionByName(df.join(concerned, "__bucket", "left_anti")), documents)
