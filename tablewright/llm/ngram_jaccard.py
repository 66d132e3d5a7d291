"""N-gram Jaccard join by a token-group matrix: documents linked by alike sets of word shingles, as components.

1. A document's set is its distinct shingles as 64-bit hashes. Documents of equal sets, by their sizes and 128-bit
   hashes, are one class.
2. Shingles are ordered, those found often last; a link needs a shingle in common among the first of either set, so only
   those (the prefix) are shuffled, and of them only the ones that several classes hold are kept.
3. Classes with the same most widely held shingle are similar and form a group. Each is compared with its group's
   leader, the class that shares the largest part of its prefix: one comparison a class, which links most copies.
4. What is left are links between classes that aren't connected yet. Groups are split to at most about GROUP_DOCS
   classes of about the same size, those linked with their leader apart from the others. The matrix, which shingle is in which group's union,
   is stored for shingles that unconnected classes hold. Joined with the prefixes of the classes it gives how many
   shingles of a class are in a group's union, which bounds what it can have in common with any member. Only where that
   and the sizes allow a link is the group opened and the class compared with each of its members; groups of classes
   that all are connected with it are passed over.
5. Components of the links, and the smallest doc_id of each, come from repeated joins.

How often a shingle is found is counted over all documents, chunk by chunk: only shingles found twice in a chunk count,
so that few rows are shuffled. The order affects speed alone, as any fixed order finds all links. The shingles that are
put last are sent to the executors whole; they are those of the highest counts, at most MAX_HOT.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import Keep, Temporary, bucket_of, buckets_of, packed, staged, unpacked

WORDS = 4
PERCENT = 85
#: Classes in a group, about, and classes that one task compares with a group.
GROUP_DOCS = 256
QUERY_DOCS = 1024
GROUP_SHINGLES = 1_000_000
CHUNK = 4_000_000
MAX_HOT = 100_000
COUNTED_TO = 4096

_RNG = np.random.default_rng(20240501)
_OF_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_OF_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS = {_BASE: np.ones(1, dtype=np.uint64), _INVERSE: np.ones(1, dtype=np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS[base]) < n:
        steps = np.full(max(n, 2 * len(_POWERS[base])), base, dtype=np.uint64)
        steps[0] = 1
        _POWERS[base] = np.multiply.accumulate(steps)
    return _POWERS[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix that makes any two inputs look unrelated."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of runs of words; all words as one where there are fewer; none without words."""
    data = np.frombuffer((text or b"").lower(), dtype=np.uint8)
    gap = np.concatenate(([True], _IS_SPACE[data], [True]))
    starts, ends = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    if not len(starts):
        return np.empty(0, dtype=np.int64)
    # Sums of byte values times powers of the place; what two places enclose, divided by the first one's power, is the word's.
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_OF_BYTE[data] * powers(_BASE, len(data)))))
    own = mixed((sums[ends] - sums[starts]) * powers(_INVERSE, len(data))[starts])
    if len(own) < words:
        whole = sum((own[k : k + 1] * _OF_PLACE[32 + k] for k in range(len(own))), np.full(1, len(own), dtype=np.uint64))
        return np.unique(mixed(whole).view(np.int64))
    n = len(own) - words + 1
    runs = sum((own[k : k + n] * _OF_PLACE[k] for k in range(words)), np.zeros(n, dtype=np.uint64))
    return np.unique(mixed(runs).view(np.int64))


def signatures(tokens: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set, together 128 bits."""
    plain = tokens.view(np.uint64)
    return tuple(int(mixed(plain ^ np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64)) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F))


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def batches_of(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def frequent(documents: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles to put last, sorted, and their counts: at most MAX_HOT."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            tokens, n = np.unique(np.concatenate(held or [np.empty(0, dtype=np.int64)]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(tokens[n > 1]), pa.array(n[n > 1].astype(np.int64))], names=["token", "n"])

        for batch in batches:
            for text in batches_of(batch.column(0)):
                held.append(shingles(text, words))
                size += len(held[-1])
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
        yield flush()

    temporary = Temporary()
    counts = temporary.staged(documents.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    # The least count of those put last: the lowest that leaves at most MAX_HOT of them, or else they are the first MAX_HOT.
    capped = F.least("n", F.lit(COUNTED_TO)).alias("n")
    least, held = COUNTED_TO, 0
    for n, tokens in sorted(counts.groupBy(capped).agg(F.count(F.lit(1))).collect(), reverse=True):
        if (held := held + tokens) > MAX_HOT:
            break
        least = n
    hot = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "token").limit(MAX_HOT).toPandas()
    temporary.release()
    order = np.argsort(hot["token"].to_numpy(dtype=np.int64))
    return hot["token"].to_numpy(dtype=np.int64)[order], hot["n"].to_numpy(dtype=np.int64)[order]


def found_in(ordered: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def lists_of(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.empty(0, dtype=np.int64)])))



def sets_of(documents: DataFrame, hot: tuple[np.ndarray, np.ndarray], words: int, percent: int) -> DataFrame:
    """(doc_id, a, b, n, prefix): the hashes and the size of each document's set, and its first shingles in order."""
    last = documents.sparkSession.sparkContext.broadcast(hot)

    def first(tokens: np.ndarray) -> np.ndarray:
        size = prefix_size(len(tokens), percent)
        late = found_in(last.value[0], tokens)
        if late.any():
            counts = last.value[1][np.searchsorted(last.value[0], tokens[late])]
            tokens = np.concatenate((tokens[~late], tokens[late][np.argsort(counts, kind="stable")]))
        return tokens[:size]

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingles(t, words) for t in batches_of(batch.column(1))]
            hashes = [signatures(x) for x in own]
            numbers = [pa.array(x, pa.int64()) for x in ([h[0] for h in hashes], [h[1] for h in hashes], [len(x) for x in own])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, lists_of([first(x) for x in own])], names=["doc_id", "a", "b", "n", "prefix"])

    return documents.mapInArrow(sets, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, a long, b long, n long, prefix array<long>")


def classes_of(docs: DataFrame) -> DataFrame:
    """(c, rep, a, b, n, prefix): a row for each set with its smallest doc_id, numbered by c once it is written."""
    own = docs.where("n > 0 AND doc_id IS NOT NULL").groupBy("a", "b", "n").agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"))
    return own.select(F.monotonically_increasing_id().alias("c"), "rep", "a", "b", "n", "prefix")


def shared_of(classes: DataFrame) -> DataFrame:
    """(c, rep, a, b, n, tokens, key): classes that share shingles of their prefixes, those shingles, and the most widely held one."""
    postings = classes.select("c", F.explode("prefix").alias("token"))
    several = postings.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    # Merged at every size: both sides grow with the corpus.
    own = postings.join(several.hint("merge"), "token").groupBy("c").agg(F.collect_list(F.struct("held", "token")).alias("tokens"))
    tokens = F.transform("tokens", lambda x: x["token"])
    return classes.drop("prefix").join(own.hint("merge"), "c").select("c", "rep", "a", "b", "n", tokens.alias("tokens"), F.array_max("tokens")["token"].alias("key"))


def in_common(n: Column, m: Column, percent: int) -> Column:
    """How many shingles the prefixes of linked sets of n and m have in common at least.

    Of two linked sets, the prefix that ends earlier in the order of shingles lacks no more in the other prefix than its
    set may lack. As a real number without rounding, so at most the least whole one; for a range of m it is least at one
    of the ends.
    """
    return (n + m) * percent / (100.0 + percent) - F.greatest(n, m) * percent / 100.0


def star_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """Each class with its group's leader (l_c, l_rep, ...), where a link is possible."""
    part = F.size("tokens") / F.col("n")
    leaders = shared.groupBy("key").agg(F.max(F.struct(part.alias("part"), "c", "rep", "a", "b", "n", F.size("tokens").alias("held"))).alias("l"))
    both = shared.join(leaders, "key").where("c <> l.c").where(f"100 * n >= {percent} * l.n AND 100 * l.n >= {percent} * n")
    enough = F.least(F.size("tokens"), F.col("l.held")) >= in_common(F.col("n"), F.col("l.n"), percent)
    return both.where(enough).select("c", "rep", "a", "b", "n", *[F.col(f"l.{x}").alias(f"l_{x}") for x in ("c", "rep", "a", "b", "n")])


def texts_of(documents: DataFrame, wanted: DataFrame, rep: str = "rep") -> DataFrame:
    """(rep, text) of the documents that are wanted, and of others in the same buckets."""
    some = documents.select(F.col("doc_id").alias(rep), "text").withColumn("__bucket", bucket_of(rep))
    # Keeps most documents out of the shuffle while few are wanted.
    return some.join(buckets_of(wanted, rep), "__bucket", "left_semi").drop("__bucket")


def linked(documents: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """(c, u, v): the pairs of star_pairs() that are linked, and their representatives."""
    kind = documents.schema["doc_id"].dataType

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, leader = None, None
        for batch in batches:
            keep = []
            for a, b, l_a, l_b, text, l_text in zip(*(batch.column(x).to_pylist() for x in ("a", "b", "l_a", "l_b")), batches_of(batch.column("text")), batches_of(batch.column("l_text"))):
                if known != l_text:
                    known, leader = l_text, shingles(l_text, words)
                own = shingles(text, words)
                # A doc_id may have other texts too.
                right = signatures(own) == (a, b) and signatures(leader) == (l_a, l_b)
                common = int(found_in(leader, own).sum()) if right else 0
                keep.append(right and 100 * common >= percent * (len(own) + len(leader) - common))
            yield pa.RecordBatch.from_arrays([batch.column(x) for x in ("c", "rep", "l_rep")], names=["c", "u", "v"]).filter(pa.array(keep, pa.bool_()))

    # Merged at every size: pairs grow with the corpus, so a broadcast would only ever serve small ones.
    own = texts_of(documents, pairs).join(pairs.hint("merge"), "rep")
    leaders = texts_of(documents, pairs.select("l_rep").distinct(), "l_rep").withColumnRenamed("text", "l_text")
    return own.join(leaders.hint("merge"), "l_rep").mapInArrow(compare, f"c long, u {kind.simpleString()}, v {kind.simpleString()}")


def band_of(n: Column) -> Column:
    """A number that rises with the size of a set, by one for every tenth more."""
    return F.floor(F.log(F.greatest(n, F.lit(1))) / F.log(F.lit(1.1)))


def grouped(shared: DataFrame, stars: DataFrame, roots: DataFrame) -> DataFrame:
    """shared with comp, the component so far, and gid: its group, of at most about GROUP_DOCS classes."""
    df = shared.join(roots, F.col("rep") == F.col("node"), "left").withColumn("comp", F.coalesce("root", "rep")).drop("node", "root")
    df = df.join(stars.select("c", F.lit(True).alias("linked")), "c", "left").fillna(False, ["linked"])
    df = df.withColumn("band", band_of(F.col("n")))
    sizes = df.groupBy("key", "linked", "band").agg(F.greatest(F.ceil(F.count(F.lit(1)) / GROUP_DOCS), F.ceil(F.sum("n") / GROUP_SHINGLES)).alias("parts"))
    df = df.join(sizes.where("parts > 1"), ["key", "linked", "band"], "left")
    part = F.pmod(F.xxhash64("c"), F.coalesce("parts", F.lit(1)))
    return df.select("c", "rep", "a", "b", "n", "tokens", "comp", "band", F.xxhash64("key", "linked", "band", part).alias("gid"))


def matrix_of(members: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """Postings (token, c, n) of shingles that classes of several components hold, and the matrix (token, band, gid)."""
    postings = members.select("c", "n", "comp", "band", "gid", F.explode("tokens").alias("token"))
    several = postings.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("token")
    postings = keep(postings.drop("comp").join(several.hint("merge"), "token"))
    return postings.select("token", "c", "n"), keep(postings.select("token", "band", "gid").distinct())


def qualifying(members: DataFrame, keep: Keep, percent: int) -> DataFrame:
    """(c, gid): classes and the groups that may have a member that is linked with them but not connected yet.

    A class meets groups of the bands in which sets of a size that allows a link are, and no others.
    """
    postings, matrix = matrix_of(members, keep)
    bands = F.sequence(band_of(F.ceil(F.col("n") * percent / 100)), band_of(F.floor(F.col("n") * 100 / percent)))
    postings = postings.select("token", "c", F.explode(bands).alias("band"))
    groups = members.groupBy("gid").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("comp").alias("first"))
    bounds = postings.join(matrix, ["token", "band"]).groupBy("c", "gid").agg(F.count(F.lit(1)).alias("common"))
    df = bounds.join(members.select("c", "n", "comp"), "c").join(groups, "gid")
    n, low, high = F.col("n"), F.greatest("least", F.col("n") * percent / 100.0), F.least("most", F.col("n") * 100.0 / percent)
    enough = F.col("common") >= F.least(in_common(n, low, percent), in_common(n, high, percent)) - 1e-6
    # Of two classes that are linked the one of the larger component asks.
    return df.where((F.col("first") < F.col("comp")) & (low <= high) & enough).select("c", "gid")


class Group:
    """Sets of a group's members, by shingle."""

    def __init__(self, members: list[tuple]):
        self.reps, self.comps = [m[0] for m in members], [m[1] for m in members]
        self.sizes = np.array([len(m[2]) for m in members])
        flat, of = np.concatenate([m[2] for m in members]), np.repeat(np.arange(len(members)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.owners = of[order]
        self.union, self.starts = np.unique(flat[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(flat))

    def common(self, tokens: np.ndarray) -> np.ndarray:
        """How many of tokens each member holds."""
        at = np.searchsorted(self.union, tokens[found_in(self.union, tokens)])
        n = self.ends[at] - self.starts[at]
        places = np.arange(n.sum()) + np.repeat(self.starts[at] - np.concatenate(([0], np.cumsum(n)[:-1])), n) if len(at) else np.empty(0, dtype=np.int64)
        return np.bincount(self.owners[places], minlength=len(self.reps))

    def linked(self, tokens: np.ndarray, comp: object, percent: int) -> Iterator[object]:
        """One linked member of each other component."""
        common = self.common(tokens)
        seen = {comp}
        for k in np.flatnonzero(100 * common >= percent * (len(tokens) + self.sizes - common)):
            if self.comps[k] not in seen:
                seen.add(self.comps[k])
                yield self.reps[k]


def opened(documents: DataFrame, pairs: DataFrame, members: DataFrame, words: int, percent: int, keep: Keep) -> DataFrame:
    """(u, v): a link of each class of pairs (c, gid) to each component that the group's members link it with.

    A group that many classes ask for is copied for every QUERY_DOCS of them, so no task has more at once.
    """
    kind = documents.schema["doc_id"].dataType
    edge = pa.schema([("u", to_arrow_type(kind)), ("v", to_arrow_type(kind))])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, group = None, [], None
        for batch in batches:
            found = []
            for gid, part, asks, rep, comp, a, b, text in zip(*(batch.column(x).to_pylist() for x in ("gid", "part", "asks", "rep", "comp", "a", "b")), batches_of(batch.column("text"))):
                if (gid, part) != now:
                    now, held, group = (gid, part), [], None
                own = shingles(text, words)
                if signatures(own) != (a, b):
                    continue
                if not asks:
                    held.append((rep, comp, own))
                elif held:
                    group = group or Group(held)
                    found += [(rep, other) for other in group.linked(own, comp, percent)]
            yield pa.RecordBatch.from_pydict({"u": [x[0] for x in found], "v": [x[1] for x in found]}, schema=edge)

    sizes = pairs.groupBy("gid").agg(F.ceil(F.count(F.lit(1)) / QUERY_DOCS).alias("parts"))
    queries = pairs.join(sizes, "gid").select("gid", F.pmod(F.xxhash64("c"), "parts").alias("part"), "c", F.lit(True).alias("asks"))
    own = sizes.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).join(members.select("gid", "c"), "gid")
    rows = queries.unionByName(own.select("gid", "part", "c", F.lit(False).alias("asks")))
    rows = keep(rows.join(members.select("c", "rep", "comp", "a", "b"), "c"))
    rows = texts_of(documents, rows).join(rows.hint("merge"), "rep")
    return rows.repartition("gid", "part").sortWithinPartitions("gid", "part", "asks").mapInArrow(compare, f"u {kind.simpleString()}, v {kind.simpleString()}")


def components(edges: DataFrame, keep: Keep = staged) -> DataFrame:
    """(node, root): every node of the edges (u, v) with the smallest node that it can reach.

    Alternates two joins until nothing changes: each node's larger neighbours are hung on its smallest one, then its
    smaller ones too. No node's neighbours are gathered in one place.
    """
    state_of = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())
    old = Temporary()
    now = old.staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before, state = None, state_of(now)
    while state != before:
        new = Temporary()
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = new.staged(small.union(down.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        before, state = state, state_of(now)
        old.release()
        old = new
    out = keep(now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root"))
    old.release()
    return out


def links(documents: DataFrame, classes: DataFrame, words: int, percent: int, keep: Keep) -> DataFrame:
    """(u, v): links between representatives that connect just what all links connect."""
    shared = keep(shared_of(classes))
    stars = keep(linked(documents, keep(star_pairs(shared, percent)), words, percent))
    members = keep(grouped(shared, stars, components(stars.select("u", "v"), keep)))
    pairs = keep(qualifying(members, keep, percent))
    return stars.select("u", "v").unionByName(keep(opened(documents, pairs, members, words, percent, keep)))


def ngram_jaccard(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """For each row of documents (doc_id, text): n_shingles and component_id, the smallest doc_id that links reach.

    A null or empty text has no set, is linked with nothing and is its own component. Rows of the same doc_id are one
    document: it has the links of each of its texts, and they share a component. A null doc_id is never a component_id;
    its row has the smallest doc_id among the others that hold the same set, else null. Other columns are ignored.
    """
    documents = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    temporary = Temporary()
    docs = temporary.staged(sets_of(documents, frequent(documents, words), words, percent))
    classes = temporary.staged(classes_of(docs))
    edges = links(documents, classes, words, percent, temporary.staged)
    placed = docs.select("doc_id", "a", "b", "n").join(classes.select("a", "b", "n", "rep"), ["a", "b", "n"], "left")
    several = placed.where("rep IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("rep").alias("u"), F.max("rep").alias("v")).where("u <> v")
    joined = placed.join(several.select("doc_id", "u"), "doc_id").select("u", F.col("rep").alias("v"))
    roots = components(edges.union(joined), temporary.staged)
    out = placed.join(roots, F.col("rep") == F.col("node"), "left")
    return temporary.last(out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep", "doc_id").alias("component_id")))


def distinct_documents(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of documents for each component, that of its smallest doc_id, with its columns.

    Rows with a null doc_id can't be named as copies and stay, as do all documents without words.
    """
    found = ngram_jaccard(documents, words, percent).where("doc_id IS NOT NULL")
    copies = found.where("doc_id <> component_id").select("doc_id").distinct()
    repeated = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    # Documents that share no bucket with a copy or a repeated doc_id don't meet the others.
    concerned = buckets_of(copies.unionByName(repeated.select("doc_id")), "doc_id")
    df = packed(documents, bucket_of("doc_id").alias("__bucket"))
    near = df.join(concerned, "__bucket", "left_semi").where("doc_id IS NOT NULL").join(copies.hint("merge"), "doc_id", "left_anti")
    if repeated.limit(1).count():  # only then are rows of the same doc_id copies to drop
        near = near.dropDuplicates(["doc_id"])
    apart = df.join(concerned, "__bucket", "left_anti").unionByName(df.where("doc_id IS NULL").join(concerned, "__bucket", "left_semi"))
    return unpacked(near.unionByName(apart), documents)
