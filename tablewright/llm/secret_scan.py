"""Secret scans: spans that look like secrets, with how widely each candidate value is copied in the whole corpus.

Every candidate value is hashed, and the distinct repositories and owners that hold a hash are counted over all
documents. A value that several owners hold is an example that was copied; a value that few hold looks live. The three
base kinds are always reported; long opaque strings, which are often only identifiers, are added when they look live.

Only hashes are shuffled. Pairs of hash and owner are made distinct on the map side first, so a value that a third of
all documents holds comes as a row for each task and owner.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Temporary, let, text_or_empty

# The kinds in the order in which spans of the same start are listed, their patterns, the group whose
# length counts, and the least length.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
OPAQUE = r"[A-Za-z0-9_-]{20,}"
KINDS = (("assign", ASSIGN, 2, 12), ("access", ACCESS, 0, 18), ("hex", HEX, 0, 16), ("opaque", OPAQUE, 0, 20))
CHUNK = 256
SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


def running(values: Column, of: Callable[[Column, Column], Column]) -> Column:
    """For each place of an array of ints what of() gives for all values up to it.

    Within chunks of CHUNK values first, then over the chunks' last ones, so that the work grows with the array's length
    times CHUNK, not with its square.
    """

    def scan(array: Column) -> Column:
        following = lambda acc, x: F.array_append(acc, F.when(F.size(acc) == 0, x).otherwise(of(F.element_at(acc, -1), x)))
        return F.aggregate(array, F.array().cast("array<int>"), following)

    def joined(chunks: Column) -> Column:
        ends = scan(F.transform(chunks, lambda c: F.element_at(c, -1)))
        return let(ends, lambda e: F.flatten(F.transform(chunks, lambda c, j: F.when(j == 0, c).otherwise(F.transform(c, lambda x: of(F.get(e, j - 1), x))))))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")), lambda j: scan(F.slice(values, j * CHUNK + 1, CHUNK)))
    return F.when(F.size(values) > 0, let(chunks, joined)).otherwise(values)


def spans_of(text: Column, rank: int, pattern: str, group: int, least: int) -> Column:
    """Matches, leftmost and non-overlapping: start and end in code points, and the group's value; those shorter than least are left out.

    What lies between matches is what splitting by the pattern leaves, so each end is the sum of the lengths before.
    """

    def spans(pieces: Column, matches: Column, values: Column) -> Column:
        ends = let(F.transform(matches, lambda m, i: F.length(pieces[i]) + F.length(m)), lambda n: running(n, lambda x, y: x + y))
        span = lambda e: lambda m, i: F.struct((F.get(e, i) - F.length(m)).alias("start"), F.lit(rank).alias("rank"), F.get(e, i).alias("end"), values[i].alias("value"))
        return F.filter(let(ends, lambda e: F.transform(matches, span(e))), lambda x: F.length(x["value"]) >= least)

    # limit -1 keeps empty pieces at the end.
    found = let(
        F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v")),
        lambda x: spans(x["p"], x["m"], x["v"]),
    )
    return F.when(F.rlike(text, F.lit(pattern)), found.cast(SPAN)).otherwise(F.array().cast(SPAN))


def apart_from(spans: Column, base: Column, own: int = len(KINDS) - 1) -> Column:
    """Those of spans (of rank own or above, base's are below) that touch none of base.

    All are put in order of their starts. A span touches one of base if one that begins no later ends behind its start,
    or the next one that begins later does so before its end.
    """
    own = F.lit(own)
    far = F.lit(2**31 - 1)
    ends = lambda s: let(F.transform(s, lambda x: F.when(x["rank"] < own, x["end"]).otherwise(0)), lambda x: running(x, F.greatest))
    # From the back, and turned round again.
    starts = lambda s: F.reverse(let(F.reverse(F.transform(s, lambda x: F.when(x["rank"] < own, x["start"]).otherwise(far))), lambda x: running(x, F.least)))
    free = lambda s, e, b: F.filter(s, lambda x, i: (x["rank"] >= own) & (F.get(e, i) <= x["start"]) & (F.get(b, i) >= x["end"]))
    merged = let(F.sort_array(F.concat(spans, base)), lambda s: let(ends(s), lambda e: let(starts(s), lambda b: free(s, e, b))))
    return F.when((F.size(spans) > 0) & (F.size(base) > 0), merged).otherwise(spans)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start and then by kind."""
    names = F.array(*[F.lit(k) for k, *_ in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(":", names[x["rank"]], x["start"], x["end"])), ",")


def secret_scan(documents: DataFrame, repository: str | None = None, owner: str = "source", live_owners: int = 2, live_repositories: int = 5) -> DataFrame:
    """For each row of documents: counts and spans of secrets, n_live and n_example of its values.

    A value looks live if at most live_owners owners and live_repositories repositories hold it; otherwise it is an
    example. Without a column for it, documents of the same text are one repository, so that copies of a page don't make
    an example of what one owner holds. A null repository or owner counts as one more of its own. Opaque strings need a
    letter and a digit, touch no base span, and are listed only if live. A null or empty text has none. Repeated rows
    give repeated results. Other columns are ignored.
    """
    df = documents.select("doc_id", F.col(owner).cast("string").alias("__owner"), text_or_empty(F.col("text").cast("string")).alias("__text"), *([F.col(repository).cast("string").alias("__repository")] if repository else []))
    found = [spans_of(F.col("__text"), k, *rest) for k, (_, *rest) in enumerate(KINDS)]
    mixed = F.filter(found[-1], lambda x: F.rlike(x["value"], F.lit("[0-9]")) & F.rlike(x["value"], F.lit("[A-Za-z]")))
    place = F.col("__repository") if repository else F.md5("__text").alias("__repository")
    df = df.select("doc_id", place, "__owner", *[c.alias(f"__{k}") for c, (k, *_) in zip(found[:-1], KINDS)], mixed.alias("__mixed"))
    df = df.withColumn("__base", F.concat("__assign", "__access", "__hex"))
    df = df.withColumn("__more", apart_from(F.col("__mixed"), F.col("__base")))
    temporary = Temporary()
    # A few spans a row: counts and verdicts need them, and the texts no more.
    df = temporary.staged(df.drop("__mixed").withColumn("__rid", F.monotonically_increasing_id()))

    # Null owners and repositories become values of their own; distinct pairs first, then counts.
    held = df.select("__rid", F.coalesce("__owner", F.lit("")).alias("o"), F.coalesce("__repository", F.lit("")).alias("r"), F.explode(F.concat("__base", "__more")).alias("span")).withColumn("hash", F.sha2("span.value", 256))
    counts = lambda what: held.select("hash", what).distinct().groupBy("hash").agg(F.count(F.lit(1)).alias(what))
    live = counts("o").join(counts("r"), "hash").where((F.col("o") <= live_owners) & (F.col("r") <= live_repositories)).select("hash")
    # Spans of one row alone come together again.
    owned = held.select("__rid", "hash", "span").join(live, "hash").groupBy("__rid").agg(F.count(F.lit(1)).alias("n_live"), F.collect_list(F.when(F.col("span.rank") == len(KINDS) - 1, F.col("span"))).alias("__owned"))
    df = df.join(owned, "__rid", "left").fillna(0, ["n_live"])
    return temporary.last(df.select(
        "doc_id",
        *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k, *_ in KINDS[:3]],
        F.sha2(listed(F.col("__base")), 256).alias("base_sha256"),
        listed(F.concat("__base", F.coalesce("__owned", F.array().cast(SPAN)))).alias("spans"),
        "n_live",
        ((F.size("__base") + F.size("__more")).cast("long") - F.col("n_live")).alias("n_example"),
    ))
