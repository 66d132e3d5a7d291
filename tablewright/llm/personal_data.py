"""Personal data by bootstrapped contextual extraction: checked forms are seeds, whose contexts find what has no such form.

1. Seeds are the spans of four base kinds, each with a check of its own (Luhn, parts up to 255, numbers of digits).
2. Every seed and every loose candidate (numbers, addresses, codes that touch no base span) induces lexical patterns: the
   word before it, the two words before it, the word after it, and the words on both sides.
3. Patterns and distinct values are the two sides of a graph. In each round a pattern's confidence in a kind is the sum of
   its values' scores over their number plus one; a candidate's score is the highest confidence of its patterns. A pattern
   counts from MIN_TRUSTED values with a score and a confidence of MIN_CONFIDENCE on, so that in later rounds values that
   were found induce patterns too.
4. Candidates with a score after ROUNDS rounds are spans of their best kind, wherever they occur.

Spans are found within a row. The graph is joins and sums over hashes: a context or a value that a third of all documents
hold is one edge for each partner, made distinct on the map side, and what it is joined with has one row for it and kind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Temporary, let, text_or_empty
from .secret_scan import apart_from, running

# The base kinds in the order in which spans are listed, with their patterns. Where the plain pattern would
# search a long run again from each of its characters, the match starts at the run's begin or at the end of the last one.
LOCAL = r"A-Za-z0-9._%+-"
BASE = (
    ("email", rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
EMAIL, IP, CARD, PHONE = range(len(BASE))
#: Each part at most 255, with any number of zeros before it.
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})(?:\.|$)){4}$"
#: Loose forms, and the kind of which each can be, by its number of digits.
FORMS = (
    ("number", r"[0-9][0-9\x20().-]{5,}[0-9]"),
    ("address", rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9.-]+"),
    ("code", r"[A-Z]{1,4}-?[0-9]{6,}"),
)
FIRST_FORM = len(BASE)
NUMBER, ADDRESS, CODE = range(FIRST_FORM, FIRST_FORM + len(FORMS))
#: Words of a context: ASCII letters and all that is not ASCII.
WORD = r"[^\x00-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points on each side of a span that its context is taken from.
REACH = 32
ROUNDS = 3
MIN_TRUSTED = 5
MIN_CONFIDENCE = 0.8
SPAN = "array<struct<start:int,rank:int,end:int,value:string,before:array<string>,after:string>>"


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a short string of digits has the right check digit."""
    n = F.length(digits)
    at = lambda i: F.ascii(F.substring(digits, i, 1)) - 48
    twice = lambda d: 2 * d - F.when(d > 4, 9).otherwise(0)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + F.when((n - i) % 2 == 1, twice(at(i))).otherwise(at(i))) % 10 == 0


def valid(rank: int) -> Callable[[Column], Column]:
    """The check of a span's value."""
    within = lambda low, high: lambda v: let(digits_of(v), lambda d: F.length(d).between(low, high))
    if rank == IP:
        return lambda v: F.rlike(v, F.lit(IP_PARTS))
    if rank == CARD:
        return lambda v: let(digits_of(v), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    return {PHONE: within(9, 15), NUMBER: within(7, 19)}.get(rank, lambda v: F.lit(True))


def mentions_of(text: Column, rank: int, pattern: str) -> Column:
    """Matches that are valid, leftmost and non-overlapping, in code points, with the two words before and the word after, as far as REACH and the next match."""

    def spans(pieces: Column, matches: Column) -> Column:
        ends = let(F.transform(matches, lambda m, i: F.length(pieces[i]) + F.length(m)), lambda n: running(n, lambda x, y: x + y))
        words = lambda x: F.regexp_extract_all(F.translate(x, UPPER, LOWER), F.lit(WORD), F.lit(0))
        left = lambda i: F.slice(F.concat(F.array(F.lit(""), F.lit("")), words(F.right(pieces[i], F.lit(REACH)))), -2, 2)
        right = lambda i: F.coalesce(F.get(words(F.left(pieces[i + 1], F.lit(REACH))), F.lit(0)), F.lit(""))
        span = lambda e: lambda m, i: F.struct((F.get(e, i) - F.length(m)).alias("start"), F.lit(rank).alias("rank"), F.get(e, i).alias("end"), m.alias("value"), left(i).alias("before"), right(i).alias("after"))
        return F.filter(let(ends, lambda e: F.transform(matches, span(e))), lambda x: valid(rank)(x["value"]))

    # limit -1 keeps empty pieces at the end.
    found = let(F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")), lambda x: spans(x["p"], x["m"]))
    return F.when(F.rlike(text, F.lit(pattern)), found.cast(SPAN)).otherwise(F.array().cast(SPAN))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined, of spans in order."""
    names = F.array(*[F.lit(k) for k, _ in BASE], *[F.lit(f"context_{k}") for k, _ in BASE])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["rank"]], x["start"], x["end"])), ",")


def normal(span: Column) -> Column:
    """The value that two spans share however they are written: digits alone, or lower case."""
    return F.when(span["rank"].isin(CARD, PHONE, NUMBER), digits_of(span["value"])).otherwise(F.lower(span["value"]))


def patterns_of(span: Column) -> Column:
    """Hashes of a span's lexical patterns; those with a missing word are left out."""
    second, first, after = span["before"][0], span["before"][1], span["after"]
    made = lambda k, *words: F.when(F.concat(*[F.when(w == "", None).otherwise(w) for w in words]).isNotNull(), F.xxhash64(F.lit(k), *words))
    return F.array_compact(F.array(made(1, first), made(2, second, first), made(3, after), made(4, first, after)))


def kinds_of(span: Column) -> Column:
    """The kinds of which a loose candidate can be."""
    n = F.length(digits_of(span["value"]))
    some = lambda kind, condition: F.when(condition, F.lit(kind))
    number, code = span["rank"] == NUMBER, span["rank"] == CODE
    return F.array_compact(F.array(some(EMAIL, span["rank"] == ADDRESS), some(CARD, (number & (n >= 12)) | code), some(PHONE, number & (n <= 15))))


def discovered(mentions: DataFrame, temporary: Temporary, rounds: int, min_trusted: int, min_confidence: float) -> DataFrame:
    """(value, kind): of each candidate that the graph of mentions (value, span) trusts, its best kind."""
    edges = mentions.select("value", F.explode(patterns_of(F.col("span"))).alias("pattern")).distinct()
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_trusted)
    edges = temporary.staged(edges.join(sizes, "pattern"))
    seeds = mentions.where(F.col("span.rank") < FIRST_FORM).select("value", F.col("span.rank").alias("kind"), F.lit(1.0).alias("score")).distinct()
    seeds = temporary.staged(seeds)
    possible = mentions.where(F.col("span.rank") >= FIRST_FORM).select("value", F.explode(kinds_of(F.col("span"))).alias("kind")).distinct()
    possible = temporary.staged(possible.join(seeds.select("value", "kind"), ["value", "kind"], "left_anti"))
    found = seeds
    for _ in range(rounds):
        held = edges.join(found, "value").groupBy("pattern", "kind").agg(F.max("n").alias("n"), F.sum("score").alias("sum"), F.count(F.lit(1)).alias("trusted"))
        trusted = held.where(F.col("trusted") >= min_trusted).select("pattern", "kind", F.round(F.col("sum") / (F.col("n") + 1), 9).alias("confidence")).where(F.col("confidence") >= min_confidence)
        reached = edges.join(trusted, "pattern").groupBy("value", "kind").agg(F.max("confidence").alias("score"))
        found = temporary.staged(seeds.unionByName(reached.join(possible, ["value", "kind"]).select(*seeds.columns)))
    own = found.join(possible, ["value", "kind"], "left_semi")
    return own.groupBy("value").agg(F.max(F.struct("score", (-F.col("kind")).alias("__k"))).alias("best")).select("value", (-F.col("best.__k")).alias("kind"))


def personal_data(documents: DataFrame, rounds: int = ROUNDS, min_trusted: int = MIN_TRUSTED, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """For each row of documents (doc_id, text): n_email, n_ip, n_card, n_phone, n_context, base_sha256 and spans.

    Base spans are always listed. Those that contexts add are called context_ and the kind, follow the base kinds in the
    same order, and touch no base span. A null or empty text has none. Documents that repeat add no new values, so they
    don't strengthen a pattern; repeated rows give repeated results. Other columns are ignored.
    """
    temporary = Temporary()
    df = documents.select("doc_id", text_or_empty(F.col("text").cast("string")).alias("__text"))
    df = df.select("doc_id", *[mentions_of(F.col("__text"), k, p).alias(f"__{k}") for k, (_, p) in enumerate((*BASE, *FORMS))])
    base = F.concat(*[F.col(f"__{k}") for k in range(len(BASE))])
    loose = F.concat(*[F.col(f"__{FIRST_FORM + k}") for k in range(len(FORMS))])
    df = df.select("doc_id", *[F.size(f"__{k}").cast("long").alias(f"n_{name}") for k, (name, _) in enumerate(BASE)], base.alias("__base"), loose.alias("__loose"))
    df = df.withColumn("__more", apart_from(F.col("__loose"), F.col("__base"), FIRST_FORM)).drop("__loose")
    # A few spans a row; the texts are needed no more.
    df = temporary.staged(df.withColumn("__rid", F.monotonically_increasing_id()))

    mentions = df.select("__rid", F.explode(F.concat("__base", "__more")).alias("span")).withColumn("value", F.xxhash64(normal(F.col("span"))))
    found = discovered(mentions.select("value", "span"), temporary, rounds, min_trusted, min_confidence)
    own = mentions.where(F.col("span.rank") >= FIRST_FORM).join(found, "value")
    rank = (F.col("kind") + len(BASE)).cast("int").alias("rank")
    # Spans of one row alone come together again.
    own = own.groupBy("__rid").agg(F.collect_list(F.struct(rank, F.col("span.start").alias("start"), F.col("span.end").alias("end"))).alias("__own"))
    df = df.join(own, "__rid", "left")
    plain = F.transform("__base", lambda x: F.struct(x["rank"].alias("rank"), x["start"].alias("start"), x["end"].alias("end")))
    added = F.coalesce("__own", F.array().cast("array<struct<rank:int,start:int,end:int>>"))
    return temporary.last(df.select(
        "doc_id",
        *[f"n_{name}" for name, _ in BASE],
        F.size(added).cast("long").alias("n_context"),
        F.sha2(listed(plain), 256).alias("base_sha256"),
        listed(F.concat(plain, F.sort_array(added))).alias("spans"),
    ))
