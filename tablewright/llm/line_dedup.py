"""Line dedup by a deletion-neighbourhood join: of lines that are equal or one edit apart, the earliest stays.

A line is compared in its plain form: lower case, with runs of white space as one space. A line goes if an earlier one
(by doc_id, then line number) has the same plain form, or one that a single inserted, dropped or replaced character
turns into it. Whether the earlier line goes itself doesn't matter.

1. Plain forms are grouped by a 128-bit hash, with the first place of each; a form's later places go.
2. Of two forms one edit apart, the first or the last half of the shorter is unchanged; only forms that share such a
   half with another are carried on, with their text.
3. The same again in more parts tells in which part of a form the edit can be, and again in that part while it is long,
   so that a line of any length has few characters left. Each character of that part is deleted in
   turn, which gives the variants, as hashed keys with the deleted place. Equal variants with the same place differ by a
   replaced character, and the earliest form of such a key stands for all others, so a group of n forms gives n rows,
   never its pairs. A variant that equals a whole form differs from it by an inserted character.
4. That a form and the earliest one found are one edit apart is verified on the forms themselves, at the place found.

Forms that many lines share are reduced on the map side; joins on hot forms are Spark's to split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Temporary, bucket_of, buckets_of, let, packed, unpacked

INTEGERS = ("tinyint", "smallint", "int", "bigint")
LINES_A_DOC = 2**31
SEGMENTS = 12
#: Characters of the longest part whose characters are deleted in turn; longer parts are cut further.
FEW = 64


def plain(line: Column) -> Column:
    # Most lines have single spaces only, and a search for a fixed string costs a tenth of a pattern.
    spaced = F.contains(line, F.lit("  "))
    for c in "\t\x0b\x0c\r":
        spaced = spaced | F.contains(line, F.lit(c))
    one_space = F.when(spaced, F.regexp_replace(line, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")).otherwise(line)
    return F.lower(F.trim(one_space))


def place_at(documents: DataFrame, line_no: Column) -> Column:
    """A place, ordered by doc_id, then line: for whole numbers one number, whose least value is found without sorting."""
    if documents.schema["doc_id"].dataType.simpleString() in INTEGERS:
        at = F.col("doc_id").cast("decimal(20,0)") * F.lit(LINES_A_DOC).cast("decimal(11,0)") + line_no
        return at.cast("decimal(38,0)")
    return F.struct(F.col("doc_id").alias("id"), line_no.cast("int").alias("k"))


def place_of(documents: DataFrame, at: Column) -> tuple[Column, Column]:
    """id and k: doc_id and line number of a place."""
    kind = documents.schema["doc_id"].dataType
    if kind.simpleString() not in INTEGERS:
        return at["id"].alias("id"), at["k"].alias("k")
    size = F.lit(LINES_A_DOC).cast("decimal(38,0)")
    return F.floor((at - F.pmod(at, size)) / size).cast(kind).alias("id"), F.pmod(at, size).cast("int").alias("k")


def lines_of(documents: DataFrame) -> DataFrame:
    """(at, a, b, plain): place, 128-bit hash and plain form of each line with something in it."""
    lines = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.select(place_at(documents, F.col("line_no")).alias("at"), plain(F.col("line")).alias("plain"))
    return lines.select("at", F.xxhash64("plain").alias("a"), F.xxhash64(F.lit(7), F.col("plain")).alias("b"), "plain").where("plain <> ''")


def halves_of(text: Column) -> Column:
    """Keys of a form's first and last half, as the shorter one of a pair and as the longer, whose partner has a character less."""
    n = F.length(text)
    half = lambda m: F.floor(m / 2).cast("int")
    head = lambda m: F.xxhash64(F.lit(0), m, F.substring(text, F.lit(1), m))
    tail = lambda m: F.xxhash64(F.lit(1), m, F.substring(text, n - m + 1, m))
    return F.array_distinct(F.array(head(half(n)), head(half(n - 1)), tail(n - half(n)), tail(n - 1 - half(n - 1))))


def candidates(lines: DataFrame, forms: DataFrame, documents: DataFrame, temporary: Temporary) -> DataFrame:
    """(a, b, first, plain) of the forms that share a half with another one."""
    keys = lines.select("a", F.explode("halves").alias("key"))
    several = keys.groupBy("key").agg(F.min("a").alias("x"), F.max("a").alias("y")).where("x <> y").select("key")
    near = keys.join(several, "key", "left_semi").select("a").distinct()
    wanted = near.join(forms, "a").select(F.struct("a", "b", "first").alias("form"), *place_of(documents, F.col("first")))
    # At most all lines of one document come together.
    wanted = temporary.staged(wanted.groupBy("id").agg(F.collect_list(F.struct("k", "form")).alias("forms")))
    # Keeps most documents out of the shuffle while candidates are few.
    some = documents.select(F.col("doc_id").alias("id"), "text").withColumn("__bucket", bucket_of("id")).join(buckets_of(wanted, "id"), "__bucket", "left_semi")
    own = let(F.split("text", "\n"), lambda lines: F.transform("forms", lambda x: F.struct(x["form"].alias("form"), F.get(lines, x["k"]).alias("line"))))
    found = some.join(wanted.hint("merge"), "id").select(F.explode(own).alias("x")).select("x.form.*", plain(F.col("x.line")).alias("plain"))
    # A doc_id may have other texts too; repeated rows give a form twice.
    return temporary.staged(found.where((F.xxhash64("plain") == F.col("a")) & (F.xxhash64(F.lit(7), F.col("plain")) == F.col("b"))).dropDuplicates(["a", "b"]))


def superseded(chosen: DataFrame, temporary: Temporary) -> DataFrame:
    """(a, b) of the forms of chosen that are one edit from one that is earlier. A form's first place stands for it.

    As with halves, but in SEGMENTS parts: of two forms one edit apart, all but one part of the shorter is unchanged.
    Where a form shares all but one part with another, the characters of that part are deleted in turn; a part of more
    than FEW characters is cut into SEGMENTS again before, as often as it takes. So a line of n characters is read about
    log(n) times, not n times.
    """
    n = F.length("plain")
    start = lambda m, s: F.floor(s * m / SEGMENTS).cast("int")
    rest_of = lambda m, s: F.xxhash64(F.lit(2), m, s, F.substring("plain", F.lit(1), start(m, s)), F.substring("plain", n - m + start(m, s + 1) + 1, n))
    parts = F.transform(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)), lambda s: F.array(*[F.struct(m.alias("m"), s.alias("s"), rest_of(m, s).alias("key")) for m in (n, n - 1)]))
    keys = chosen.select("first", F.explode(F.flatten(parts)).alias("p")).select("first", "p.*")
    texts_of = chosen.select("first", "plain")

    def shared(keys: DataFrame, *at: str) -> DataFrame:
        several = keys.groupBy("key").agg(F.min("first").alias("x"), F.max("first").alias("y")).where("x <> y").select("key")
        return keys.join(several, "key", "left_semi").select("first", *at).distinct().join(texts_of, "first")

    # lo and hi: where the part begins and ends in the shorter form of a pair, whose length is m.
    m, lo, hi = F.col("m"), F.col("lo"), F.col("hi")
    matched = shared(keys, "m", "s").select("first", "m", start(m, F.col("s")).alias("lo"), start(m, F.col("s") + 1).alias("hi"), n.alias("n"), "plain")
    matched = temporary.staged(matched)
    while not matched.where(hi - lo > FEW).isEmpty():
        cut = lambda s: lo + start(hi - lo, s)
        outside = lambda x, y: F.xxhash64(F.lit(3), m, x, y, F.substring("plain", F.lit(1), x), F.substring("plain", F.col("n") - m + y + 1, F.col("n")))
        finer = F.transform(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)), lambda s: F.struct(cut(s).alias("lo"), cut(s + 1).alias("hi"), outside(cut(s), cut(s + 1)).alias("key")))
        keys = matched.where(hi - lo > FEW).select("first", "m", F.explode(finer).alias("p")).select("first", "m", "p.*")
        found = shared(keys, "m", "lo", "hi").select("first", "m", "lo", "hi", n.alias("n"), "plain")
        matched = temporary.staged(matched.where(hi - lo <= FEW).unionByName(found))

    without = lambda i: F.concat(F.substring("plain", F.lit(1), i - 1), F.substring("plain", i + 1, F.col("n")))
    last = hi + F.col("n") - m
    places = F.when(last > lo, F.sequence(lo + 1, last))
    deleted = F.transform(places, lambda i: F.struct(i.alias("i"), F.xxhash64(without(i)).alias("v")))
    variants = temporary.staged(matched.select("first", "n", "m", F.explode(deleted).alias("d")).select("first", "n", "m", "d.i", "d.v").distinct())
    whole = matched.where("m = n").select("first", (F.col("n") + 1).alias("n"), F.xxhash64("plain").alias("v")).distinct()

    # Replaced: the same variant with the same place; the earliest form of the key stands for it.
    same = variants.where("m = n").select("first", "v", "n", "i")
    replaced = same.groupBy("v", "n", "i").agg(F.min("first").alias("other"), F.max("first").alias("last")).where("other < last").drop("last")
    by_replaced = same.join(replaced, ["v", "n", "i"]).where("first > other").select("first", "other", F.col("first").alias("long"), "i", F.lit(1).alias("over"))
    # Inserted: a whole form that is the variant of a longer one, by any place of a run of one character. n is the longer one's length on both sides.
    longer = variants.where("m < n").select("first", "v", "n", "i").join(whole.select("v", "n", F.col("first").alias("short")), ["v", "n"])
    longer = longer.groupBy("first", "short").agg(F.min("i").alias("i"))
    by_inserted = longer.select(F.greatest("first", "short").alias("first"), F.least("first", "short").alias("other"), F.col("first").alias("long"), "i", F.lit(0).alias("over"))
    pairs = by_replaced.union(by_inserted).where("first <> other").distinct()
    texts = chosen.select("first", "a", "b", "plain")
    both = pairs.join(texts, "first").join(texts.select(F.col("first").alias("other"), F.col("plain").alias("against")), "other")
    # Without the longer form's place i (and, of a replaced character, the other's) they are equal: one look at each, where an edit distance of long lines would take the square of their length.
    long = F.when(F.col("long") == F.col("first"), F.col("plain")).otherwise(F.col("against"))
    short = F.when(F.col("long") == F.col("first"), F.col("against")).otherwise(F.col("plain"))
    i, over = F.col("i"), F.col("over")
    tail = lambda text, at: F.substring(text, at, F.length(text))
    edit = (F.substring(long, F.lit(1), i - 1) == F.substring(short, F.lit(1), i - 1)) & (tail(long, i + 1) == tail(short, i + over)) & (F.length(long) == F.length(short) + 1 - over)
    return temporary.staged(both.where(edit).select("a", "b").distinct())


def dropped_lines(documents: DataFrame) -> DataFrame:
    """(__id, __exact, __near): of each doc_id with lines to drop, the numbers of those equal and near to an earlier one."""
    temporary = Temporary()
    lines = temporary.staged(lines_of(documents).select("at", "a", "b", halves_of(F.col("plain")).alias("halves")))
    forms = temporary.staged(lines.groupBy("a", "b").agg(F.min("at").alias("first"), F.max("at").alias("last")))
    near = superseded(candidates(lines, forms, documents, temporary), temporary).withColumn("near", F.lit(True))
    # Only forms that have something to drop meet the lines again.
    marked = forms.join(near, ["a", "b"], "left").where("near OR first < last").select("a", "b", "first", F.coalesce("near", F.lit(False)).alias("near"))
    hit = lines.select("at", "a", "b").join(marked, ["a", "b"]).where("near OR at > first")
    again = (F.col("at") > F.col("first")).alias("again")
    return temporary.last(hit.select(*place_of(documents, F.col("at")), again).groupBy(F.col("id").alias("__id")).agg(
        F.array_sort(F.collect_set(F.when(F.col("again"), F.col("k")))).alias("__exact"),
        F.array_sort(F.collect_set(F.when(~F.col("again"), F.col("k")))).alias("__near"),
    ))


def with_kept_text(df: DataFrame) -> DataFrame:
    """df (doc_id, text, ...) with __exact and __near (numbers of dropped lines) and __kept (the text of the others; null if it was)."""
    none = F.array().cast("array<int>")
    dropped = dropped_lines(df.select("doc_id", "text"))
    # Documents that share no bucket with one that loses lines don't meet the list of them.
    concerned = buckets_of(dropped, "__id")
    df = df.withColumn("__bucket", bucket_of("doc_id"))
    apart = df.join(concerned, "__bucket", "left_anti").withColumns({c: F.lit(None).cast("array<int>") for c in ("__exact", "__near")})
    # Merged at every size: what is dropped grows with the corpus, so a broadcast would only ever serve small ones.
    near = df.join(concerned, "__bucket", "left_semi").join(dropped.hint("merge"), F.col("doc_id") == F.col("__id"), "left").drop("__id")
    df = near.unionByName(apart).drop("__bucket").withColumns({c: F.coalesce(c, none) for c in ("__exact", "__near")})
    gone = F.array_union("__exact", "__near")
    # The numbers that stay are found by one pass over each list.
    stay = let(F.split("text", "\n"), lambda lines: F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda k: F.get(lines, k)))
    return df.withColumn("__kept", F.when(F.size(gone) == 0, F.col("text")).otherwise(F.array_join(stay, "\n")))


def line_dedup(documents: DataFrame) -> DataFrame:
    """For each row of documents (doc_id, text): n_lines, n_exact and n_near (lines dropped), n_chars_kept and kept_sha256.

    Lines that are empty in plain form always stay; lines of any other length are compared alike. A null text has no
    lines and its kept text is empty. A row with a null doc_id has no place, so it neither drops nor loses lines. Rows of
    the same doc_id are at the same place: lines of the same number don't drop each other, so repeated rows keep the same
    lines. doc_id may be of any type that has an order. Other columns are ignored.
    """
    df = with_kept_text(documents.select("doc_id", F.col("text").cast("string").alias("text")))
    kept = F.coalesce("__kept", F.lit(""))
    return df.select(
        "doc_id",
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.size("__exact").cast("long").alias("n_exact"),
        F.size("__near").cast("long").alias("n_near"),
        F.length(kept).cast("long").alias("n_chars_kept"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


def deduplicated(documents: DataFrame) -> DataFrame:
    """documents with their remaining lines as text, and without those of which no word remains though they had some."""
    wordy = lambda c: F.coalesce(F.rlike(F.col(c), F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    # The row number keeps the filter above the texts, which it would otherwise put together twice.
    df = with_kept_text(packed(documents)).withColumn("__row", F.monotonically_increasing_id())
    return unpacked(df.where((F.col("__row") >= 0) & (wordy("__kept") | ~wordy("text"))), documents, text=F.col("__kept"))
