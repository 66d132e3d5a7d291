"""Quality rules: fixed limits on a text, then the distance of its histograms from those of its language.

A document passes when its fixed limits hold and, if it is long enough to be judged, when neither its histogram of
character classes nor its histogram of common words is further from the language's than a limit. Distances are
Jensen-Shannon distances, the square root of the divergence in bits: 0 for the same histogram, 1 for disjoint ones.

The common words of a language are the most frequent ones of all its documents, counted in a first pass; its histograms
are sums over all its documents that pass the fixed limits. Both are a few rows for each language, summed on the map
side, so that one source or language with most of the rows doesn't meet in one task. Everything about one text is
computed within its row, so the texts are read twice and never shuffled. References that come from another corpus can be
given instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Temporary, let, space_words, text_or_empty

#: Lower case and white space together, then what each pattern takes away from what earlier ones left.
FLOWING = r"[\p{Ll}\x20\x09-\x0D]+"
OTHERS = (("upper", r"\p{Lu}+"), ("digit", r"\p{Nd}+"), ("symbol", r"[#*$%&|<>]+"), ("punct", r"\p{P}+"))
CLASSES = ("space", "lower", *(name for name, _ in OTHERS), "other")
WINDOW = 5
#: Common words of a language.
N_COMMON = 24


def with_classes(df: DataFrame) -> DataFrame:
    """Adds __classes: the number of code points of __text in each of CLASSES. White space is what the words leave."""
    df = df.withColumn("__left0", F.regexp_replace("__text", FLOWING, ""))
    for k, (_, pattern) in enumerate(OTHERS):
        df = df.withColumn(f"__left{k + 1}", F.regexp_replace(f"__left{k}", pattern, ""))
    df = df.withColumn("__space", F.length("__text") - F.length(F.array_join("__words", "")))
    left = [F.length(f"__left{k}") for k in range(len(OTHERS) + 1)]
    counts = [F.col("__space"), F.length("__text") - F.col("__space") - left[0], *[a - b for a, b in zip(left, left[1:])], left[-1]]
    return df.withColumn("__classes", F.array(*[c.cast("long") for c in counts])).drop("__space", *[f"__left{k}" for k in range(len(OTHERS) + 1)])


def repeated_words(words: Column) -> Column:
    """How many words are in a window of five that the text holds at least twice.

    Windows are compared by a 64-bit hash within one text; only texts with a repeated window sort theirs.
    """

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - WINDOW)
        return F.when(F.size(w) > WINDOW, F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])))

    def repeated(s: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        new = F.transform(p, lambda x, k: F.coalesce(F.least(F.get(p, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)

    def of_windows(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(pairs, lambda s: let(repeated(s), covered)))

    return F.coalesce(let(words, lambda w: let(windows(w), of_windows)), F.lit(0).cast("long"))


def text_counts(documents: DataFrame, keep: list[str]) -> DataFrame:
    """keep, and for each row __text, __words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, __classes."""
    df = documents.select(*keep, text_or_empty("text").alias("__text"))
    df = with_classes(df.withColumn("__words", space_words(F.col("__text"))))
    df = df.withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))))
    return df.select(
        *keep,
        "__text",
        "__words",
        "__classes",
        F.size("__words").cast("long").alias("n_words"),
        (F.length("__text") - F.col("__classes")[CLASSES.index("space")]).cast("long").alias("word_chars"),
        F.col("__classes")[CLASSES.index("symbol")].alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("__words")).alias("n_repeat_words"),
    )


def base_failed(min_words: int = 10, max_repeat_percent: int = 20) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def common_words(documents: DataFrame, n_common: int = N_COMMON) -> DataFrame:
    """(__lang, common): the n_common most frequent words of each language, ties by the word; from documents (__lang, text)."""
    words = documents.where("__lang IS NOT NULL").select("__lang", F.explode(space_words(text_or_empty("text"))).alias("word"))
    counts = words.groupBy("__lang", "word").agg(F.count(F.lit(1)).alias("n"))
    # Each task keeps its first n_common words of a language before they meet.
    ranked = counts.withColumn("k", F.row_number().over(Window.partitionBy("__lang").orderBy(F.desc("n"), "word"))).where(F.col("k") <= n_common)
    top = ranked.groupBy("__lang").agg(F.sort_array(F.collect_list(F.struct("k", "word"))).alias("__top"))
    return top.select("__lang", F.transform("__top", lambda x: x["word"]).alias("common"))


def common_counts(words: Column, common: Column) -> Column:
    """How often each of an array of common words is among words, then how many other words; null without common ones."""
    hits = let(common, lambda own: F.array_remove(F.transform(words, lambda w: F.array_position(own, w)), 0))
    counts = let(hits, lambda h: F.concat(F.transform(common, lambda _, k: F.size(h) - F.size(F.array_remove(h, (k + 1).cast("long")))), F.array(F.size(words) - F.size(h))))
    return F.when(common.isNotNull(), counts)


def language_references(counted: DataFrame, n_common: int = N_COMMON) -> DataFrame:
    """For each language __lang the sums of __word_counts (word_counts) and of __classes (class_counts)."""
    sums = counted.where(~base_failed() & F.col("__lang").isNotNull()).groupBy("__lang").agg(
        F.array(*[F.sum(F.get("__word_counts", F.lit(k))) for k in range(n_common + 1)]).alias("word_counts"),
        F.array(*[F.sum(F.col("__classes")[k]) for k in range(len(CLASSES))]).alias("class_counts"),
    )
    # A language with fewer words has fewer bins.
    return sums.withColumn("word_counts", F.filter("word_counts", lambda x: x.isNotNull()))


def distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two arrays of counts of the same length; null where either sums to 0."""
    total = "aggregate({0}, 0D, (a, x) -> a + x)"
    bits = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0D END"
    term = f"0.5D * ({bits.format('a.p', 'a.q')} + {bits.format('a.q', 'a.p')})"
    shares = f"zip_with(transform({p}, x -> x / {total.format(p)}), transform({q}, x -> x / {total.format(q)}), (p, q) -> struct(p, q))"
    sums = f"{total.format(p)} > 0 AND {total.format(q)} > 0"
    return F.expr(f"CASE WHEN {sums} THEN sqrt(greatest(0D, aggregate(transform({shares}, a -> {term}), 0D, (s, x) -> s + x))) END")


def quality_rules(documents: DataFrame, min_words: int = 60, min_chars: int = 200, max_word_distance: float = 0.45, max_class_distance: float = 0.28, references: DataFrame | None = None, n_common: int = N_COMMON) -> DataFrame:
    """For each row of documents (doc_id, text, lang): its counts, base_failed, the two distances and kept.

    A null or empty text has no words and fails. Texts of under min_words words have no word_distance, those of under
    min_chars code points no class_distance, and those of a null language, or of one of which no text passes the fixed
    limits, neither. A distance that is missing rejects nothing. Common words are the n_common most frequent ones of each
    language. Repeated rows give repeated results. Other columns are ignored. references (lang, common, word_counts,
    class_counts), as corpus_references() makes them, stand in place of the corpus's own.
    """
    documents = documents.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").alias("__lang"))
    temporary = Temporary()
    given = references is not None
    references = references.withColumnRenamed("lang", "__lang") if given else temporary.staged(common_words(documents, n_common))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    # A row for each language tag; Spark broadcasts them only within its own size limit.
    df = text_counts(documents.join(references.select("__lang", "common"), "__lang", "left"), ["doc_id", "__lang", "common"])
    # Written once: the languages' sums and the verdicts both need the counts, and the texts no more.
    df = temporary.staged(df.select("doc_id", "__lang", *counts, "__classes", common_counts(F.col("__words"), F.col("common")).alias("__word_counts")))
    sums = references.select("__lang", "word_counts", "class_counts") if given else temporary.staged(language_references(df, n_common))
    joined = df.join(sums, "__lang", "left").withColumn("__own", F.when(F.col("n_words") >= min_words, F.col("__word_counts")))
    far = F.coalesce(F.col("word_distance") > max_word_distance, F.lit(False)) | F.coalesce(F.col("class_distance") > max_class_distance, F.lit(False))
    out = joined.select(
        "doc_id", *counts, base_failed().alias("base_failed"),
        distance("__own", "word_counts").alias("word_distance"),
        F.when(F.aggregate("__classes", F.lit(0).cast("long"), lambda a, x: a + x) >= min_chars, distance("__classes", "class_counts")).alias("class_distance"),
    )
    return temporary.last(out.withColumn("kept", ~F.col("base_failed") & ~far))


def corpus_references(documents: DataFrame, n_common: int = N_COMMON) -> DataFrame:
    """(lang, common, word_counts, class_counts) of a corpus of documents (text, lang), for use on others."""
    documents = documents.select(F.col("text").cast("string").alias("text"), F.col("lang").alias("__lang"))
    temporary = Temporary()
    words = temporary.staged(common_words(documents, n_common))
    df = text_counts(documents.join(words, "__lang", "left"), ["__lang", "common"])
    df = df.withColumn("__word_counts", common_counts(F.col("__words"), F.col("common")))
    return temporary.last(language_references(df, n_common).join(words, "__lang").select(F.col("__lang").alias("lang"), "common", "word_counts", "class_counts"))
