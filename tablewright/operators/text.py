"""Text as term counts and TF-IDF weights in long form, and similarities of documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import term_cosines

#: What parts tokens: anything but letters and digits of any script, and the underscore.
BREAK = r"[^\p{L}\p{N}_]+"

# English words left out by default.
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before being below between both but by can cannot could did do does doing down during each few for from further had has have having he her here hers herself him himself his how i if in into is it its itself me more most my myself no nor not of off on once only or other our ours ourselves out over own same she should so some such than that the their theirs them themselves then there these they this those through to too under until up very was we were what when where which while who whom why will with would you your yours yourself yourselves"
).split()


def tokens(text: Column) -> Column:
    """Lower-case tokens of at least two characters."""
    return F.filter(F.split(F.lower(text), BREAK), lambda t: F.length(t) >= 2)


def terms_of(df: DataFrame, text: str, stop_words: Sequence[str] = (), *keep: str) -> DataFrame:
    """(keep, term): a row for each token that is no stop word."""
    words = df.select(*keep, F.explode(tokens(F.col(text))).alias("term"))
    return words.where(~F.col("term").isin(list(stop_words))) if stop_words else words


def vocabulary(df: DataFrame, text: str, stop_words: Sequence[str] = (), max_terms: int | None = None) -> DataFrame:
    """(term): all terms, or the max_terms that are most frequent in all texts (ties by term); summed on the map side."""
    counts = terms_of(df, text, stop_words).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return (counts if max_terms is None else counts.orderBy(F.desc("n"), "term").limit(max_terms)).select("term")


def term_counts(df: DataFrame, key: str, text: str, stop_words: Sequence[str] = (), max_terms: int | None = None, known: DataFrame | None = None) -> DataFrame:
    """(key, term, tf): counts by document, of the max_terms terms that are most frequent in all (ties by term).

    With known (term), of the terms of that vocabulary instead, as for new texts.
    """
    words = terms_of(df, text, stop_words, key)
    if known is not None:
        words = words.join(known.select("term"), "term")
    elif max_terms is not None:
        words = words.join(F.broadcast(vocabulary(df, text, stop_words, max_terms)), "term")  # max_terms rows
    return words.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def idf(counts: DataFrame, n_documents: DataFrame) -> DataFrame:
    """(term, idf): ln((1 + n) / (1 + df)) + 1 of each term of counts; the fit that weighs other texts too.

    n_documents: one row with column n, so that documents without terms count too.
    """
    frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return frequency.crossJoin(F.broadcast(n_documents)).select("term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def weighted(counts: DataFrame, key: str, fit: DataFrame) -> DataFrame:
    """(key, term, weight): tf * idf of counts (key, term, tf) by a fit of idf(), each document scaled to length 1; terms without one are left out."""
    raw = counts.join(fit, "term").withColumn("raw", F.col("tf") * F.col("idf"))
    # At most one row for each term of a document in a window.
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.withColumn("weight", F.col("raw") / length).select(key, "term", "weight")


def tf_idf(counts: DataFrame, key: str, n_documents: DataFrame) -> DataFrame:
    """(key, term, weight) of counts by their own idf."""
    return weighted(counts, key, idf(counts, n_documents))


def similarities(weights: DataFrame, key: str, least: float = 0.0, queries: DataFrame | None = None, digits: int | None = None, edges: Sequence[float] = ()) -> DataFrame:
    """(a, b, cosine) of documents with a term in common, a < b; with digits, rounded.

    With queries (key, term, weight), vectors of the same vocabulary, pairs of one of them and another key. Vectors meet in
    blocks (see blocks), so that pairs are neither shuffled nor summed up over machines, however many share a term. With
    edges, those between two of them lie together (see term_cosines), which a very large result is smaller by.
    """
    return term_cosines(weights if queries is None else queries, weights, key, queries is None, least, digits, edges)


def embedded(df: DataFrame, term: str, table: DataFrame) -> DataFrame:
    """Adds vector from a look-up table (term, vector); unknown terms have null."""
    return df.join(table.select(F.col("term").alias(term), "vector"), term, "left")
