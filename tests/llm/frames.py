"""Small tables with nulls, empty and very long texts, ties, repeated rows and columns with names that clash."""

from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, token string, key string, first long, a long, b long, k int, n int, sig long, at string, plain string, id long, weight double, tokens int, topic string, h string, `a.b` string, __id long, __tokens long, __places int, __items string, __bucket int, __own string, __row int, `b``c` string"


def odd_rows():
    long = " ".join(f"w{i}" for i in range(30000))
    texts = [
        (1, "The quick brown fox jumps over the lazy dog.\nAnd then it sleeps for a while, as it was told.", "en", "s1"),
        (2, None, "en", "s1"),
        (3, "", "en", None),
        (4, long, None, "s2"),
        (5, "  \n\t \n", "de", "s2"),
        (6, "The quick brown fox jumps over the lazy dog.\nAnd then it sleeps for a while, as it was told.", "en", "s1"),
        (7, "one", "xx", "s3"),
        (7, "one", "xx", "s3"),
        (8, "é" * 5000, "fr", "s3"),
        (None, "a row without an id but with quite a few words in its text, more than ten", "en", "s1"),
        (None, None, None, None),
        (9, "same same same same same same same same same same same same", "en", "s1"),
        (10, "Ünïcödé     words\x00 and\x1f controls 'tis <|endoftext|> it's", "en", "s1"),
    ]
    extra = (7, 0.5, "t", "k", 1, 2, 3, 4, 5, 6, "at", "p", 8, 0.1, 9, "topic", "h", "dot", 1, 2, 3, "i", 4, "own", 5, "tick")
    return [(i, t, lang, source, len(t or ""), *extra) for i, t, lang, source in texts]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, rows):
    """Rows of (doc_id, text), with lang and source."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, schema).withColumns({"lang": F.lit("en"), "source": F.concat(F.lit("s"), F.col("doc_id") % 5)})
