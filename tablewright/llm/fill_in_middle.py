"""Fill in the middle: texts cut at two unit ordinals into prefix, middle and suffix, by joins on the ordinals.

1. A text's units are the matches of a pattern, from left to right; a code point where none begins is a unit of its own.
   Runs of BLOCK units are exploded with their ordinals, so a text of a million code points is 245 rows.
2. Running sums over a text's runs give the characters before each run, and how many units the text has.
3. A text asks for two cuts. Each request is joined with the run that holds its unit ordinal; the lengths of the run's
   units before it are added to the run's offset.
4. The offsets of a text are aggregated and meet the text again, whose parts are its substrings.

Texts are known by a 128-bit hash of doc_id and text, so rows that repeat are cut once, and a lost task gives the same
again. A run is a few numbers; units' lengths come with it only where they aren't all one code point. Texts are read
twice and shuffled once, to meet their offsets; a text that a third of all rows repeat is one row on the other side, so
Spark can split it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Temporary, text_or_empty

#: Units of a text exploded as one row.
BLOCK = 4096
CODE_POINT = "(?s:.)"
#: Marks of the parts in the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
KEY = ["__a", "__b"]


def numbers(seed: int) -> Column:
    """Four numbers below 2^32 that depend on seed and doc_id alone; a null doc_id counts as the empty string."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def keyed(documents: DataFrame, *more: str) -> DataFrame:
    """doc_id, __text, more and the key __a, __b of a row's doc_id and text."""
    df = documents.select("doc_id", text_or_empty(F.col("text").cast("string")).alias("__text"), *more)
    own = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), F.col("__text")]
    return df.withColumns({"__a": F.xxhash64(*own), "__b": F.xxhash64(F.lit(7), *own)})


def runs_of(texts: DataFrame, unit: str, block: int) -> DataFrame:
    """(key, h, run, units, chars, lengths): each text's runs of block units; lengths (of the units) is null where all are 1."""
    one = unit if unit == CODE_POINT else f"(?:{unit}|{CODE_POINT})"
    # Possessive: a run never gives a unit back, so units are those of a search from left to right.
    runs = texts.select(*KEY, "__h", F.posexplode(F.regexp_extract_all("__text", F.lit(f"(?:{one}){{1,{block}}}+"), F.lit(0))).alias("run", "__run"))
    chars = F.length("__run")
    if unit == CODE_POINT:
        return runs.select(*KEY, "__h", "run", chars.alias("units"), chars.alias("chars"), F.lit(None).cast("array<int>").alias("lengths"))
    lengths = F.transform(F.regexp_extract_all("__run", F.lit(one), F.lit(0)), F.length)
    runs = runs.select(*KEY, "__h", "run", chars.alias("chars"), lengths.alias("lengths"))
    return runs.select(*KEY, "__h", "run", F.size("lengths").alias("units"), "chars", F.when(F.size("lengths") < F.col("chars"), F.col("lengths")).alias("lengths"))


def offsets(documents: DataFrame, unit: str, seed: int, block: int, temporary: Temporary) -> DataFrame:
    """(key, n, first, second): of each text with units their number, and the characters before its two cuts."""
    texts = keyed(documents).withColumn("__h", numbers(seed))
    # Rows that repeat are one from here on; reduced on the map side.
    runs = runs_of(texts, unit, block).dropDuplicates([*KEY, "run"])
    own = Window.partitionBy(*KEY).orderBy("run")
    before = F.coalesce(F.sum("chars").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumns({"before": before, "n": F.sum("units").over(Window.partitionBy(*KEY))})
    runs = temporary.staged(runs)

    cuts = runs.where("run = 0").select(*KEY, "n", F.explode(F.transform(F.slice("__h", 1, 2), lambda h: F.pmod(h, F.col("n") + 1))).alias("cut"))
    # A cut after the last unit of a run is asked of that run.
    wanted = cuts.withColumn("run", F.floor(F.greatest(F.col("cut") - 1, F.lit(0)) / block).cast("int"))
    met = wanted.join(runs.select(*KEY, "run", "before", "lengths"), [*KEY, "run"])
    within = (F.col("cut") - F.col("run") * block).cast("int")
    at = F.col("before") + F.when(F.col("lengths").isNull(), within).otherwise(F.aggregate(F.slice("lengths", F.lit(1), within), F.lit(0), lambda s, x: s + x))
    return met.withColumn("at", at).groupBy(*KEY).agg(F.max("n").alias("n"), F.min("at").cast("int").alias("first"), F.max("at").cast("int").alias("second"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text, rebuilt from an output and its form alone. Texts that hold a mark are plain, so marks are found again."""
    out = F.col(output)
    upto, after = lambda x, mark: F.substring_index(x, mark, 1), lambda x, mark: F.substring_index(x, mark, -1)
    body = lambda x: F.substring(x, F.lit(len(PREFIX) + 1), F.length(x))
    psm = F.concat(body(upto(out, SUFFIX)), after(out, MIDDLE), after(upto(out, MIDDLE), SUFFIX))
    spm = F.concat(after(upto(out, MIDDLE), PREFIX), after(out, MIDDLE), body(upto(out, PREFIX)))
    return F.when(F.col(form) == PSM, psm).when(F.col(form) == SPM, spm).otherwise(out)


def cut_texts(documents: DataFrame, unit: str = CODE_POINT, seed: int = 1, plain_from: int = 90, spm_below: int = 20, block: int = BLOCK) -> DataFrame:
    """Each row of documents (doc_id, text): doc_id, text, n (units), form, prefix, middle, suffix (null if plain) and output.

    Which two ordinals of 0 to n cut a text, and its form, are taken from hashes of doc_id: plain (the text as it is) for
    a hash of plain_from of 100 or more, and where a text is empty or holds a mark; of the others spm (suffix first) below
    spm_below, else psm. unit is a pattern without look-around that doesn't match the empty string.

    A null text is empty. Rows of the same doc_id are cut by the same hashes; rows that repeat give repeated results, and
    a null doc_id counts as the empty string. Other columns are ignored.
    """
    temporary = Temporary()
    at = temporary.last(offsets(documents, unit, seed, block, temporary))
    df = keyed(documents).withColumn("__h", numbers(seed)).join(at, KEY, "left")
    text, h = F.col("__text"), F.col("__h")
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when((text == "") | marked | (h[2] % 100 >= plain_from), PLAIN).when(h[3] % 100 < spm_below, SPM).otherwise(PSM)
    df = df.select("doc_id", text.alias("text"), F.coalesce("n", F.lit(0)).cast("long").alias("n"), form.alias("form"), "first", "second")
    part = lambda start, length: F.when(F.col("form") != PLAIN, F.substring("text", start, length))
    df = df.withColumns({
        "prefix": part(F.lit(1), F.col("first")),
        "middle": part(F.col("first") + 1, F.col("second") - F.col("first")),
        "suffix": part(F.col("second") + 1, F.length("text")),
    })
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    return df.withColumn("output", F.when(F.col("form") == PSM, psm).when(F.col("form") == SPM, spm).otherwise(F.col("text"))).drop("first", "second")


def fill_in_middle(documents: DataFrame, **options) -> DataFrame:
    """For each row of documents: n, form, prefix_chars, middle_chars, and hashes of the output and of the text rebuilt from it; see cut_texts()."""
    df = cut_texts(documents, **options)
    return df.select(
        "doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"),
    )
