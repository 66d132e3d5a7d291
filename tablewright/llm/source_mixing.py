"""Mixing sources to target weights: iterative proportional fitting of token weights, then sampling.

Tokens are summed by cell (source, language, topic). The cells' weights are raked in turn to each dimension's target
shares until no share is off by more than TOLERANCE of itself. Where sources are tied to languages, plain raking takes
thousands of rounds; so after two rounds the logarithms of the weights are carried on along their change by steps of
several lengths, which keeps them a product of the dimensions' factors, and raked once more; the best of them goes on,
which may be the one without a step. The ratio of a cell's weight to its tokens, scaled so that the largest is 1, is the probability
with which each of its documents is kept. A document's draw is a hash of its id, so a sample is the same at every run,
whatever the partitions.

Documents are summed to cells on the map side; the raking runs over cells only. Cells go back to the documents by
broadcast if there are at most BROADCAST_CELLS of them, else by a join that Spark can split where a cell is hot.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Temporary, packed, space_words, text_or_empty, unpacked

DIMENSIONS = ("source", "lang", "topic")
NONE = "(none)"
TOLERANCE = 1e-10
MAX_CYCLES = 60
#: So many cycles in a row, each of which leaves more than this part of what was off, are no progress.
STALLED_CYCLES, STALLED = 6, 0.9
#: Steps along the change of a round that are tried, besides two that follow its bend.
LEAPS = (4.0, 16.0, 64.0, 256.0, 1024.0, 4096.0)
#: Logarithms of weights stay within what a double can hold.
LOG_RANGE = 600.0
BROADCAST_CELLS = 100_000
HASH_RANGE = 16**8


def length_band(n_tokens: Column) -> Column:
    """A topic for tables that have none: the band of a text's length."""
    return F.when(n_tokens < 150, "short").when(n_tokens < 600, "medium").otherwise("long")


def draw(key: Column) -> Column:
    """A number from 0 to 1 (exclusive) that depends on the key alone; null counts as the empty string."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / HASH_RANGE


def tempered_targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(dimension, share): shares of tokens to a power under 1, which lifts small values; 0 makes them equal."""
    own = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).where("t > 0").select(dimension, F.pow("t", F.lit(power)).alias("share"))
    total = own.agg(F.sum("share").alias("__all"))  # one row
    return own.crossJoin(F.broadcast(total)).select(dimension, (F.col("share") / F.col("__all")).alias("share"))


class UnmetTargets(ValueError):
    """The targets contradict each other: no weights have these shares."""


def raked(df: DataFrame, weights: list[str], few: bool) -> DataFrame:
    """df with each of the columns of weights after one round over the dimensions; few: df has BROADCAST_CELLS rows at most."""
    for name in DIMENSIONS:
        # Summed on the map side and a join away, so no value's cells meet in one task.
        held = df.groupBy(name).agg(*[F.sum(w).alias(f"__held_{w}") for w in weights])
        fitted = {w: F.when(F.col(f"__held_{w}") > 0, F.col(w) * F.col(f"__{name}") / F.col(f"__held_{w}")).otherwise(0.0) for w in weights}
        df = df.join(F.broadcast(held) if few else held, name).withColumns(fitted).drop(*[f"__held_{w}" for w in weights])
    return df


def worst_shares(df: DataFrame, weights: list[str]) -> list[float]:
    """For each of weights by how much of itself the share furthest from its target is off."""
    off = []
    for name in DIMENSIONS:
        sums = df.groupBy(name).agg(F.max(f"__{name}").alias("__share"), *[F.sum(w).alias(w) for w in weights]).where("__share > 0")
        off.append(sums.select(*[F.when(F.col(w) > 0, F.abs(F.col(w) / F.col("__share") - 1)).alias(w) for w in weights]))
    return [x or 0.0 for x in off[0].unionAll(off[1]).unionAll(off[2]).agg(*[F.max(w) for w in weights]).first()]


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE, max_cycles: int = MAX_CYCLES, temporary: Temporary | None = None, unmet: str = "raise") -> DataFrame:
    """Adds weight to cells (source, lang, topic, tokens): it starts as tokens and is fitted to the targets (dimension, share).

    A value without a target gets none of the weight. Weights sum to 1 after each step if every target has tokens. Ends
    when each value's sum of weights is within tolerance of its share, relative to it. Where that is not reached, as with
    targets that contradict each other, raises UnmetTargets, or warns and takes the last weights if unmet is "warn".
    """
    final = temporary or Temporary()
    df = cells.where("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    for name in DIMENSIONS:
        df = df.join(targets[name].select(name, F.col("share").alias(f"__{name}")), name, "left").fillna(0.0, [f"__{name}"])
    own, old = [*cells.columns, "weight", *[f"__{name}" for name in DIMENSIONS]], Temporary()
    df = old.staged(df.select(*own))
    few = df.count() <= BROADCAST_CELLS
    if few:
        df = df.coalesce(1)
    df = old.staged(raked(df, ["weight"], few))
    (worst,), slow = worst_shares(df, ["weight"]), 0
    tried = ["__w2", *[f"__far{k}" for k in range(2 + len(LEAPS))]]
    for _ in range(max_cycles):
        if worst <= tolerance or slow >= STALLED_CYCLES:
            break
        new = Temporary()
        one = new.staged(raked(df.withColumn("__w1", F.col("weight")), ["__w1"], few))
        two = new.staged(raked(one.withColumn("__w2", F.col("__w1")), ["__w2"], few))
        alive = (F.col("weight") > 0) & (F.col("__w1") > 0) & (F.col("__w2") > 0)
        change = F.when(alive, F.log("__w1") - F.log("weight"))
        bend = F.when(alive, F.log("__w2") - 2 * F.log("__w1") + F.log("weight"))
        r, v = two.agg(F.sum(change * change), F.sum(bend * bend)).first()
        step = max(1.0, (r / v) ** 0.5) if r and v else 1.0
        further = [2 * x * change + x * x * bend for x in (step, step / 2)] + [x * change for x in LEAPS]
        at = lambda x: F.exp(F.greatest(F.least(F.log("weight") + x, F.lit(LOG_RANGE)), F.lit(-LOG_RANGE)))
        far = two.withColumns({w: F.when(alive, at(x)).otherwise(F.col("__w2")) for w, x in zip(tried[1:], further)})
        df = new.staged(raked(far, tried[1:], few))
        before, off = worst, worst_shares(df, tried)
        worst, kept = min(zip(off, tried))
        df = df.withColumn("weight", F.col(kept)).select(*own)
        slow = slow + 1 if worst > STALLED * before else 0
        old.release()
        old = new
    if worst > tolerance:
        said = f"shares are still off by {worst:.2g} of themselves: the targets contradict each other"
        if unmet == "raise":
            old.release()
            raise UnmetTargets(said)
        warnings.warn(said, stacklevel=2)
    out = final.staged(df.drop(*[f"__{name}" for name in DIMENSIONS]))
    old.release()
    return out


def probabilities(cells: DataFrame) -> DataFrame:
    """Adds ratio (weight to tokens) and probability (ratio over the largest one)."""
    df = cells.withColumn("ratio", F.col("weight") / F.col("tokens"))
    top = df.agg(F.max("ratio").alias("__top"))
    return df.crossJoin(F.broadcast(top)).withColumn("probability", F.when(F.col("__top") > 0, F.col("ratio") / F.col("__top")).otherwise(0.0)).drop("__top")


def with_probabilities(documents: DataFrame, keep: list[str], topic: Column | None = None, targets: dict[str, DataFrame] | None = None, power: float = 0.7, tolerance: float = TOLERANCE, max_cycles: int = MAX_CYCLES) -> DataFrame:
    """keep, and __tokens, __source, __lang, __topic, __ratio, __probability, __draw of each row."""
    temporary = Temporary()
    docs = documents.select(*keep, F.size(space_words(text_or_empty("text"))).cast("long").alias("__tokens"), *[F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(f"__{c}") for c in ("source", "lang")], draw(F.col("doc_id")).alias("__draw"))
    docs = docs.withColumn("__topic", F.coalesce(topic, F.lit(NONE)) if topic is not None else length_band(F.col("__tokens")))
    cells = temporary.staged(docs.groupBy(*[F.col(f"__{c}").alias(c) for c in DIMENSIONS]).agg(F.sum("__tokens").alias("tokens")))
    unmet = "raise" if targets else "warn"
    if targets is None:
        targets = {c: tempered_targets(cells, c, power) for c in DIMENSIONS}
    raked = temporary.last(probabilities(rake(cells, targets, tolerance, max_cycles, temporary, unmet)))
    own = raked.select(*[F.col(c).alias(f"__{c}") for c in DIMENSIONS], F.col("ratio").alias("__ratio"), F.col("probability").alias("__probability"))
    own = F.broadcast(own) if raked.count() <= BROADCAST_CELLS else own
    # A cell without tokens has no weight; its documents are empty.
    return docs.join(own, [f"__{c}" for c in DIMENSIONS], "left").fillna(0.0, ["__ratio", "__probability"])


def source_mixing(documents: DataFrame, **options) -> DataFrame:
    """For each row of documents (doc_id, text, source, lang): its cell, tokens, probability, draw and sampled.

    Tokens are words between white space. A null source, language or topic is a value of its own, "(none)"; a null text
    has no tokens, and documents whose cell has none are not sampled. Targets that are given and can't be met raise
    UnmetTargets; without any, the corpus's own shares to a power are the targets, and where few cells can't meet these
    there is a warning. Rows of the same doc_id share one draw, so
    repeated rows stay or go together. Other columns are ignored.
    """
    df = with_probabilities(documents, ["doc_id"], **options)
    return df.select(
        "doc_id", F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"),
        F.col("__probability").alias("probability"), F.col("__draw").alias("draw"), (F.col("__draw") < F.col("__probability")).alias("sampled"),
    )


def sample_documents(documents: DataFrame, **options) -> DataFrame:
    """The rows of documents that source_mixing() samples, with their columns."""
    df = with_probabilities(packed(documents, "source", "lang"), ["__own"], **options)
    return unpacked(df.where(F.col("__draw") < F.col("__probability")), documents)
