"""Frequent itemsets and association rules with any split of an itemset into antecedent and consequent."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import Staging


def from_wide(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, items): the distinct values of columns that aren't null."""
    return df.select(key, F.array_sort(F.array_distinct(F.array_compact(F.array(*columns)))).alias("items"))


def from_long(df: DataFrame, key: str, item: str) -> DataFrame:
    return df.groupBy(key).agg(F.array_sort(F.collect_set(item)).alias("items"))


def itemsets(baskets: DataFrame, least_support: float, max_length: int | None = None) -> DataFrame:
    """(items, freq, support, length) of itemsets in at least that share of baskets; items in order.

    With max_length, longer ones are never looked for: level by level, of the frequent items of each basket, those
    combinations are counted whose part without the last item is frequent. Without it all lengths are mined.
    """
    n = baskets.agg(F.count(F.lit(1)).alias("__n"))
    if max_length is None:
        found = FPGrowth(itemsCol="items", minSupport=least_support).fit(baskets.select("items")).freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    else:
        found = _levels(baskets.select("items"), n, least_support, max_length)
    return found.crossJoin(F.broadcast(n)).select("items", "freq", (F.col("freq") / F.col("__n")).alias("support"), F.size("items").alias("length"))


def _levels(baskets: DataFrame, n: DataFrame, least_support: float, max_length: int) -> DataFrame:
    enough = F.col("freq") >= F.ceil(F.round(F.col("__n") * least_support, 9))
    frequent = lambda counted: counted.crossJoin(F.broadcast(n)).where(enough).drop("__n")
    one = frequent(baskets.select(F.explode(F.array_distinct("items")).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("freq")))
    rows = baskets.withColumn("__id", F.monotonically_increasing_id()).select("__id", F.explode(F.array_distinct("items")).alias("item"))
    rows = rows.join(one.select("item"), "item").groupBy("__id").agg(F.array_sort(F.collect_list("item")).alias("items"))
    out, level = one.select(F.array("item").alias("items"), "freq"), None
    for length in range(2, max_length + 1):
        # Each start (an itemset of one less) with each later item of its basket.
        if level is None:
            starts = rows.select("items", F.posexplode("items").alias("at", "x")).select("items", F.array("x").alias("start"), "at")
        else:
            starts = level.join(frequent_sets, "start")
        more = starts.select("items", "start", F.posexplode(F.expr("slice(items, at + 2, size(items))")).alias("step", "x"), "at")
        level = more.select("items", F.concat("start", F.array("x")).alias("start"), (F.col("at") + F.col("step") + 1).alias("at"))
        counted = frequent(level.groupBy(F.col("start").alias("items")).agg(F.count(F.lit(1)).alias("freq")))
        frequent_sets = counted.select(F.col("items").alias("start"))
        out = out.unionByName(counted)
    return out


#: Distinct baskets whose numbers are one array, about.
RANGE = 4096


def vertical_itemsets(baskets: DataFrame, least_support: float, size: int = RANGE) -> DataFrame:
    """(items, freq, support, length) as itemsets(), of any length, by difference sets over ranges of baskets (basket, items).

    Equal baskets are one from the start, so all that follows grows with the distinct ones: a basket that comes w times is
    in the ranges of each bit of w, whose baskets count 1, 2, 4... times. Ranges hold about `size` baskets; an item's
    baskets in a range are one array. A set keeps, for each range,
    only the baskets that its prefix (all items but the last) is in and it is not; so two sets of one prefix give the
    next longer one by a difference of arrays, and its frequency by a subtraction. Arrays have a bounded length, a level
    is joined on prefix and range, and only frequent sets go on. Baskets with a null key or null items count in the
    support's total alone. Ends at the first level without a frequent set.
    """
    with Staging() as keep:
        n = baskets.count()
        least = max(1, math.ceil(round(n * least_support, 9)))
        long = baskets.where("basket IS NOT NULL").select("basket", F.explode(F.array_distinct("items")).alias("item")).where("item IS NOT NULL")
        equal = long.groupBy("basket").agg(F.array_sort(F.collect_set("item")).alias("items")).groupBy("items").agg(F.count(F.lit(1)).alias("w"))
        # Numbers of their own, so that arrays hold 64-bit hashes whatever the items' type.
        bits = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda i: F.call_function("shiftright", F.col("w"), i) % 2 == 1)
        held = keep(equal.select("items", F.xxhash64("items").alias("b"), F.explode(bits).alias("bit")))
        ranges, first_of = [], {}
        for bit, count in sorted(held.groupBy("bit").agg(F.count(F.lit(1)).alias("n")).collect()):
            first_of[bit] = (len(ranges), -(-count // size))
            ranges += [(len(ranges) + k, 1 << bit) for k in range(first_of[bit][1])]
        ranges = baskets.sparkSession.createDataFrame(ranges, "range int, times long")  # a row for each
        start, parts = (F.get(F.array(*[F.lit(first_of.get(bit, (0, 1))[k]) for bit in range(63)]), F.col("bit")) for k in (0, 1))
        held = held.select(F.explode("items").alias("item"), "b", (start + F.pmod("b", parts)).cast("int").alias("range"))
        lists = held.groupBy("item", "range").agg(F.collect_list("b").alias("list")).join(F.broadcast(ranges), "range")
        enough = lists.groupBy("item").agg(F.sum(F.size("list") * F.col("times")).cast("long").alias("freq")).where(F.col("freq") >= least)
        found = [keep(enough.select(F.array("item").alias("items"), "freq"))]
        # Every set has a row for every range, if an empty one, so that each pair of sets meets in all of them.
        every = enough.select("item", "freq").crossJoin(F.broadcast(ranges))
        lists = every.join(lists.drop("times"), ["item", "range"], "left").withColumn("list", F.coalesce("list", F.array().cast("array<bigint>")))
        level = keep(lists.select(F.array().cast(f"array<{long.schema['item'].dataType.simpleString()}>").alias("prefix"), F.col("item").alias("last"), "range", "times", "list", "freq"))
        first = True
        while True:
            x, y = level.alias("x"), level.alias("y")
            pairs = x.join(y, (F.col("x.prefix") == F.col("y.prefix")) & (F.col("x.range") == F.col("y.range")) & (F.col("x.last") < F.col("y.last")))
            # Of lists of single items the first less the second; of difference sets the second less the first.
            difference = F.array_except("x.list", "y.list") if first else F.array_except("y.list", "x.list")
            sets = pairs.select(F.concat("x.prefix", F.array("x.last")).alias("prefix"), F.col("y.last").alias("last"), F.col("x.range").alias("range"), F.col("x.times").alias("times"), difference.alias("list"), F.col("x.freq").alias("of"))
            sets = keep(sets)
            counted = sets.groupBy("prefix", "last").agg(F.sum(F.size("list") * F.col("times")).alias("lost"), F.max("of").alias("of"))
            frequent = counted.select("prefix", "last", (F.col("of") - F.col("lost")).cast("long").alias("freq")).where(F.col("freq") >= least)
            level = keep(sets.drop("of").join(frequent, ["prefix", "last"]))
            following = keep(level.select(F.concat("prefix", F.array("last")).alias("items"), "freq").distinct())
            if following.isEmpty():
                break
            found.append(following)
            first = False
        rows = found[0]
        for more in found[1:]:
            rows = rows.unionByName(more)
        # This table is the result's own and stays.
        return Staging().__enter__()(rows.select("items", "freq", (F.col("freq") / F.lit(max(n, 1))).alias("support"), F.size("items").alias("length")))


def rules(sets: DataFrame, least_confidence: float = 0.0, least_lift: float = 0.0) -> DataFrame:
    """(antecedent, consequent, support, confidence, lift) for every split of each itemset in two parts with items.

    Each part of a frequent itemset is frequent, so its support is in sets; splits are the bit masks of the items.
    """
    masks = sets.where("length > 1").select("items", "support", F.explode(F.sequence(F.lit(1).cast("long"), F.expr("shiftleft(1L, length) - 2"))).alias("mask"))
    part = lambda bit: F.filter("items", lambda x, i: F.expr("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) == F.lit(0) if bit == 0 else F.expr("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != F.lit(0))
    split = masks.select("support", part(1).alias("antecedent"), part(0).alias("consequent"))
    one = sets.select(F.col("items").alias("antecedent"), F.col("support").alias("__a"))
    two = sets.select(F.col("items").alias("consequent"), F.col("support").alias("__c"))
    measured = split.join(one, "antecedent").join(two, "consequent").withColumn("confidence", F.col("support") / F.col("__a")).withColumn("lift", F.col("confidence") / F.col("__c"))
    return measured.where((F.col("confidence") >= least_confidence) & (F.col("lift") >= least_lift)).select("antecedent", "consequent", "support", "confidence", "lift")
