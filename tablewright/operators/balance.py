"""Running balances: moves in order, where a withdrawal that the balance doesn't cover is refused.

Such a fold isn't associative, so sums of parts can't be combined. But a chunk of moves is, for any balance of at least its
need (the deepest fall of its running sum), just its sum: only a chunk that is met with less has to be gone through move by
move. An account's chunks are therefore passed over by sums up to the first such chunk, that one is replayed from the
balance it is met with, and so on, for all accounts at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import running_balance
from ..staging import Staging

#: Moves of an account that one array holds.
CHUNK = 10_000
#: Rows of a range of accounts and moves, which one task puts in order.
ROWS_A_RANGE = 500_000


def ranged(df: DataFrame, order: Sequence[str], rows: int, keep: Staging) -> DataFrame:
    """df, written, with __range: ranges of the whole order, so that rows of one account, however many, are many ranges.

    Written rows keep the range they got, also when a task is run again.
    """
    df = keep(df)
    parts = max(1, -(-df.count() // rows))
    return keep(df.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()), df)


def chunks(moves: DataFrame, by: str, order: Sequence[str], amount: str, size: int) -> DataFrame:
    """(by, at, amounts, n, total, need) of each chunk of at most size moves; at rises along an account's chunks."""
    kind = moves.schema[amount].dataType
    moves = moves.withColumn("__k", F.floor((F.row_number().over(Window.partitionBy("__range", by).orderBy(*order)) - 1) / size))
    ordered = moves.groupBy(by, F.struct("__range", "__k").alias("at")).agg(F.sort_array(F.collect_list(F.struct(*order, F.col(amount).alias("__amount")))).alias("m"))
    ordered = ordered.select(by, "at", F.transform("m", lambda x: x["__amount"]).alias("amounts"))
    zero = F.lit(0).cast(kind)
    fall = F.aggregate("amounts", F.struct(zero.alias("s"), zero.alias("low")), lambda a, x: F.struct((a["s"] + x).cast(kind).alias("s"), F.least(a["low"], (a["s"] + x).cast(kind)).alias("low")))
    return ordered.withColumn("__f", fall).select(by, "at", "amounts", F.size("amounts").cast("long").alias("n"), F.col("__f.s").alias("total"), (-F.col("__f.low")).cast(kind).alias("need"))


def running_balances(df: DataFrame, by: str, order: Sequence[str], amount: str, chunk: int | None = None, rows_a_range: int | None = None) -> DataFrame:
    """(by, n_moves, balance): each account's moves counted, and the balance after the last, from 0.

    order should be unique in an account; moves equal in it go by amount. Moves without an amount count and change nothing;
    those without an account are left out. Decimal amounts are added exactly; others as doubles, where a balance that meets
    a withdrawal to the last bit may go either way, as the order of additions differs. No array holds more than chunk
    moves. There are as many rounds as the account with the most replayed chunks has; the driver sees only whether any is
    left. chunk and rows_a_range are CHUNK and ROWS_A_RANGE if not given. The result is a staged table, which remains.
    """
    with Staging() as keep:
        return Staging().__enter__()(ends(df, by, order, amount, keep, chunk or CHUNK, rows_a_range or ROWS_A_RANGE))


def ends(df: DataFrame, by: str, order: Sequence[str], amount: str, keep: Staging, chunk: int, rows_a_range: int) -> DataFrame:
    """running_balances() as a plan over tables of keep."""
    kind = df.schema[amount].dataType
    kind = T.DecimalType(38, kind.scale) if isinstance(kind, T.DecimalType) else T.DoubleType()
    moves = df.where(F.col(by).isNotNull()).select(by, *order, F.coalesce(F.col(amount).cast(kind), F.lit(0).cast(kind)).alias("__move"))
    parts = keep(chunks(ranged(moves, [by, *order], rows_a_range, keep), by, order, "__move", chunk))
    # A row for each chunk: an account of 10^9 moves has 10^5.
    before = Window.partitionBy(by).orderBy("at")
    known = keep(parts.select(by, "at", "n", "total", "need").withColumn("through", F.sum("total").over(before).cast(kind)).withColumn("last", F.lead("at").over(before).isNull()))
    sums = known.groupBy(by).agg(F.sum("n").alias("n_moves"), F.sum("total").cast(kind).alias("sum"))
    # An account starts before its first chunk with nothing; whoever has met no further lack ends by sums.
    state = keep(known.groupBy(by).agg(F.min("at").alias("at")).select(by, F.struct(F.lit(-1).alias("__range"), F.lit(-1).cast("long").alias("__k")).alias("at"), F.lit(0).cast(kind).alias("balance"), F.lit(0).cast(kind).alias("through")))
    ended = []
    while True:
        here = state.select(by, F.col("at").alias("__at"), F.col("balance").alias("__balance"), F.col("through").alias("__through"))
        met = (F.col("__balance") + F.col("through") - F.col("total") - F.col("__through")).cast(kind)
        short = known.join(here, by).where(F.col("at") > F.col("__at")).withColumn("met", met).where("met < need")
        first = short.groupBy(by).agg(F.min(F.struct("at", "met", "through", "last")).alias("f")).select(by, "f.*")
        replayed = first.join(parts.select(by, "at", "amounts"), [by, "at"]).select(by, "at", running_balance(F.col("amounts"), F.col("met")).cast(kind).alias("balance"), "through", "last")
        moved = keep(replayed)
        ended.append(state.join(moved, by, "left_anti").select(by, "balance", "through"))
        ended.append(moved.where("last").select(by, "balance", "through"))
        if moved.where("NOT last").isEmpty():
            break
        state = moved.where("NOT last").drop("last")
    out = ended[0]
    for part in ended[1:]:
        out = out.unionByName(part)
    return out.join(sums, by).select(by, "n_moves", (F.col("balance") + F.col("sum") - F.col("through")).cast(kind).alias("balance"))
