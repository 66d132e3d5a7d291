"""Feature selection by the F statistic of a linear fit of the target on each feature."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def f_regression(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, f): r^2 / (1 - r^2) * (n - 2), all features in one pass over rows without nulls in them."""
    x = lambda c: F.col(c).cast("double")
    one = df.dropna(subset=[*features, target]).agg(F.count(F.lit(1)).alias("n"), *[F.corr(x(c), x(target)).alias(f"r{k}") for k, c in enumerate(features)])
    f = lambda r: F.when(r * r < 1, r * r / (1 - r * r) * (F.col("n") - 2)).otherwise(float("inf"))
    rows = [F.struct(F.lit(c).alias("feature"), f(F.col(f"r{k}")).alias("f"), (F.col("n") - 2).alias("df2")) for k, c in enumerate(features)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def stirling_rest(z: Column) -> Column:
    """What the logarithm of the gamma function has beyond (z - 1/2) log z - z + log(2 pi) / 2, for z > 0: a series at z + 10, carried down by the factors z .. z + 9."""
    big = z + 10
    series = 1 / (12 * big) - 1 / (360 * F.pow(big, F.lit(3))) + 1 / (1260 * F.pow(big, F.lit(5))) - 1 / (1680 * F.pow(big, F.lit(7))) + 1 / (1188 * F.pow(big, F.lit(9)))
    # log(z + k + 1) - log(z + k), weighed as the main part's change from z + k to z + k + 1 asks.
    down = F.aggregate(F.sequence(F.lit(0), F.lit(9)), F.lit(0.0), lambda s, k: s + (z + k + 0.5) * F.log1p(1 / (z + k)) - 1)
    return series + down


def continued(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, by Lentz's method; terms that change nothing more are passed over."""
    apart = lambda v: F.when(F.abs(v) > 1e-300, v).otherwise(1e-300)

    def step(s: Column, n: Column) -> Column:
        d, c = 1 / apart(1 + n * s["d"]), apart(1 + n / s["c"])
        return F.struct((s["h"] * d * c).alias("h"), d.alias("d"), c.alias("c"), (d * c).alias("last"))

    def term(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        # Arrays of one element, so that the first step is computed once.
        return F.when(F.abs(s["last"] - 1) < 1e-15, s).otherwise(F.transform(F.array(step(s, even)), lambda t: step(t, odd))[0])

    first = 1 / apart(1 - (a + b) * x / (a + 1))
    start = F.struct(first.alias("h"), first.alias("d"), F.lit(1.0).alias("c"), F.lit(0.0).alias("last"))
    # As many terms as the fraction can need, about the root of the larger parameter.
    terms = F.transform(F.sequence(F.lit(1), (100 + 10 * F.sqrt(F.greatest(a, b))).cast("int")), lambda m: m.cast("double"))
    return F.aggregate(terms, start, term, lambda s: s["h"])


def f_tail(f: Column, df1: Column, df2: Column) -> Column:
    """P(F > f) as a column: the regularised incomplete beta function at df2 / (df2 + df1 f).

    1 for f of 0 or less, 0 for an infinite one, null where anything is null or NaN or a degree isn't above 0.
    """
    a, b, f = df2.cast("double") / 2, df1.cast("double") / 2, f.cast("double")
    scaled = a + b * f
    x, rest = a / scaled, b * f / scaled
    # The logarithm of x^a rest^b / B(a, b); large terms that cancel are left out, so that high degrees keep their digits.
    powers = a * F.log1p(b * (1 - f) / scaled) + b * F.when(f > 0.5, F.log1p(a * (f - 1) / scaled)).otherwise(F.log(f * (a + b) / scaled))
    front = F.exp(powers + 0.5 * (F.log(a) + F.log(b) - F.log(a + b) - math.log(2 * math.pi)) + stirling_rest(a + b) - stirling_rest(a) - stirling_rest(b))
    low = x < (a + 1) / (a + b + 2)
    tail = F.when(low, front * continued(a, b, x) / a).otherwise(1 - front * continued(b, a, rest) / b)
    return F.when(F.isnan(f) | ~((a > 0) & (b > 0)), F.lit(None).cast("double")).when(f <= 0, 1.0).when(f == float("inf"), 0.0).when(f.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))


def with_p_values(scores: DataFrame) -> DataFrame:
    """(feature, f, p) of f_regression()'s rows; p is null where f is."""
    return scores.select("feature", "f", f_tail(F.col("f"), F.lit(1), F.col("df2")).alias("p"))


def select_features(scores: DataFrame, mode: str, param: float) -> DataFrame:
    """The best features: "k_best" the first param, "percentile" the first param percent; ties by name."""
    n = scores.count() if mode == "percentile" else 0
    k = int(param) if mode == "k_best" else int(n * param / 100)
    return scores.orderBy(F.desc("f"), "feature").limit(k).select("feature", "f")
