"""Column expressions with the arithmetic of everyday scripts: floor division, banded grades, interest, bank rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(x: Column, y: Column) -> Column:
    """Quotient rounded down, also for negative numbers."""
    return F.floor(x / y)


def floor_mod(x: Column, y: Column) -> Column:
    """Remainder with the sign of y, which goes with floor_div()."""
    return x - y * F.floor(x / y)


def banded(value: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first band whose least value is reached; bands go from high to low."""
    out = F.when(value >= bands[0][0], bands[0][1])
    for least, label in bands[1:]:
        out = out.when(value >= least, label)
    return out.otherwise(otherwise)


def grade(score: Column) -> Column:
    return banded(score, [(90, "A"), (80, "B"), (70, "C"), (60, "D")], "F")


def circle_area(radius: Column) -> Column:
    return F.pi() * F.pow(radius, F.lit(2))


def simple_interest(principal: Column, rate: Column, years: Column) -> Column:
    return principal * rate * years / 100


def instalment(principal: Column, yearly_rate: Column, months: Column) -> Column:
    """Equal monthly instalment; without interest, an equal share."""
    r = yearly_rate / 1200
    growth = F.pow(1 + r, months)
    return F.when(r == 0, principal / months).otherwise(principal * r * growth / (growth - 1))


def looked_up(key: Column, table: dict[str, float], default: float) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def running_balance(amounts: Column, start: Column | None = None) -> Column:
    """The balance after an array of amounts in order, from start or 0; a withdrawal that the balance doesn't cover is refused."""
    return F.aggregate(amounts, F.lit(0.0) if start is None else start, lambda b, x: F.when(b + x >= 0, b + x).otherwise(b))


def half_even(x: Column, digits: int) -> Column:
    return F.bround(x, digits)


def rounded_up(x: Column, digits: int) -> Column:
    """Rounded as SQL does: scaled, halves away from zero, and a small negative number is -0.0."""
    y = x * 10.0**digits
    whole = F.when(F.abs(y) % 1 == 0.5, F.signum(y) * (F.floor(F.abs(y)) + 1)).otherwise(F.rint(y))
    return whole / 10.0**digits
