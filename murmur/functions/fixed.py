"""Exact sums and half-even rounding that do not depend on row order.

A sum of doubles changes with the order in which tasks finish. Scores carry at
most four decimals, so they are summed as whole millionths and divided once; a
BIGINT holds the sum of 9e12 of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur.functions.text import bind

MICRO = 1_000_000


def to_micro(value: Column) -> Column:
    return F.round(value * F.lit(float(MICRO))).cast("bigint")


def ratio(top: Column, bottom: Column, places: int) -> Column:
    """`top / bottom` of two whole numbers, half-even at `places`; 0 where bottom is 0."""
    scale = float(10 ** places)
    value = F.try_divide(top.cast("double") * scale, bottom.cast("double"))
    return F.coalesce(F.bround(value) / scale, F.lit(0.0))


def mean_of_micro(total: Column, n: Column, places: int) -> Column:
    """Mean of `n` values whose sum in millionths is `total`; null where there is none."""
    step = float(MICRO // 10 ** places)
    value = F.try_divide(total.cast("double"), n.cast("double") * step)
    return F.bround(value) / float(10 ** places)


def mean(value: Column, places: int) -> Column:
    """Aggregate: mean of a score column, exact and half-even at `places`."""
    return mean_of_micro(F.sum(to_micro(value)), F.count(value), places)


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    return ratio(part * 100, whole, places)


def round_binary(value: Column, places: int) -> Column:
    """Half-even rounding of the exact binary value of a double.

    Spark's rounding goes by the shortest decimal that prints; 0.12625 is a tie there,
    but as a double it lies above the middle. The scaled product's rounding error,
    found by splitting the double in two exact halves, says on which side.
    """
    scale = float(10 ** places)

    def rounded(x: Column) -> Column:
        product = x * scale
        high = x * 134217729.0 - (x * 134217729.0 - x)
        error = (high * scale - product) + (x - high) * scale
        whole = F.floor(product)
        side = F.when(error > 0, whole + 1).otherwise(whole).cast("double")
        return F.when((product - whole == 0.5) & (error != 0), side).otherwise(F.bround(product)) / scale
    return bind(value, rounded)


def plain(value: Column, places: int, sign_of: Column | None = None) -> Column:
    """Fixed-decimal text, half-even; a negative number that rounds to zero keeps its sign."""
    rounded = F.bround(value, places)
    text = F.format_string(f"%.{places}f", rounded)
    negative = (value if sign_of is None else sign_of) < 0
    return F.when(negative & (rounded == 0), F.concat(F.lit("-"), text)).otherwise(text)
