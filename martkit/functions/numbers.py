"""Rounding and order-independent averages."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..specs import MONEY


def round_half_even(x: Column, places: int) -> Column:
    """Round a double as numpy does: scale, round half to even, scale back."""
    scale = float(10 ** places)
    return F.rint(x.cast("double") * F.lit(scale)) / F.lit(scale)


def sql_round(x: Column, places: int) -> Column:
    """``ROUND(CAST(x AS NUMERIC), places)`` where NUMERIC has three places, returned as a double."""
    return F.round(x.cast("decimal(18,3)"), places).cast("double")


def money_sum(x: Column) -> Column:
    """Exact sum; an empty or all-NULL group sums to zero."""
    return F.coalesce(F.sum(x), F.lit(0).cast(MONEY))


def money_avg(x: Column) -> Column:
    """Mean of an exact decimal as a double: the sum is exact, so the result does not depend on row order."""
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))


def exact_avg(x: Column, places: int = 0) -> Column:
    """Mean of a value that carries at most ``places`` decimals, summed as a scaled long.

    Adding doubles gives a different last bit for every shuffle; adding longs does not.
    """
    scale = float(10 ** places)
    total = F.sum(F.rint(x.cast("double") * F.lit(scale)).cast("long"))
    return F.try_divide(total.cast("double"), F.count(x).cast("double") * F.lit(scale))


def close_to(a: Column, b: Column) -> Column:
    """Equality within numpy's default tolerances (absolute 1e-8, relative 1e-5)."""
    a, b = a.cast("double"), b.cast("double")
    return F.abs(a - b) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(b)
