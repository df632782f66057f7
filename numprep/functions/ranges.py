"""Range expressions. A missing bound is ``None`` and adds nothing to the plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(number: Column, low: float | None, high: float | None) -> Column:
    """Clamp to ``[low, high]``; NULL stays NULL, which ``greatest``/``least`` would turn into the bound.

    Bounds the wrong way round, as data-driven bounds can be, are taken in ascending order.
    """
    if low is not None and high is not None and low > high:
        low, high = high, low
    if low is None and high is None:
        return number
    if low is None:
        return F.when(number > high, F.lit(high)).otherwise(number)
    clipped = F.when(number < low, F.lit(low))
    if high is not None:
        clipped = clipped.when(number > high, F.lit(high))
    return clipped.otherwise(number)


def outside(number: Column, low: float | None, high: float | None) -> Column | None:
    """Condition for a value beyond its bounds, or ``None`` if there are no bounds to break."""
    if low is None and high is None:
        return None
    if low is None:
        return number > high
    if high is None:
        return number < low
    return (number < low) | (number > high)
