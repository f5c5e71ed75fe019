"""Column expressions (F1-F19) and the parsing of grids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.schema import WEIGHTS

#: Scores are whole numbers of this part of one, so that sums do not depend on their order.
UNIT = 1_000_000_000


def day(time: Column) -> Column:
    return F.substring(time, 1, 10)


def hour(time: Column) -> Column:
    return F.right(time, F.lit(2)).cast("int")


def days_before(date: Column, target: str) -> Column:
    return F.datediff(F.lit(target).cast("date"), date.cast("date"))


def hours_gap(days: Column, hour_of_day: Column) -> Column:
    """Hours from a row to the beginning of the target day; 1 at least."""
    return (days - 1) * 24 + (24 - hour_of_day)


def weight(behavior: Column, weights: dict[int, float] = WEIGHTS) -> Column:
    case = reduce(lambda c, x: c.when(behavior == x[0], F.lit(float(x[1]))), weights.items(), F)
    return case.otherwise(F.lit(0.0))


def decayed_units(behavior: Column, days: Column, decay: float, weights: dict[int, float] = WEIGHTS) -> Column:
    """weight * decay ** days, in units."""
    return F.floor(weight(behavior, weights) * F.pow(F.lit(float(decay)), days) * float(UNIT) + 0.5).cast("long")


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def finite(x: Column) -> Column:
    """Nulls, NaN, infinities, and texts that are no numbers become 0."""
    d = x.try_cast("double")
    return F.when(d.isNull() | F.isnan(d) | (F.abs(d) == float("inf")), F.lit(0.0)).otherwise(d)


def is_non_finite(x: Column) -> Column:
    d = x.try_cast("double")
    return d.isNull() | F.isnan(d) | (F.abs(d) == float("inf"))


def missing(x: Column) -> Column:
    """Null or empty."""
    return x.isNull() | (x == "")


def blend(first: Column, second: Column, share: float) -> Column:
    """(1 - w) a + w b, with w in [0, 1]."""
    w = min(max(share, 0.0), 1.0)
    return (1.0 - w) * first + w * second


def int_grid(text: str, allow_empty: bool = False) -> list[int]:
    """"10, 10,,20" is [10, 20]."""
    grid = sorted({int(x) for x in text.split(",") if x.strip()})
    if not grid and not allow_empty:
        raise ValueError("empty grid")
    if any(x <= 0 for x in grid):
        raise ValueError("a grid holds positive numbers")
    return grid
