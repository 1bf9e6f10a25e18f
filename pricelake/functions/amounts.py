"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import WIDE_PRICE


def parse_amount(c: Column, dtype: str = WIDE_PRICE) -> Column:
    """Text to a decimal; anything that is not a number becomes NULL (also NaN and inf)."""
    return c.try_cast(dtype)


def parse_integer(c: Column) -> Column:
    """Text to an integer, also where it went through a float (``186.0``); a fraction or too large a number gives NULL."""
    number = c.cast("string").try_cast("decimal(38,9)")
    return F.when(number == F.floor(number), number.try_cast("int"))


def money_round(c: Column, places: int = 2) -> Column:
    """Round half up on the decimal value, not on its binary neighbour; result is DOUBLE."""
    return F.round(c.cast("decimal(28,6)"), places).cast("double")


def pct_change(current: Column, previous: Column) -> Column:
    """Change over the previous value in percent; NULL without one or when it is zero."""
    return money_round((current - previous) / F.nullif(previous, F.lit(0.0)) * 100)


def banded(c: Column, steps: list[tuple[float | None, str]]) -> Column:
    """Label by threshold; ``steps`` ascend and the first may be open (None)."""
    label = F.lit(steps[0][1])
    for limit, name in steps[1:]:
        label = F.when(c >= limit, name).otherwise(label)
    return F.when(c.isNotNull(), label)
