"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_FORMAT = "yyyy-MM-dd"


def parse_day(c: Column, fmt: str = DAY_FORMAT) -> Column:
    """Text to a date in one fixed format; other texts become NULL."""
    return F.try_to_date(c, fmt)


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def date_key(c: Column) -> Column:
    """Date as the integer YYYYMMDD."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")
