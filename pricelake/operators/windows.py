"""Previous-row operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F


def _ascending(columns: Iterable[str]):
    return [F.col(c).asc_nulls_last() for c in columns]


def previous_value(df: DataFrame, value: str, into: str, order: Iterable[str], by: Iterable[str] = ()) -> DataFrame:
    """``LAG(value)`` per ``by`` group. For groups of bounded size: one row per period of a calendar."""
    window = Window.partitionBy(*by).orderBy(*_ascending(order))
    return df.withColumn(into, F.lag(value).over(window))


def previous_value_split(
    df: DataFrame, value: str, into: str, by: Iterable[str], bucket: Iterable[str], order: Iterable[str]
) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY by ORDER BY bucket, order)`` without one task per ``by`` group.

    A group is cut into its buckets (periods). Inside a bucket the lag is an ordinary window; the
    first row of a bucket takes the last value of the bucket before, from a second window that sees
    one row per bucket. Both branches read the same shuffle.
    """
    by, bucket = list(by), list(bucket)
    inside = Window.partitionBy(*by, *bucket).orderBy(*_ascending(order))
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lagged = df.withColumns(
        {
            "_is_head": F.lag(F.lit(True)).over(inside).isNull(),
            into: F.lag(value).over(inside),
            "_last": F.last(value).over(whole),
        }
    )
    across = Window.partitionBy(*by).orderBy(*_ascending(bucket))
    heads = lagged.where("_is_head").withColumn(into, F.lag("_last").over(across))
    return lagged.where("NOT _is_head").unionByName(heads).drop("_is_head", "_last")
