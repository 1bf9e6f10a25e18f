"""Null-safe key matching: rows not loaded yet, and lookups in a dimension."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import match_columns, match_value

log = logging.getLogger("pricelake.matching")

# A broadcast set of days must stay a small table: a thousand years.
MAX_BROADCAST_DAYS = 366_000


def null_safe(pairs: Iterable[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a & b, (left.eqNullSafe(right) for left, right in pairs))


def unseen(incoming: DataFrame, existing: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing``; NULL key parts match each other.

    Existing keys are made distinct first, on the same hash partitioning as the join, so a key that
    is repeated there cannot grow one task. The incoming rows go through the join with the NULL-free copies in place of
    their keys, not with both.
    """
    keys = list(keys)
    absent = [k for k in keys if k not in incoming.columns or k not in existing.columns]
    if absent:
        log.warning("key columns %s are absent: all rows count as unseen", ", ".join(absent))
        return incoming
    left, names = match_columns(incoming, keys)
    right, _ = match_columns(existing.select(*keys), keys)
    fresh = left.drop(*keys).join(right.select(*names).distinct(), names, "left_anti")
    return fresh.select(*[match_value(c) if c in keys else F.col(f"`{c}`") for c in incoming.columns])


def dates_of(rows: DataFrame, date: str) -> DataFrame:
    """``day``: the distinct dates of ``rows``, NULL included; as many as the calendar has at most."""
    return rows.select(F.col(date).alias("day")).distinct()


def on_dates(existing: DataFrame, days: DataFrame, date: str, year: str | None = None) -> DataFrame:
    """Limit ``existing`` to the ``days`` (see ``dates_of``) before keys are compared.

    Right because the date is part of the key. With ``year``, the name of the partition column, only the years that occur
    in ``days`` are read: a stray date of another century costs its own year, not all years between.
    """
    if year:
        years = [r[0] for r in days.select(F.year("day")).distinct().collect()]  # as many as the calendar has
        wanted = F.col(year).isin([y for y in years if y is not None])
        existing = existing.where(wanted | F.col(year).isNull() if None in years else wanted)
    few = days.count() <= MAX_BROADCAST_DAYS
    side = F.broadcast(days) if few else days
    return existing.join(side, existing[date].eqNullSafe(side["day"]), "left_semi")


def too_large_to_broadcast(df: DataFrame) -> bool:
    """Whether Spark's estimate of ``df`` is above the size up to which it broadcasts the side of a join."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > limit


def lookup(
    rows: DataFrame, dimension: DataFrame, on: Mapping[str, str], key: str, broadcast: bool = False
) -> DataFrame:
    """Inner null-safe join that adds the dimension's ``key``; ``on`` maps row to dimension columns.

    The dimension holds each business key once, so no row is multiplied. Without ``broadcast`` the
    choice is left to AQE: broadcast by measured size, else a shuffle join with skewed partitions split.
    """
    renamed = {f"_d_{d}": F.col(d) for d in on.values()}
    side = dimension.select(F.col(key), *[c.alias(n) for n, c in renamed.items()])
    if broadcast:
        side = F.broadcast(side)
    condition = null_safe((rows[r], side[f"_d_{d}"]) for r, d in on.items())
    return rows.join(side, condition, "inner").drop(*renamed)
