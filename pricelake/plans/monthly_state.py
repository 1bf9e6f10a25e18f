"""The monthly mart from sums that can be merged: a load adds its own rows, and old rows are not read again.

The state of a group is exact, so the order of loads does not matter: counts, DECIMAL sums of prices and of squares, least and
greatest price, and the set of its places as one row per group and place. Averages and the spread are worked out from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.amounts import money_round
from ..schemas import MONTHLY_KEY, PRICE
from .marts import with_month_start

PRICES = ("price_kes", "price_usd", "price_per_kg")
SUM, SQUARES, PRECISE_COUNT = "decimal(38,4)", "decimal(38,8)", "decimal(12,0)"


def sums(view: DataFrame, keys: Sequence[str] = MONTHLY_KEY, prices: Sequence[str] = PRICES, spread_of: str = "price_kes") -> DataFrame:
    """Counts and sums per group."""
    x = F.col(spread_of).cast(PRICE)
    measures = [F.count(F.lit(1)).alias("rows")]
    for p in prices:
        measures += [F.count(p).alias(f"n_{p}"), F.sum(F.col(p).cast(PRICE)).cast(SUM).alias(f"sum_{p}")]
    measures += [F.sum(x * x).cast(SQUARES).alias("squares"), F.min(x).alias("least"), F.max(x).alias("greatest")]
    return with_month_start(view, keys).groupBy(*keys).agg(*measures)


def merged(parts: DataFrame, keys: Sequence[str] = MONTHLY_KEY) -> DataFrame:
    """One row per group from rows of ``sums`` of several parts."""
    measures = []
    for c in parts.columns:
        if c not in keys:
            put = {"least": F.min, "greatest": F.max}.get(c, F.sum)
            measures.append(put(c).cast(parts.schema[c].dataType).alias(c))
    return parts.groupBy(*keys).agg(*measures)


def places(view: DataFrame, keys: Sequence[str] = MONTHLY_KEY, place: str = "market") -> DataFrame:
    """One row per group and place."""
    return with_month_start(view, keys).where(F.col(place).isNotNull()).select(*keys, place).distinct()


def _deviation(n: Column, total: Column, squares: Column) -> Column:
    """Standard deviation of a sample. Squares are taken about the mean to four places in DECIMAL, where nothing cancels;
    what the rounded mean is off is small enough for DOUBLE."""
    count = n.cast(PRECISE_COUNT)
    mean = (total / count).cast(PRICE)
    about = (squares - F.lit(2) * mean * total.cast("decimal(24,4)") + count * (mean * mean)).cast("double")
    off = (total - count * mean).cast("double")
    return F.when(n > 1, F.sqrt(F.greatest((about - off * off / n) / (n - 1), F.lit(0.0))))


def mart(state: DataFrame, pairs: DataFrame, keys: Sequence[str] = MONTHLY_KEY, prices: Sequence[str] = PRICES, spread_of: str = "price_kes", place: str = "market") -> DataFrame:
    """The mart's rows from the state: ``state`` as from ``sums`` or ``merged``, ``pairs`` as from ``places``."""
    counted = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("places"))
    # Groups meet by grouping and not by a join: their key may hold NULL.
    both = state.withColumn("places", F.lit(0).cast("long")).unionByName(counted, allowMissingColumns=True)
    measures = [(F.max if c in ("least", "greatest") else F.sum)(c).cast(both.schema[c].dataType).alias(c) for c in both.columns if c not in keys]
    whole = both.groupBy(*keys).agg(*measures)
    averages = [money_round(F.col(f"sum_{p}").cast("double") / F.nullif(F.col(f"n_{p}"), F.lit(0))).alias(f"avg_{p}") for p in prices]
    return whole.select(
        *keys,
        *averages,
        money_round(F.col("least")).alias(f"min_{spread_of}"),
        money_round(F.col("greatest")).alias(f"max_{spread_of}"),
        money_round(_deviation(F.col(f"n_{spread_of}"), F.col(f"sum_{spread_of}"), F.col("squares"))).alias(f"stddev_{spread_of}"),
        F.col("rows").alias("num_observations"),
        F.col("places").alias(f"num_{place}s"),
    )
