"""Star schema: date, market and commodity dimensions and the price fact."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.dates import date_key
from ..functions.keys import hash_key, match_columns, row_fingerprint
from ..schemas import COMMODITY_KEY, FACT_KEY, MARKET_KEY
from .matching import lookup, too_large_to_broadcast, unseen


def _calendar(days: DataFrame) -> DataFrame:
    """One row per date of ``days(full_date)`` with its parts."""
    d = F.col("full_date")
    first = (F.month(d) == 1) & (F.dayofmonth(d) == 1)
    last = (F.month(d) == 12) & (F.dayofmonth(d) == 31)
    return days.select(
        date_key(d).alias("date_id"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        first.alias("is_year_start"),
        last.alias("is_year_end"),
    )


def dim_date(spark: SparkSession, start: str = "2006-01-01", end: str = "2026-12-31") -> DataFrame:
    """Every day from ``start`` to ``end``."""
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return _calendar(spark.range(1).select(F.explode(span).alias("full_date")))


def dim_date_of(df: DataFrame, date: str) -> DataFrame:
    """Every day from the first to the last date in ``df``."""
    span = F.sequence(F.min(date), F.max(date))
    return _calendar(df.where(F.col(date).isNotNull()).agg(span.alias("days")).select(F.explode("days").alias("full_date")))


def _first_per_key(rows: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """The first row per key; ``order`` names all other columns. ``row_number() = 1`` keeps a row per key and task before the shuffle."""
    ordered = [F.col(c).asc_nulls_last() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordered))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dim_market(staged: DataFrame) -> DataFrame:
    """One row per (market, district, county); the lowest source id decides the other attributes."""
    rows = staged.where(F.col("market").isNotNull()).select(
        F.col("market").alias("market_name"), "district", "county", "source_market_id", "latitude", "longitude"
    )
    picked = _first_per_key(rows, MARKET_KEY, ("source_market_id", "latitude", "longitude"))
    return picked.select(hash_key(*[F.col(k) for k in MARKET_KEY]).alias("market_id"), *rows.columns)


def dim_commodity(staged: DataFrame) -> DataFrame:
    """One row per (commodity, unit); the lowest source id decides the other attributes."""
    rows = staged.where(F.col("commodity").isNotNull()).select(
        F.col("commodity").alias("commodity_name"), "category", "unit", "source_commodity_id"
    )
    picked = _first_per_key(rows, COMMODITY_KEY, ("source_commodity_id", "category"))
    return picked.select(hash_key(*[F.col(k) for k in COMMODITY_KEY]).alias("commodity_id"), *rows.columns)


def new_members(candidates: DataFrame, existing: DataFrame, key: Iterable[str]) -> DataFrame:
    """Insert-if-absent: the first version of a member wins and is never changed."""
    return unseen(candidates, existing, key)


def free_keys(fresh: DataFrame, held: DataFrame, key: Iterable[str], surrogate: str, rounds: int = 20) -> DataFrame:
    """``fresh`` members with a surrogate key that neither ``held`` nor another of them has.

    Where two members hash alike, the first by its business key keeps the number and the others take the next of their
    own sequence of salted hashes. Both sides should be stored: every round reads them.
    """
    key = list(key)
    text = row_fingerprint(*[F.col(k) for k in key])
    keyed = fresh.withColumn("_salt", F.lit(0))
    for _ in range(rounds):
        taken = held.select(F.col(surrogate).alias("_taken"))
        place = F.row_number().over(Window.partitionBy(surrogate).orderBy("_salt", text))
        # A number shared by many members at once is many equal hashes; a window per number holds those few.
        marked = keyed.withColumn("_place", place).join(taken, F.col(surrogate) == F.col("_taken"), "left")
        again = (F.col("_place") > 1) | F.col("_taken").isNotNull()
        if marked.where(again).isEmpty():
            return keyed.drop("_salt")
        salted = hash_key(*[F.col(k) for k in key], F.col("_salt") + 1)
        keyed = marked.select(
            *[F.when(again, salted).otherwise(F.col(c)).alias(c) if c == surrogate else F.col(c) for c in fresh.columns],
            F.when(again, F.col("_salt") + 1).otherwise(F.col("_salt")).alias("_salt"),
        )
    raise ValueError(f"no free {surrogate} after {rounds} rounds")


def facts(
    staged: DataFrame,
    dates: DataFrame,
    markets: DataFrame,
    commodities: DataFrame,
    existing: DataFrame | None = None,
    broadcast_dates: bool = False,
) -> DataFrame:
    """Valid staged prices with their dimension keys, one per fact key, without those in ``existing``.

    De-duplication and the comparison with existing facts use the same NULL-free key columns, so
    they share one shuffle. Set ``broadcast_dates`` only for a date table of checked size.
    """
    rows = staged.where("is_valid_price")
    keyed = lookup(rows, dates, {"price_date": "full_date"}, "date_id", broadcast_dates)
    members = [
        (markets, {"market": "market_name", "district": "district", "county": "county"}, "market_id"),
        (commodities, {"commodity": "commodity_name", "unit": "unit"}, "commodity_id"),
    ]
    # Large dimensions last: the texts of the others are not in their shuffles.
    for member in sorted(members, key=lambda m: too_large_to_broadcast(m[0])):
        keyed = lookup(keyed, *member)
    keyed = keyed.select(*FACT_KEY, "price_kes", "price_usd", "price_per_kg", "is_valid_price")
    names = [*FACT_KEY]
    if existing is not None:
        keyed, names = match_columns(keyed, ("pricetype",))
        names = [*FACT_KEY[:3], *names]
    order = [F.col(c).desc_nulls_last() for c in ("price_kes", "price_usd", "price_per_kg")]
    rank = F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    keyed = keyed.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    if existing is not None:
        seen, _ = match_columns(existing.select(*FACT_KEY), ("pricetype",))
        keyed = keyed.join(seen.select(*names).distinct(), names, "left_anti")
        keyed = keyed.drop(*names[3:])
    return keyed


def with_fact_id(rows: DataFrame) -> DataFrame:
    """Add the fact's surrogate key on read: 128 bits, since 60 would collide at 10^12 rows."""
    return rows.withColumn("fact_id", row_fingerprint(*[F.col(k) for k in FACT_KEY]))
