"""Analytical queries over the raw layer: dates and prices typed, nothing else changed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.amounts import money_round, parse_amount, pct_change
from ..functions.dates import month_start, parse_day
from ..operators.windows import previous_value


def raw_typed(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "date": parse_day(F.col("date")),
            "price": parse_amount(F.col("price")),
            "usdprice": parse_amount(F.col("usdprice")),
        }
    )


def _priced(df: DataFrame) -> DataFrame:
    return df.where(F.col("price").isNotNull())


def _average(column: str = "price") -> Column:
    return money_round(F.avg(F.col(column).cast("double")))


def latest_prices(raw: DataFrame, market: str, limit: int = 50) -> DataFrame:
    """Newest prices of the markets whose name contains ``market``."""
    columns = ["date", "market", "commodity", "unit", "price", "currency"]
    return (
        _priced(raw)
        .where(F.col("market").ilike(f"%{market}%"))
        .select(*columns)
        .orderBy(
            F.col("date").desc_nulls_first(),
            F.col("commodity").asc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in ("market", "unit", "price", "currency")],
        )
        .limit(limit)
    )


def commodity_stats(raw: DataFrame) -> DataFrame:
    grouped = _priced(raw).groupBy("commodity", "unit", "currency")
    return grouped.agg(
        _average().alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count(F.lit(1)).alias("observations"),
    ).orderBy(F.col("avg_price").desc_nulls_first())


def wide_commodities(raw: DataFrame, more_than: int = 10) -> DataFrame:
    """Commodities traded in more than ``more_than`` markets."""
    grouped = _priced(raw).groupBy("commodity")
    return (
        grouped.agg(F.count_distinct("market").alias("market_count"), _average().alias("avg_price"))
        .where(F.col("market_count") > more_than)
        .orderBy(F.col("market_count").desc_nulls_first())
    )


def county_year(raw: DataFrame, at_least: int = 5) -> DataFrame:
    rows = _priced(raw).where(F.col("admin1").isNotNull())
    return (
        rows.groupBy(F.col("admin1").alias("county"), F.year("date").alias("year"))
        .agg(_average().alias("avg_price"), F.count(F.lit(1)).alias("records"))
        .where(F.col("records") >= at_least)
        .orderBy(F.col("county").asc_nulls_last(), F.col("year").asc_nulls_last())
    )


def recent_monthly(raw: DataFrame, as_of: date | None = None, months: int = 12) -> DataFrame:
    """Monthly averages of the months before ``as_of`` (default: today)."""
    end = F.lit(as_of) if as_of else F.current_date()
    rows = _priced(raw).where(F.col("date") >= F.add_months(end, -months))
    return (
        rows.groupBy(month_start(F.col("date")).alias("month"), "commodity", "market")
        .agg(_average().alias("avg_monthly_price"))
        .orderBy(F.col("month").desc_nulls_first(), F.col("commodity").asc_nulls_last())
    )


def year_over_year(raw: DataFrame, commodity: str) -> DataFrame:
    """Yearly average with the change over the year before that has data, from rounded averages."""
    rows = _priced(raw).where(F.col("commodity").ilike(f"%{commodity}%"))
    yearly = rows.groupBy(F.year("date").alias("year")).agg(
        _average().alias("avg_price"), F.count(F.lit(1)).alias("num_records")
    )
    # One row per calendar year is left, so the unpartitioned window is small at any input size.
    lagged = previous_value(yearly, "avg_price", "prev_year_price", order=("year",))
    change = pct_change(F.col("avg_price"), F.col("prev_year_price"))
    return lagged.withColumn("yoy_pct_change", change).orderBy(F.col("year").asc_nulls_last())


def volatility(raw: DataFrame, at_least: int = 20, limit: int = 20) -> DataFrame:
    """Commodities by coefficient of variation."""
    price = F.col("price").cast("double")
    grouped = _priced(raw).groupBy("commodity").agg(
        F.avg(price).alias("mean"), F.stddev_samp(price).alias("spread"), F.count(F.lit(1)).alias("observations")
    )
    variation = money_round(F.col("spread") / F.nullif(F.col("mean"), F.lit(0.0)) * 100)
    return (
        grouped.where(F.col("observations") >= at_least)
        .select(
            "commodity",
            money_round(F.col("mean")).alias("avg_price"),
            money_round(F.col("spread")).alias("price_stddev"),
            variation.alias("coefficient_of_variation_pct"),
            "observations",
        )
        .orderBy(F.col("coefficient_of_variation_pct").desc_nulls_first(), F.col("commodity").asc_nulls_last())
        .limit(limit)
    )


def profile(raw: DataFrame) -> DataFrame:
    """Row, null and distinct counts and the date span, in one row.

    Rows are first counted per (market, commodity, county): the three distinct counts then run over
    those few groups and not over an expansion of every row.
    """
    n = F.count(F.lit(1))
    groups = raw.groupBy("market", "commodity", "admin1").agg(
        n.alias("n"),
        F.count_if(F.col("price").isNull()).alias("no_price"),
        F.count_if(F.col("date").isNull()).alias("no_date"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
    )

    def total(column: str, where: Column | None = None) -> Column:
        value = F.col(column) if where is None else F.when(where, F.col(column))
        return F.coalesce(F.sum(value), F.lit(0))

    return groups.agg(
        total("n").alias("total_rows"),
        total("no_price").alias("missing_price"),
        total("n", F.col("market").isNull()).alias("missing_market"),
        total("n", F.col("commodity").isNull()).alias("missing_commodity"),
        total("no_date").alias("missing_date"),
        F.count_distinct("market").alias("unique_markets"),
        F.count_distinct("commodity").alias("unique_commodities"),
        F.count_distinct("admin1").alias("unique_counties"),
        F.min("first").alias("earliest_date"),
        F.max("last").alias("latest_date"),
    )
