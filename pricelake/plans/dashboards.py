"""Result sets behind the dashboard panels, from the marts and the dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.amounts import banded, money_round

# Lower limits of the price bands.
PRICE_BANDS = [(None, "green"), (100, "yellow"), (300, "red")]


def trend_lines(trend: DataFrame, start: date, end: date, price: str = "maize_price_kes") -> DataFrame:
    """time, metric, value for the months in the chosen range."""
    return (
        trend.where(F.col("month_start").between(F.lit(start), F.lit(end)))
        .select(F.col("month_start").alias("time"), F.col("county").alias("metric"), F.col(price).alias("value"))
        .orderBy("time", "metric")
    )


def average_by_commodity(monthly: DataFrame, limit: int = 15) -> DataFrame:
    """Mean of the monthly averages, each month counting the same."""
    c = F.col("avg_price_per_kg")
    return (
        monthly.where(c.isNotNull())
        .groupBy(F.col("commodity").alias("metric"))
        .agg(money_round(F.avg(c)).alias("value"))
        .orderBy(F.col("value").desc_nulls_first(), F.col("metric").asc_nulls_last())
        .limit(limit)
    )


def price_bands(averages: DataFrame) -> DataFrame:
    return averages.withColumn("band", banded(F.col("value"), PRICE_BANDS))


def total_records(monthly: DataFrame) -> DataFrame:
    return monthly.agg(F.sum("num_observations").alias("value"))


def unique_names(dimension: DataFrame, name: str) -> DataFrame:
    return dimension.agg(F.count_distinct(name).alias("value"))


def latest_months(monthly: DataFrame, limit: int = 200) -> DataFrame:
    order = [F.col(c).asc_nulls_last() for c in ("county", "commodity", "unit")]
    return (
        monthly.orderBy(F.col("month_start").desc_nulls_first(), *order)
        .limit(limit)
        .select("month_start", "county", "commodity", "avg_price_kes", "avg_price_per_kg", "num_observations")
    )
