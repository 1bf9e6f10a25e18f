"""Queries over the cleaned rows: mirror aggregates and the snapshot tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.amounts import money_round, pct_change
from ..functions.text import contains
from ..operators.windows import previous_value
from ..schemas import RAW_COLUMNS

ISSUE_KEY = ("date", "market", "commodity", "unit", "pricetype")


def _exact(c: Column) -> Column:
    """Order by the decimal value, so that ties do not hang on the last bit of an average."""
    return c.cast("decimal(28,6)")


def _average(column: str) -> Column:
    return F.avg(F.col(column).cast("double"))


def _long_form(df: DataFrame, names: tuple[str, str], values: dict[str, Column]) -> DataFrame:
    label, value = names
    pairs = [F.struct(F.lit(k).alias(label), v.alias(value)) for k, v in values.items()]
    return df.select(F.inline(F.array(*pairs)))


def mirrored(df: DataFrame) -> DataFrame:
    """The same rows under upper-case column names."""
    return df.toDF(*[c.upper() for c in df.columns])


def distinct_commodities(df: DataFrame, text: str) -> DataFrame:
    return df.select("commodity").where(F.col("commodity").ilike(f"%{text}%")).distinct()


def county_commodity_year(df: DataFrame) -> DataFrame:
    return (
        df.where("is_valid_price")
        .groupBy("county", "commodity", "year")
        .agg(money_round(_average("price_kes")).alias("avg_price_kes"), F.count(F.lit(1)).alias("records"))
        .orderBy(F.col("year").desc_nulls_first(), F.col("county").asc_nulls_last(), F.col("commodity").asc_nulls_last())
    )


def month_over_month(df: DataFrame, commodity: str, label: str = "avg_maize_price") -> DataFrame:
    """Average per county and month with the change from unrounded averages."""
    monthly = (
        df.where(F.col("commodity").ilike(f"%{commodity}%") & F.col("is_valid_price"))
        .groupBy("year", "month", "county")
        .agg(_average("price_kes").alias("_mean"))
    )
    # One row per county and calendar month is left for the window.
    lagged = previous_value(monthly, "_mean", "_prev", order=("year", "month"), by=("county",))
    return lagged.select(
        "year",
        "month",
        "county",
        money_round(F.col("_mean")).alias(label),
        money_round(F.col("_prev")).alias("prev_price"),
        pct_change(F.col("_mean"), F.col("_prev")).alias("mom_pct_change"),
    ).orderBy(F.col("county").asc_nulls_last(), F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last())


def snapshot(raw: DataFrame) -> DataFrame:
    """Profile of the raw rows in long form (metric, value as text)."""
    groups = raw.groupBy("market", "commodity", "unit").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.count_if(F.col("admin1").isNull()).alias("no_admin1"),
        F.count_if(F.col("admin2").isNull()).alias("no_admin2"),
    )
    one = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.min("first").alias("date_min"),
        F.max("last").alias("date_max"),
        F.count_distinct("market").alias("markets"),
        F.count_distinct("commodity").alias("commodities"),
        F.count_distinct("unit").alias("distinct_units"),
        F.coalesce(F.sum("no_admin1"), F.lit(0)).alias("missing_admin1"),
        F.coalesce(F.sum("no_admin2"), F.lit(0)).alias("missing_admin2"),
    )
    columns = len([c for c in RAW_COLUMNS if c in raw.columns])
    values = {c: F.col(c).cast("string") for c in one.columns}
    return _long_form(one, ("metric", "value"), {**values, "columns": F.lit(str(columns))})


def issues(cleaned: DataFrame, keys: Sequence[str] = ISSUE_KEY) -> DataFrame:
    """Counts of what is wrong with the cleaned rows in long form, in one pass grouped by key."""
    groups = cleaned.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("county").isNull()).alias("county"),
        F.count_if(F.col("district").isNull()).alias("district"),
        F.count_if(F.col("price_kes").isNull()).alias("price"),
        F.count_if(~F.col("is_valid_price")).alias("invalid"),
    )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    one = groups.agg(
        total(F.col("county")).alias("rows_with_missing_county"),
        total(F.col("district")).alias("rows_with_missing_district"),
        total(F.col("price")).alias("rows_with_missing_price_kes"),
        total(F.col("invalid")).alias("rows_flagged_invalid"),
        total(F.col("n") - 1).alias("duplicate_business_keys"),
    )
    return _long_form(one, ("issue", "value"), {c: F.col(c) for c in one.columns})


def units_per_commodity(cleaned: DataFrame, limit: int = 10) -> DataFrame:
    name = "distinct_units_for_commodity"
    return (
        cleaned.where(F.col("commodity").isNotNull())
        .groupBy("commodity")
        .agg(F.count_distinct("unit").alias(name))
        .orderBy(F.col(name).desc_nulls_last(), F.col("commodity").asc_nulls_last())
        .limit(limit)
    )


def latest_cleaned(cleaned: DataFrame, market: str, limit: int = 15) -> DataFrame:
    columns = ["date", "market", "commodity", "unit", "price_kes", "currency"]
    return (
        cleaned.where(contains(F.col("market"), market))
        .select(*columns)
        .orderBy(
            F.col("date").desc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in ("commodity", "market", "unit", "price_kes", "currency")],
        )
        .limit(limit)
    )


def commodity_unit_prices(cleaned: DataFrame, limit: int = 15) -> DataFrame:
    """Price per unit of weight by commodity, dearest first."""
    c = "price_per_kg"
    return (
        cleaned.where(F.col(c).isNotNull() & F.col("commodity").isNotNull())
        .groupBy("commodity")
        .agg(_average(c).alias("mean"), F.min(c).alias("low"), F.max(c).alias("high"), F.count(c).alias("observations"))
        .orderBy(_exact(F.col("mean")).desc_nulls_last(), F.col("commodity").asc_nulls_last())
        .limit(limit)
        .select(
            "commodity",
            money_round(F.col("mean")).alias("avg_price_per_kg"),
            money_round(F.col("low")).alias("min_price_per_kg"),
            money_round(F.col("high")).alias("max_price_per_kg"),
            "observations",
        )
    )


def county_year_prices(cleaned: DataFrame, at_least: int = 5, limit: int = 20) -> DataFrame:
    """Price per unit of weight by county and year; a missing county is a group of its own."""
    c = "price_per_kg"
    return (
        cleaned.where(F.col(c).isNotNull())
        .groupBy("county", "year")
        .agg(_average(c).alias("mean"), F.count(c).alias("records"))
        .where(F.col("records") >= at_least)
        .orderBy(
            F.col("year").desc_nulls_last(), _exact(F.col("mean")).desc_nulls_last(), F.col("county").asc_nulls_last()
        )
        .limit(limit)
        .select("county", "year", money_round(F.col("mean")).alias("avg_price_per_kg"), "records")
    )


def yearly_trend(cleaned: DataFrame, commodity: str, last: int = 12) -> DataFrame:
    """Yearly price per unit of weight with the change over the year before, from unrounded averages."""
    c = "price_per_kg"
    yearly = (
        cleaned.where(contains(F.col("commodity"), commodity) & F.col(c).isNotNull() & F.col("year").isNotNull())
        .groupBy("year")
        .agg(_average(c).alias("mean"), F.count(c).alias("observations"))
    )
    lagged = previous_value(yearly, "mean", "_prev", order=("year",))
    return (
        lagged.orderBy(F.col("year").desc())
        .limit(last)
        .select(
            "year",
            money_round(F.col("mean")).alias("avg_price_per_kg"),
            "observations",
            money_round(F.col("_prev")).alias("prev_year_price_per_kg"),
            pct_change(F.col("mean"), F.col("_prev")).alias("yoy_pct_change"),
        )
        .orderBy("year")
    )


def valid_counts(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("is_valid_price").agg(F.count(F.lit(1)).alias("records"))
