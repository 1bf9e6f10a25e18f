"""Staging shape, the valid-row view, and the monthly and trend marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.amounts import money_round, pct_change
from ..functions.dates import month_start
from ..operators.quality import split_rejects
from ..operators.windows import previous_value, previous_value_split
from ..schemas import MONTHLY_KEY, PRICE, PRICE_COLUMNS, STAGING_REQUIRED, STAGING_TABLE

# What a missing county, district and category is called in the view.
VIEW_DEFAULTS = {"county": "Unknown", "district": "Unknown", "category": "Uncategorized"}
# The view's columns and which rows it shows.
VIEW_COLUMNS = (
    "date", "year", "month", "county", "district", "market", "category", "commodity", "unit",
    "pricetype", "currency", "price_kes", "price_usd", "price_per_kg", "is_valid_price",
)
VIEW_FILTER = (
    "is_valid_price AND price_date IS NOT NULL AND market IS NOT NULL AND commodity IS NOT NULL"
)


def staged(cleaned: DataFrame, carried: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Cleaned rows in staging shape with the ``carried`` columns, split into accepted rows and rejects."""
    known = [*[f.name for f in STAGING_TABLE.fields if f.name != "loaded_at"], *carried]
    renamed = cleaned.withColumnRenamed("date", "price_date")
    shaped = renamed.select(*[c for c in known if c in renamed.columns])
    prices = {c: PRICE for c in (*PRICE_COLUMNS, "price_per_kg") if c in shaped.columns}
    return split_rejects(shaped, STAGING_REQUIRED, prices)


def view_expressions(held: Sequence[str] | None = None) -> list[str]:
    """The view's select list, for a DataFrame and for ``CREATE VIEW`` alike; with ``held``, of the columns held alone."""
    source = {"date": "price_date"}
    return [
        f"coalesce({c}, '{VIEW_DEFAULTS[c]}') AS {c}" if c in VIEW_DEFAULTS else f"{source.get(c, c)} AS {c}"
        for c in VIEW_COLUMNS
        if held is None or source.get(c, c) in held
    ]


def stg_view(staging: DataFrame) -> DataFrame:
    """The valid rows. Staging rows that were stored with some of their columns give a view with those."""
    return staging.where(VIEW_FILTER).selectExpr(*view_expressions(staging.columns))


def with_month_start(view: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first day of the month, where ``keys`` ask for it and the rows do not have it."""
    missing = "month_start" in keys and "month_start" not in view.columns
    return view.withColumn("month_start", month_start(F.col("date"))) if missing else view


def mart_monthly(
    view: DataFrame,
    keys: Sequence[str] = MONTHLY_KEY,
    prices: Sequence[str] = ("price_kes", "price_usd", "price_per_kg"),
    spread_of: str = "price_kes",
    place: str = "market",
) -> DataFrame:
    """Average prices, spread and counts per group; any dated, priced table with these columns works."""
    spread = F.col(spread_of).cast("double")
    measures = [money_round(F.avg(F.col(p).cast("double"))).alias(f"avg_{p}") for p in prices]
    measures += [
        money_round(F.min(spread_of)).alias(f"min_{spread_of}"),
        money_round(F.max(spread_of)).alias(f"max_{spread_of}"),
        money_round(F.stddev_samp(spread)).alias(f"stddev_{spread_of}"),
        F.count(F.lit(1)).alias("num_observations"),
        F.count_distinct(place).alias(f"num_{place}s"),
    ]
    return with_month_start(view, keys).groupBy(*keys).agg(*measures)


def mart_trend(
    monthly: DataFrame,
    pattern: str = "%maize%",
    price: str = "avg_price_kes",
    label: str = "maize_price_kes",
    by: Sequence[str] = ("county",),
    per_series: bool = False,
) -> DataFrame:
    """Monthly price of the matching commodities with the change over the row before.

    By county alone, the row before may be another commodity or unit of the same month; ties are
    ordered by commodity and unit. ``per_series`` compares each county, commodity and unit with itself.
    """
    period, item = ("year", "month"), ("commodity", "unit")
    rows = monthly.where(F.lower("commodity").like(pattern)).select(
        *period, "month_start", *by, *item, price, "num_observations"
    )
    if per_series:
        lagged = previous_value(rows, price, "_prev", order=period, by=(*by, *item))
    else:
        lagged = previous_value_split(rows, price, "_prev", by=by, bucket=period, order=item)
    return lagged.select(
        *period,
        "month_start",
        *by,
        *item,
        money_round(F.col(price)).alias(label),
        money_round(F.col("_prev")).alias("prev_month_price_kes"),
        pct_change(F.col(price), F.col("_prev")).alias("mom_pct_change"),
        "num_observations",
    )
