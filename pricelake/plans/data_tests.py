"""The data tests of every load: columns, keys and relationships of staging, star schema and marts.

Tests of tables partitioned by year are counted per year. A load tests the years it touched and the small tables; the
counts of the other years are stored, and a test passes if all its years add up to nothing. Uniqueness may be tested year
by year because those keys hold a date.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import quality
from ..schemas import COMMODITY_KEY, FACT_KEY, MARKET_KEY, MONTHLY_KEY, STAGING_KEY
from ..sources import tables
from ..sources.tables import Layers

TEST_KEY = ("table_name", "test", "column_name")


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def staging_tests(staging: DataFrame, table: str = "staging", by: str | None = None) -> DataFrame:
    keys = [quality.not_null(c) for c in ("price_date", "market", "commodity")]
    return quality.column_tests(staging, table, [*keys, quality.not_null("price_kes", where=F.col("is_valid_price"))], by)


def view_tests(view: DataFrame, table: str = "view", by: str | None = None) -> DataFrame:
    filled = [quality.not_null(c) for c in ("date", "market", "commodity", "price_kes")]
    return quality.column_tests(view, table, [*filled, quality.accepted_range("price_kes", low=0, inclusive=False)], by)


def monthly_tests(monthly: DataFrame, table: str = "monthly", by: str | None = None) -> DataFrame:
    filled = [quality.not_null(c) for c in ("year", "month", "county", "commodity", "avg_price_kes", "num_observations")]
    ranges = [quality.accepted_range("avg_price_kes", low=0, inclusive=False), quality.accepted_values("month", range(1, 13))]
    return quality.column_tests(monthly, table, [*filled, *ranges], by)


def trend_tests(trend: DataFrame, table: str = "trend") -> DataFrame:
    return quality.column_tests(trend, table, [quality.not_null(c) for c in ("year", "county", "maize_price_kes")])


def dimension_tests(markets: DataFrame, commodities: DataFrame) -> DataFrame:
    return union([quality.unique(markets, "dim_market", MARKET_KEY), quality.unique(commodities, "dim_commodity", COMMODITY_KEY)])


def fact_tests(facts: DataFrame, dates: DataFrame, markets: DataFrame, commodities: DataFrame, by: str | None = None) -> DataFrame:
    """Unique keys of the facts, and a parent for every key of theirs."""
    return union([
        quality.unique(facts, "fact", FACT_KEY, by),
        quality.relationship(facts, "fact", "date_id", dates, "date_id", by),
        quality.relationship(facts, "fact", "market_id", markets, "market_id", by),
        quality.relationship(facts, "fact", "commodity_id", commodities, "commodity_id", by),
    ])


def star_tests(facts: DataFrame, dates: DataFrame, markets: DataFrame, commodities: DataFrame) -> DataFrame:
    return union([dimension_tests(markets, commodities), fact_tests(facts, dates, markets, commodities)])


def yearly(spark: SparkSession, layers: Layers, monthly: DataFrame, years: Iterable[int] | None = None, by: str | None = "year") -> DataFrame:
    """Tests of staging, view, monthly mart and facts, of the given ``years`` or all, counted by year or (``by=None``) in one."""
    years = None if years is None else sorted(years)
    read = lambda df: df if years is None else df.where(F.col("year").isin(years))
    staging, view, fact, monthly = read(spark.table(layers.staging)), read(spark.table(layers.view)), read(spark.table(layers.fact)), read(monthly)
    parents = [spark.table(t) for t in (layers.dim_date, layers.dim_market, layers.dim_commodity)]
    return union([
        staging_tests(staging, by=by),
        quality.unique(staging, "staging", STAGING_KEY, by),
        view_tests(view, by=by),
        monthly_tests(monthly, by=by),
        quality.unique(monthly, "monthly", MONTHLY_KEY, by),
        fact_tests(fact, *parents, by=by),
    ])


def published(spark: SparkSession, layers: Layers, monthly: DataFrame, trend: str) -> DataFrame:
    """All tests over the whole stored tables and the versions that are to be published."""
    dimensions = dimension_tests(spark.table(layers.dim_market), spark.table(layers.dim_commodity))
    return union([yearly(spark, layers, monthly, by=None), trend_tests(spark.table(trend)), dimensions])


def stored(spark: SparkSession, layers: Layers) -> DataFrame:
    """The last counts of every test and year."""
    last = F.max_by("violations", "tested_at").alias("violations")
    return spark.table(layers.tests).groupBy(*TEST_KEY, "year").agg(last)


def totals(counts: DataFrame) -> DataFrame:
    """One row per test from counts per test and year."""
    summed = counts.groupBy(*TEST_KEY).agg(F.sum("violations").alias("violations"))
    return summed.withColumn("passed", F.col("violations") == 0)


def refresh(spark: SparkSession, layers: Layers, monthly: DataFrame, trend: str, years: Iterable[int] | None) -> DataFrame:
    """Test the touched ``years`` and the small tables, store the counts, and return the totals over all years."""
    whole = union([trend_tests(spark.table(trend)), dimension_tests(spark.table(layers.dim_market), spark.table(layers.dim_commodity))])
    counts = yearly(spark, layers, monthly, years).unionByName(whole.withColumn("year", F.lit(None).cast("int")))
    # A year without rows, or without orphans, has no group; its earlier count must not stand.
    found = counts.groupBy(*TEST_KEY, "year").agg(F.sum("violations").alias("violations")).coalesce(1)
    before = stored(spark, layers)
    again = before if years is None else before.where(F.col("year").isin(sorted(years)) | F.col("year").isNull())
    cleared = again.withColumn("violations", F.lit(0).cast("long")).unionByName(found).groupBy(*TEST_KEY, "year").agg(F.sum("violations").alias("violations"))
    rows = [tuple(r) for r in cleared.collect()]  # tests times touched years
    schema = "table_name string, test string, column_name string, year int, violations long"
    tables.append_rows(spark.createDataFrame(rows, schema).coalesce(1), layers.tests, stamp="tested_at")
    return totals(stored(spark, layers))


def check(results: DataFrame) -> None:
    """Raise if any test found a violation; one row per test comes back."""
    broken = results.where("not passed").collect()
    if broken:
        raise quality.QualityError("; ".join(f"{r['table_name']}.{r['column_name']} {r['test']}: {r['violations']}" for r in broken))
