"""Matching, previous-row and star-schema operators against brute force."""

import random
from datetime import date
from decimal import Decimal

from pyspark.sql import Window, functions as F

from pricelake.functions.amounts import banded, money_round, pct_change
from pricelake.functions.keys import hash_key
from pricelake.operators import matching, star, windows
from pricelake.plans import raw_queries


def test_unseen_takes_nulls_as_equal_and_keeps_separators_apart(spark):
    schema = "day date, a string, b string"
    incoming = spark.createDataFrame(
        [(None, "x|y", "z"), (None, "x", "y|z"), (None, None, None), (None, "", None)], schema
    )
    existing = spark.createDataFrame([(None, "x|y", "z"), (None, None, None), (None, None, None)], schema)
    left = matching.unseen(incoming, existing, ["day", "a", "b"]).collect()
    assert sorted(map(tuple, left)) == [(None, "", None), (None, "x", "y|z")]
    assert matching.unseen(incoming, existing.drop("b"), ["day", "a", "b"]).count() == 4


def test_between_dates(spark):
    old = spark.sql("SELECT explode(sequence(DATE'2020-01-01', DATE'2020-12-31')) AS d")
    new = spark.sql("SELECT explode(array(DATE'2020-03-01', DATE'2020-03-05')) AS d")
    assert matching.on_dates(old, matching.dates_of(new, "d"), "d").count() == 2
    assert matching.on_dates(old, matching.dates_of(new.limit(0), "d"), "d").count() == 0


def test_split_lag_equals_one_window(spark):
    rng = random.Random(7)
    rows = {(rng.choice(["hot", "hot", "b", None]), rng.randint(1, 6), rng.choice(["x", "y", "z", None])) for _ in range(200)}
    data = [(*r, None if rng.random() < 0.2 else rng.random()) for r in rows]
    df = spark.createDataFrame(data, "g string, month int, item string, v double")
    order = [F.col("month").asc_nulls_last(), F.col("item").asc_nulls_last()]
    expected = df.withColumn("prev", F.lag("v").over(Window.partitionBy("g").orderBy(*order)))
    got = windows.previous_value_split(df, "v", "prev", by=["g"], bucket=["month"], order=["item"])
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count()


def test_split_lag_keeps_the_big_group_out_of_the_plain_window(spark):
    df = spark.range(10).select(F.lit("hot").alias("g"), F.col("id").alias("m"), F.col("id").alias("v"), F.lit("x").alias("i"))
    got = windows.previous_value_split(df, "v", "prev", by=["g"], bucket=["m"], order=["i"])
    assert [r["prev"] for r in got.orderBy("m").collect()] == [None, *range(9)]


def test_year_over_year_compares_with_the_year_before_that_has_data(spark):
    raw = spark.sql("SELECT DATE'2010-05-01' AS date, 'x' AS commodity, 100.0 AS price UNION ALL SELECT DATE'2012-05-01', 'X', 150.0")
    got = raw_queries.year_over_year(raw, "x").collect()
    assert [(r["year"], r["prev_year_price"], r["yoy_pct_change"]) for r in got] == [(2010, None, None), (2012, 100.0, 50.0)]


def test_rounding_percent_and_bands(spark):
    df = spark.sql("SELECT 1.005D AS a, 0D AS zero, 300D AS high")
    row = df.select(
        money_round(F.col("a")), pct_change(F.col("a"), F.col("zero")), pct_change(F.col("high"), F.lit(200.0)),
        banded(F.col("high"), [(None, "green"), (100, "yellow"), (300, "red")]),
        banded(F.col("a"), [(None, "green"), (100, "yellow"), (300, "red")]),
        banded(F.lit(None).cast("double"), [(None, "green"), (100, "yellow")]),
    ).first()
    assert tuple(row) == (1.01, None, 50.0, "red", "green", None)


def test_hash_keys_differ_for_nulls_and_shifted_text(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a;", ""), (None, "a"), ("1:a", "b"), ("1", ":ab")], "x string, y string")
    keys = [r[0] for r in df.select(hash_key(F.col("x"), F.col("y"))).collect()]
    assert len(set(keys)) == 6 and all(0 <= k < 2**60 for k in keys)


STAGED = (
    "price_date date, market string, district string, county string, source_market_id int, latitude decimal(10,6),"
    " longitude decimal(10,6), commodity string, category string, unit string, source_commodity_id int,"
    " pricetype string, price_kes decimal(12,4), price_usd decimal(12,4), price_per_kg decimal(12,4), is_valid_price boolean"
)


def staged(spark, *rows):
    data = [
        (date.fromisoformat(d), m, None, c, i, Decimal(i), Decimal(i), "Maize", None, u, 1, t, Decimal(p), None, None, p > 0)
        for d, m, c, i, u, t, p in rows
    ]
    return spark.createDataFrame(data, STAGED)


def test_members_are_picked_by_the_lowest_source_id(spark):
    rows = staged(spark, ("2024-01-01", "A", None, 2, None, None, 1), ("2024-01-02", "A", None, 1, None, None, 1))
    member = star.dim_market(rows).collect()
    assert len(member) == 1 and member[0]["latitude"] == 1
    assert star.new_members(star.dim_market(rows), star.dim_market(rows), ("market_name", "district", "county")).count() == 0


def test_facts(spark):
    rows = staged(
        spark,
        ("2024-01-01", "A", None, 1, None, None, 1),
        ("2024-01-01", "A", None, 2, None, None, 5),
        ("2024-01-01", "A", "C", 1, "KG", "Retail", 2),
        ("1999-12-31", "A", None, 1, None, None, 3),
        ("2024-01-02", "A", None, 1, None, None, -4),
    )
    dims = star.dim_date(spark), star.dim_market(rows), star.dim_commodity(rows)
    facts = star.facts(rows, *dims)
    # The repeated key gives one fact, the old date and the invalid price give none.
    assert sorted((r["date_id"], int(r["price_kes"])) for r in facts.collect()) == [(20240101, 2), (20240101, 5)]
    assert star.facts(rows, *dims, existing=facts).count() == 0
    assert star.with_fact_id(facts).select("fact_id").distinct().count() == 2


def test_calendar(spark):
    days = star.dim_date(spark)
    assert days.count() == 7670
    last = days.where("date_id = 20241231").first()
    assert (last["quarter"], last["month_name"], last["is_year_end"], last["is_year_start"]) == (4, "December", True, False)


def test_dimension_lookup_broadcasts_only_when_told(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows, dim = spark.range(10).withColumnRenamed("id", "r"), spark.range(10).select(F.col("id").alias("d"), F.col("id").alias("key"))
        plans = [
            matching.lookup(rows, dim, {"r": "d"}, "key", broadcast=flag)._jdf.queryExecution().executedPlan().toString()
            for flag in (True, False)
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]
