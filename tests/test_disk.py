"""What the queries that store their stages shuffle, write and leave behind."""

import re
import time

import pytest

from conftest import SAMPLE
from pricelake import queries
from pricelake.operators import matching, star
from pricelake.queries import MONTHLY_INPUT, STAR_INPUT, Inputs, run
from pricelake.scratch import CLEANUP, Scratch
from pricelake.sources import sample_tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def stored(monkeypatch):
    """Name and columns of every table stored."""
    tables = {}
    store = Scratch.store
    monkeypatch.setattr(Scratch, "store", lambda self, df, name: tables.setdefault(name, df.columns) and store(self, df, name))
    return tables


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = disk.getAllFiles().mkString("\n").splitlines()
    return {n for n in names if re.search(r"/shuffle_\d+_\d+_\d+\.data", n)}


def test_stored_tables_leave_no_shuffle_files(spark):
    setting, before = spark.conf.get(CLEANUP, None), shuffle_files(spark)
    with Scratch(spark) as scratch:
        kept = scratch.store(spark.range(1000).repartition(7, "id"), "t")
        until = time.time() + 10
        while shuffle_files(spark) - before and time.time() < until:
            time.sleep(0.1)
        assert not shuffle_files(spark) - before
        assert kept.count() == 1000 and spark.conf.get(CLEANUP, None) == setting


def test_parts_too_many_to_broadcast_are_met_by_one_narrow_shuffle(spark, no_broadcast):
    text = plan(sample_tables.observations(spark, SAMPLE))
    assert "REBALANCE" not in text and text.count("Exchange hashpartitioning(l_partkey#") == 1
    assert text.index("SortMergeJoin [l_suppkey#") < text.index("SortMergeJoin [l_partkey#")  # the upper join is the later one


def test_observations_are_the_same_with_and_without_broadcast(spark):
    small = sample_tables.observations(spark, SAMPLE).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = sample_tables.observations(spark, SAMPLE).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(str, small)) == sorted(map(str, large)) and small


@pytest.mark.parametrize(
    "name, columns",
    [
        ("mart_monthly_merged", MONTHLY_INPUT), ("test_accepted_range", MONTHLY_INPUT), ("test_not_null", MONTHLY_INPUT),
        ("fact_incremental", STAR_INPUT), ("load_fact", STAR_INPUT), ("broken_relationship", STAR_INPUT), ("test_relationship", STAR_INPUT),
        ("tests_by_year", STAR_INPUT),
    ],
)
def test_staged_rows_are_stored_with_the_columns_that_are_read(spark, stored, name, columns):
    run(name, spark, SAMPLE)
    assert stored["staged"] == [*columns]


def test_staging_incremental_stores_what_it_shows(spark, stored):
    shown = run("staging_incremental", spark, SAMPLE).columns
    assert {*stored["staged"]} == {*shown} - {"load_no"}


def test_facts_read_once_are_not_stored(spark, stored):
    run("load_fact", spark, SAMPLE)
    assert "facts" not in stored and "dates" in stored


def test_staged_rows_are_dropped_when_only_the_star_schema_is_read(spark):
    x = Inputs(spark, SAMPLE).keep(*STAR_INPUT)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{x.scratch.root}/staged")
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    x.source
    assert there.exists(path)
    x.only_star()
    assert not there.exists(path) and x.facts.count() and x.dates.count() and x.markets.count()


def test_tests_by_year_clean_the_texts_once(spark, monkeypatch):
    calls = []
    clean = queries.cleaning.clean_values
    monkeypatch.setattr(queries.cleaning, "clean_values", lambda *a, **k: calls.append(1) or clean(*a, **k))
    run("tests_by_year", spark, SAMPLE)
    assert len(calls) == 1


STAGED = (
    "price_date date, market string, district string, county string, source_market_id int, latitude decimal(10,6),"
    " longitude decimal(10,6), commodity string, category string, unit string, source_commodity_id int,"
    " pricetype string, price_kes decimal(12,4), price_usd decimal(12,4), price_per_kg decimal(12,4), is_valid_price boolean"
)


def test_members_need_one_shuffle(spark):
    rows = spark.createDataFrame([], STAGED)
    for dimension in (star.dim_market(rows), star.dim_commodity(rows)):
        assert plan(dimension).count("Exchange hashpartitioning") == 1


def test_first_member_is_picked_among_repeats_and_nulls(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', 2, 'x'), ('a', 1, NULL), ('a', 1, NULL), ('a', 1, 'z'), ('a', NULL, 'b'), (NULL, 3, 'n') AS t(k, o, v)")
    assert sorted(map(str, star._first_per_key(rows, ("k",), ("o", "v")).collect())) == ["Row(k='a', o=1, v='z')", "Row(k=None, o=3, v='n')"]


def test_large_dimensions_are_looked_up_last(spark):
    rows = spark.createDataFrame([], STAGED)
    markets, commodities = star.dim_market(rows), star.dim_commodity(rows)
    with Scratch(spark) as scratch:
        small = scratch.store(commodities, "small")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
        try:
            assert matching.too_large_to_broadcast(spark.range(10**9)) and not matching.too_large_to_broadcast(small)
            big = markets.crossJoin(spark.range(10**9).select("id").withColumnRenamed("id", "_n")).drop("_n")
            text = plan(star.facts(rows, star.dim_date(spark), big, small))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.index("coalesce(market#") < text.index("coalesce(commodity#")  # the upper join is the later one


def test_unseen_rows_are_shuffled_without_copies_of_their_keys(spark, no_broadcast):
    schema = "day date, a string, v int"
    incoming = spark.createDataFrame([(None, "x", 1), (None, None, 2), (None, "", 3)], schema)
    got = matching.unseen(incoming, spark.createDataFrame([(None, None, 9)], schema), ["day", "a"])
    assert got.columns == ["day", "a", "v"] and got.dtypes == incoming.dtypes
    assert sorted(map(tuple, got.collect())) == [(None, "", 3), (None, "x", 1)]
    lines = plan(got).splitlines()
    left = next(line for k, line in enumerate(lines) if "Project [" in line and "Exchange" in lines[k - 1] and "v#" in line)
    assert not re.search(r"[\[ ](day|a)#\d+[,\]]", left), left
