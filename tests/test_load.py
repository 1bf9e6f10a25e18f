"""Files, tables and the load job on hand-made CSV files."""

import csv
import os
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pricelake.operators.matching import on_dates
from pricelake.operators.quality import QualityError
from pricelake.plans import load_job
from pricelake.plans.load_log import flatten_notes
from pricelake.schemas import RAW_COLUMNS
from pricelake.sources import files, jdbc, tables
from pricelake.sources.tables import Layers
from pricelake.streaming.file_load import load_new_files
from test_clean import BASE


def write_csv(path, *changes, header=RAW_COLUMNS):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        for change in changes:
            writer.writerow([{**BASE, **change}[c] for c in RAW_COLUMNS])
    return str(path)


def fresh(spark, prefix):
    layers = Layers(prefix)
    tables.reset_tables(spark, layers, reset=True)
    return layers


FIRST = [
    {},
    {"price": "950"},
    {"admin1": "", "unit": "NA", "pricetype": "", "market": "kibuye"},
    {"date": "2024-02-15", "price": "1800"},
    {"date": "not-a-date", "commodity": "beans"},
    {"market": "", "commodity": "rice"},
    {"price": "0", "commodity": "milk, \"fresh\""},
    {"date": "1999-12-31", "commodity": "old"},
]


def test_load_is_complete_and_repeatable(spark, tmp_path):
    layers = fresh(spark, "t1_")
    path = write_csv(tmp_path / "prices 1+2.csv", *FIRST)
    first = load_job.run_load(spark, path, layers, mirror=True)
    assert first["raw"] == 8
    assert (first["staging"], first["rejects"]) == (5, 2)
    assert (first["facts"], first["outside_dates"], first["mirror"]) == (4, 0, 7)  # the mirror holds rejected rows too
    assert spark.table(layers.raw).select("source_file").distinct().first()[0] == "prices 1+2.csv"
    staging = spark.table(layers.staging)
    kept = staging.where("commodity = 'Maize' AND market = 'Wakulima' AND month = 1").collect()
    assert [(int(r["price_kes"]), r["source_file"]) for r in kept] == [(950, "prices 1+2.csv")]
    assert staging.where("NOT is_valid_price").count() == 1
    assert {r["reason"] for r in spark.table(layers.rejects).collect()} == {
        "price_date is missing, year is missing, month is missing", "market is missing"
    }
    trend = spark.table(layers.trend).where("month = 2").first()
    assert (trend["prev_month_price_kes"], trend["maize_price_kes"]) == (950.0, 1800.0)
    # Sum of the mart's observations equals the valid rows of the view.
    assert spark.table(layers.monthly).agg(F.sum("num_observations")).first()[0] == spark.table(layers.view).count()

    before = {t: spark.table(t).count() for t in (layers.raw, layers.staging, layers.rejects, layers.fact, layers.dim_market)}
    again = load_job.run_load(spark, path, layers, mirror=True)
    assert (again["raw"], again["staging"], again["rejects"], again["facts"], again["mirror"]) == (0, 0, 0, 0, 0)
    assert set(again["dimensions"].values()) == {0}
    assert {t: spark.table(t).count() for t in before} == before


def test_two_loads_equal_one(spark, tmp_path):
    write_csv(tmp_path / "a.csv", *FIRST[:3])
    write_csv(tmp_path / "b.csv", *FIRST[3:], {"date": "2024-03-01", "market": "kibuye", "latitude": "9"})
    parts, whole = fresh(spark, "t2_"), fresh(spark, "t3_")
    for name in ("a.csv", "b.csv"):
        load_job.run_load(spark, str(tmp_path / name), parts)
    load_job.run_load(spark, str(tmp_path / "*.csv"), whole)
    for layer in ("raw", "rejects", "staging", "fact", "monthly", "trend"):
        one, two = (spark.table(getattr(x, layer)).drop("loaded_at", "row_seq", "load_id") for x in (parts, whole))
        assert one.exceptAll(two).count() == 0 and one.count() == two.count(), layer
    new = spark.table(parts.dim_market).where("market_name = 'Kibuye'")
    assert sorted(float(r["latitude"]) for r in new.collect()) == [1.0, 9.0]  # with and without a county


def test_equal_names_in_two_folders_are_two_files(spark, tmp_path):
    for year, changes in (("2023", [{"date": "2023-01-01"}, {"date": "2023-02-01"}]), ("2024", [{}, {"date": "2024-02-01"}, {"date": "2024-03-01"}])):
        (tmp_path / year).mkdir()
        write_csv(tmp_path / year / "prices.csv", *changes)
    whole, parts = fresh(spark, "t10_"), fresh(spark, "t11_")
    load_job.run_load(spark, str(tmp_path / "*" / "prices.csv"), whole)
    for year in ("2023", "2024"):
        load_job.run_load(spark, str(tmp_path / year / "prices.csv"), parts)
    for layers in (whole, parts):
        assert (spark.table(layers.raw).count(), spark.table(layers.fact).count()) == (5, 5)
        assert spark.table(layers.raw).groupBy("source_path").count().count() == 2
    assert load_job.run_load(spark, str(tmp_path / "*" / "prices.csv"), parts)["raw"] == 0
    assert spark.table(parts.raw).count() == 5 and spark.table(parts.raw).select("load_id").distinct().count() == 2


def test_dates_grow_with_the_rows(spark, tmp_path):
    path = write_csv(tmp_path / "x.csv", {}, {"date": "1999-05-01"}, {"date": "2031-07-01"})
    grown, fixed = fresh(spark, "t12_"), fresh(spark, "t13_")
    got = load_job.run_load(spark, path, grown)
    assert (got["facts"], got["outside_dates"]) == (3, 0)
    assert spark.table(grown.dim_date).agg(F.min("full_date"), F.max("full_date")).first()[:] == (date(1999, 1, 1), date(2031, 12, 31))
    got = load_job.run_load(spark, path, fixed, dates=("2006-01-01", "2026-12-31"))
    assert (got["facts"], got["outside_dates"]) == (1, 2)


def test_numbers_keep_their_value(spark, tmp_path):
    layers = fresh(spark, "t14_")
    rows = [{"market_id": "186.0", "commodity_id": "7.5"}, {"price": "150000000", "commodity": "gold"}]
    got = load_job.run_load(spark, write_csv(tmp_path / "x.csv", *rows), layers, mirror=True)
    assert (got["staging"], got["rejects"], got["mirror"]) == (1, 1, 2)
    kept = spark.table(layers.staging).first()
    assert (kept["source_market_id"], kept["source_commodity_id"]) == (186, None)
    refused = spark.table(layers.rejects).first()
    assert (float(refused["price_kes"]), refused["is_valid_price"]) == (1.5e8, True)
    assert refused["reason"].startswith("price_kes does not fit decimal(12,4)")
    assert spark.table(layers.metadata).select(F.variant_get("stats", "$.quality_notes", "string")).first()[0] == "[]"


def test_scratch_is_gone_after_a_load_and_one_stamp_holds(spark, tmp_path):
    layers, folder = fresh(spark, "t15_"), spark.conf.get("spark.checkpoint.dir")
    held = lambda: set(os.listdir(folder)) if os.path.exists(folder) else set()
    before = held()
    load_job.run_load(spark, write_csv(tmp_path / "x.csv", *FIRST), layers, mirror=True)
    assert held() <= before
    stamps = [r[0] for t in (layers.raw, layers.staging, layers.rejects, layers.fact, layers.metadata) for r in spark.table(t).select("loaded_at").distinct().collect()]
    stamps += [r[0] for r in spark.table(layers.mirror).select("LOADED_AT").distinct().collect()]
    assert len(set(stamps)) == 1
    stats = spark.table(layers.metadata).select(F.variant_get("stats", "$.cleaning.dates_failed", "int"), F.variant_get("stats", "$.checks[0].name", "string")).first()
    assert stats[:] == (1, "not_empty")


def test_a_broken_mart_is_not_published(spark, tmp_path, monkeypatch):
    layers = fresh(spark, "t16_")
    path = write_csv(tmp_path / "x.csv", {})
    load_job.run_load(spark, path, layers)
    good = load_job.monthly_mart
    monkeypatch.setattr(load_job, "monthly_mart", lambda *a: good(*a).withColumn("month", F.lit(13)))
    with pytest.raises(QualityError, match="accepted_values"):
        load_job.build_marts(spark, layers)
    assert [r["month"] for r in spark.table(layers.monthly).collect()] == [1]
    shown = [t.name for t in spark.catalog.listTables("t16_marts") if t.name.startswith("mart_")]
    assert len(shown) == 4  # two views and what they show


def test_only_touched_years_of_the_monthly_mart_are_built_again(spark, tmp_path):
    parts, whole = fresh(spark, "t20_"), fresh(spark, "t21_")
    write_csv(tmp_path / "a.csv", {"date": "2022-12-01"}, {"date": "2023-01-01"}, {"date": "2024-01-01"})
    write_csv(tmp_path / "b.csv", {"date": "2023-02-01", "price": "77"}, {"date": "2025-01-01"})
    load_job.run_load(spark, str(tmp_path / "a.csv"), parts)
    first = tables.published_builds(spark, parts.monthly)
    load_job.run_load(spark, str(tmp_path / "b.csv"), parts, keep=timedelta(0))
    second = tables.published_builds(spark, parts.monthly)
    assert set(second) == {2022, 2023, 2024, 2025}
    assert {y for y in first if first[y] == second[y]} == {2022, 2024}
    held = {(r["build"], r["year"]) for r in spark.table(f"{parts.monthly}__data").select("build", "year").distinct().collect()}
    assert held == {(build, year) for year, build in second.items()}
    load_job.run_load(spark, str(tmp_path / "*.csv"), whole)
    for layer in ("monthly", "trend"):
        one, two = (spark.table(getattr(x, layer)) for x in (parts, whole))
        assert one.columns == two.columns and one.exceptAll(two).count() == 0 and one.count() == two.count()


def test_only_the_years_of_a_batch_are_read(spark, tmp_path):
    layers = fresh(spark, "t17_")
    rows = [{"date": f"{year}-01-01"} for year in range(2006, 2027)]
    load_job.run_load(spark, write_csv(tmp_path / "x.csv", *rows), layers)
    days = spark.sql("SELECT explode(array(DATE'2006-05-01', DATE'2026-01-01')) AS day")
    found = on_dates(spark.table(layers.staging), days, "price_date", "year")
    assert [r["year"] for r in found.collect()] == [2026]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "year#" in text and re.search(r"PartitionFilters: \[.*year#\d+ IN \(2006,2026\)", text)


def test_a_restated_price_is_reported(spark, tmp_path):
    layers = fresh(spark, "t19_")
    load_job.run_load(spark, write_csv(tmp_path / "a.csv", {}, {"commodity": "rice"}), layers)
    got = load_job.run_load(spark, write_csv(tmp_path / "b.csv", {"price": "17"}, {"commodity": "rice"}), layers)
    assert (got["raw"], got["staging"], got["restated"]) == (2, 0, 1)


def test_gate_stops_before_staging(spark, tmp_path):
    layers = fresh(spark, "t4_")
    path = write_csv(tmp_path / "bad.csv", {"price": "-1"})
    with pytest.raises(QualityError, match="negative_prices"):
        load_job.run_load(spark, path, layers)
    assert spark.table(layers.raw).count() == 1 and tables.is_empty(spark, layers.staging)


def test_a_failing_mirror_does_not_fail_the_load(spark, tmp_path, monkeypatch):
    layers = fresh(spark, "t5_")
    monkeypatch.setattr(load_job, "load_mirror", lambda *a: 1 / 0)
    got = load_job.run_load(spark, write_csv(tmp_path / "a.csv", {}), layers, mirror=True)
    assert got["mirror"] is None and got["facts"] == 1


def test_metadata_notes_and_json(spark, tmp_path):
    layers = fresh(spark, "t6_")
    load_job.run_load(spark, write_csv(tmp_path / "a.csv", *FIRST), layers)
    notes = flatten_notes(spark.table(layers.metadata)).collect()
    assert sorted(r["quality_note"] for r in notes) == [
        "rows without a date: 1", "rows without a market: 1", "rows without a price: 1"
    ]
    given = spark.sql("""SELECT 'f' AS file_name, parse_json('{"quality_notes":["a","b"]}') AS stats
                         UNION ALL SELECT 'g', parse_json('{}')""")
    assert [r["quality_note"] for r in flatten_notes(given).collect()] == ["a", "b"]


def test_scan_tokens_quotes_and_order(spark, tmp_path):
    write_csv(tmp_path / "x.csv", {"market": "N/A", "unit": 'a "b", c'}, {"market": "second"})
    df = files.read_observations(spark, str(tmp_path))
    got = df.orderBy("row_seq").collect()
    assert [(r["market"], r["unit"], r["source_file"]) for r in got] == [
        (None, 'a "b", c', "x.csv"), ("second", "90 KG", "x.csv")
    ]


def test_files_with_another_header_fail(spark, tmp_path):
    write_csv(tmp_path / "x.csv", {})
    write_csv(tmp_path / "y.csv", {}, header=["oops", *RAW_COLUMNS[1:]])
    with pytest.raises(Exception, match="(?i)header"):
        files.read_observations(spark, str(tmp_path), header=RAW_COLUMNS).collect()


def test_source_resolution(spark, tmp_path, monkeypatch):
    given, env, default = (write_csv(tmp_path / f"{n}.csv", {}) for n in ("given", "env", "default"))
    monkeypatch.setenv("LOCAL_CSV_PATH", env)
    assert files.resolve_source(spark, given, default=default) == given
    assert files.resolve_source(spark, default=default) == env
    monkeypatch.setenv("LOCAL_CSV_PATH", str(tmp_path / "gone.csv"))
    assert files.resolve_source(spark, default=default) == default
    with pytest.raises(FileNotFoundError):
        files.resolve_source(spark, str(tmp_path / "gone.csv"), default=default)
    with pytest.raises(FileNotFoundError):
        files.resolve_source(spark)


def test_landing_copy_replaces_its_own_date(spark, tmp_path):
    df = files.read_observations(spark, write_csv(tmp_path / "x.csv", {}, {})).drop("row_seq")
    for day in ("2024-01-01", "2024-01-01", "2024-01-02"):
        files.land_copy(df, str(tmp_path / "landing"), day)
    assert spark.read.parquet(str(tmp_path / "landing")).groupBy("load_date").count().count() == 2
    assert spark.read.parquet(str(tmp_path / "landing")).count() == 4


def test_spread_uses_all_cores(spark):
    assert files.spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_ensure_and_reset(spark):
    layers = fresh(spark, "t7_")
    assert tables.ensure_tables(spark, layers) == []
    load_job.load_dates(spark, layers, "2024-01-01", "2024-01-10")
    assert load_job.load_dates(spark, layers, "2024-01-05", "2024-01-12") == 2
    with pytest.raises(ValueError):
        tables.reset_tables(spark, layers)
    tables.reset_tables(spark, layers, reset=True)
    assert tables.is_empty(spark, layers.dim_date)


def test_publish_replaces_the_whole_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t8_marts")
    for n in (3, 5):
        assert tables.publish_table(spark.range(n), "t8_marts.m", ("id",)).count() == n
    names = sorted(r["tableName"] for r in spark.sql("SHOW TABLES IN t8_marts").collect())
    assert len(names) == 2 and names[0] == "m" and names[1].startswith("m__v")


def test_readers_always_see_a_version(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS t18_marts")
    tables.publish_table(spark.range(3), "t18_marts.m")
    seen, plain = [], spark.sql

    def watched(text, *args, **options):
        if "t18_marts" in text:
            seen.append(plain("SELECT count(*) FROM t18_marts.m").first()[0])
        return plain(text, *args, **options)

    monkeypatch.setattr(spark, "sql", watched)
    version = tables.write_version(spark.range(5), "t18_marts.m")
    assert spark.table("t18_marts.m").count() == 3
    tables.switch(spark, "t18_marts.m", version)
    assert seen[0] == 3 and set(seen) <= {3, 5} and spark.table("t18_marts.m").count() == 5


def test_preview_takes_a_few_rows(spark):
    assert [r["id"] for r in tables.preview(spark.range(100), 3)] == [0, 1, 2]


def test_as_of_and_kept_result(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-01-01', TIMESTAMP_NTZ'2024-01-03', INTERVAL 1 DAY)) AS loaded_at")
    assert tables.as_of(df, F.lit("2024-01-02").cast("timestamp_ntz")).count() == 2
    kept = tables.keep_result(df, "last_result")
    assert spark.table("last_result").count() == 3 and kept.storageLevel.useDisk
    kept.unpersist()


def test_stream_loads_new_files_once(spark, tmp_path):
    layers = fresh(spark, "t9_")
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    landing.mkdir()

    def run():
        load_new_files(spark, str(landing), checkpoint, layers).awaitTermination()
        return spark.table(layers.raw).count(), spark.table(layers.fact).count()

    write_csv(landing / "a.csv", *FIRST)
    assert run() == (8, 4)
    assert run() == (8, 4)
    write_csv(landing / "b.csv", {"date": "2024-05-01"}, {})
    assert run() == (10, 5)
    assert spark.table(layers.monthly).where("month = 5").count() == 1


class _Calls:
    """Stands in for the JDBC reader and writer: no database may be started here."""

    def __init__(self, df=None):
        self.df, self.seen = df, None

    def jdbc(self, url, table, **options):
        self.seen = (url, table, options)
        return self.df


def test_jdbc_options(spark):
    class Frame:
        write = _Calls()

    jdbc.append_jdbc(Frame, "jdbc:x", "staging.t", {"user": "u"})
    assert Frame.write.seen == (
        "jdbc:x", "staging.t",
        {"mode": "append", "properties": {"user": "u", "batchsize": "1000", "numPartitions": "32"}},
    )

    class Session:
        read = _Calls(spark.range(1).withColumn("x", F.lit(1)))

    keys = jdbc.read_keys(Session, "jdbc:x", "t", ["id"], years=[2024, 2023, 2024])
    assert keys.columns == ["id"]
    assert Session.read.seen[2]["predicates"] == [
        "price_date >= DATE '2023-01-01' AND price_date < DATE '2024-01-01'",
        "price_date >= DATE '2024-01-01' AND price_date < DATE '2025-01-01'",
    ]


def test_spread_by_columns_has_partitions_of_a_size(spark):
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "256k")
    try:
        small, big = (files.spread(spark.range(0, n, 1, 40).withColumn("none", F.lit(None).cast("int")), "id", "none") for n in (1_000, 4_000_000))
        assert small.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism < big.rdd.getNumPartitions() // 2
        assert big.count() == 4_000_000
    finally:
        spark.conf.unset(setting)
