"""What a load leaves behind when it is lost, and what later loads read: one scenario of loads, looked at by many tests."""

import re
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from pricelake.operators import quality, star
from pricelake.plans import data_tests, load_job, marts, monthly_state
from pricelake.sources import files, journal, tables
from pricelake.sources.lock import Busy, WriterLock
from test_load import fresh, write_csv


class Died(Exception):
    pass


def die(*_, **__):
    raise Died


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Loads of 2022, 2023 (dies before its marts), 2024 (dies after its raw rows), 2021 (dies within them), 2025."""
    folder, layers = tmp_path_factory.mktemp("lake"), fresh(spark, "r1_")
    rng = [{"market": m, "price": str(p), "unit": u} for m, p, u in (("Wakulima", 90, "KG"), ("Kibuye", 110, "KG"), ("Kibuye", 7.25, "90 KG"))]
    made = [write_csv(folder / f"{y} [1].csv", *({**r, "date": f"{y}-0{m}-15"} for r in rng for m in (1, 3))) for y in range(2021, 2026)]
    paths = dict(zip(range(2021, 2026), files.exact_paths(made)))
    seen = {}
    with pytest.MonkeyPatch.context() as patch:
        seen["first"] = load_job.run_load(spark, paths[2022], layers)
        seen["after first"] = tables.now(spark)
        for year, target, name in ((2023, load_job, "build_marts"), (2024, load_job, "load_stored"), (2021, load_job, "land_copy")):
            with patch.context() as inner:
                inner.setattr(target, name, die)
                with pytest.raises(Died):
                    # A lost load of before must not be taken up here, or it would end.
                    inner.setattr(load_job, "recover", lambda *a, **k: [])
                    load_job.run_load(spark, paths[year], layers, landing=str(folder / "landing"))
        seen["lost"] = journal.Journal(spark, layers).lost()
        seen["marts before"] = spark.table(layers.monthly).select("year").distinct().count()
        seen["last"] = load_job.run_load(spark, paths[2025], layers, landing=str(folder / "landing"))
    return layers, seen, folder, paths


def same(one, two):
    return one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_the_next_load_completes_lost_ones(spark, lake):
    layers, seen, *_ = lake
    assert [x.steps for x in seen["lost"]] == [{"begun", "raw", "loaded"}, {"begun", "raw"}, {"begun"}]
    assert seen["marts before"] == 1 and len(seen["last"]["recovered"]) == 2 and seen["last"]["years"] == [2023, 2024, 2025]
    assert journal.Journal(spark, layers).lost() == []
    years = [2022, 2023, 2024, 2025]
    for name in (layers.raw, layers.staging, layers.fact, layers.monthly, layers.trend):
        by = F.year(F.to_date("date")) if name == layers.raw else F.col("year")
        assert sorted(r[0] for r in spark.table(name).select(by).distinct().collect()) == years, name
    whole = marts.mart_monthly(spark.table(layers.view))
    assert same(spark.table(layers.monthly).select(*whole.columns), whole)
    assert spark.table(layers.files).count() == 4  # 2021 was taken back with its raw rows


def test_a_file_taken_back_loads_again_and_a_known_one_adds_nothing(spark, lake):
    layers, _, _, paths = lake
    manifest = spark.table(layers.files)
    assert journal.new_files(files.list_files(spark, paths[2021]), manifest).count() == 1
    assert load_job.load_raw(spark, paths[2022], layers, "again") == (0, 0)
    assert load_job.load_raw(spark, paths[2021], layers, "late") == (6, 0)
    journal.Journal(spark, layers).discard(journal.Lost("late", tables.now(spark), frozenset()))
    assert spark.table(layers.raw).where("load_id = 'late'").count() == 0 and spark.table(layers.files).count() == 4


def test_a_landing_copy_is_kept(spark, lake):
    layers, seen, folder, _ = lake
    assert spark.read.parquet(str(folder / "landing" / seen["last"]["load_id"])).count() == 6


def test_raw_is_read_by_load(spark, lake):
    layers, _, _, paths = lake
    held = journal.held_files(files.list_files(spark, paths[2023]), spark.table(layers.files))
    found = journal.of_files(spark.table(layers.raw), held)
    assert found.count() == 6
    text = found._jdf.queryExecution().executedPlan().toString()
    raw = next(line for line in text.splitlines() if "FileScan" in line and "priceflag" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*load_id#\d+ = \d{8}T\d{6}-", raw), raw


def test_state_is_read_from_new_rows_only(spark, lake):
    layers, *_ = lake
    through = tables.published_through(spark, layers.monthly)
    assert sorted(through) == [2022, 2023, 2024, 2025] and through[2022] < through[2025]
    rows = spark.table(layers.staging).where(F.col("loaded_at") > F.lit(max(through.values())).cast("timestamp_ntz"))
    assert rows.count() == 0 and "GreaterThan(loaded_at" in rows._jdf.queryExecution().executedPlan().toString()


def test_the_mart_as_it_was(spark, lake):
    layers, seen, *_ = lake
    then = load_job.monthly_as_of(spark, layers, seen["after first"])
    assert [r["year"] for r in then.select("year").distinct().collect()] == [2022] and then.count() == 4
    assert load_job.monthly_as_of(spark, layers, tables.now(spark)).count() == spark.table(layers.monthly).count()
    with pytest.raises(LookupError):
        load_job.monthly_as_of(spark, layers, seen["after first"] - timedelta(days=1))


def test_tests_of_touched_years_add_up_to_the_full_test(spark, lake):
    layers, *_ = lake
    monthly = spark.table(layers.monthly)
    trend = next(f"r1_marts.{t.name}" for t in spark.catalog.listTables("r1_marts") if "trends__v" in t.name)
    key = ("table_name", "test", "column_name", "violations", "passed")
    full = data_tests.published(spark, layers, monthly, trend).select(*key)
    assert same(data_tests.totals(data_tests.stored(spark, layers)).select(*key), full)
    # A repeated staging row of one year is found by testing that year, and by no other.
    spare = spark.table(layers.staging).where("year = 2023").limit(1)
    spare.write.mode("append").insertInto(layers.staging)
    for years, found in (([2024], 0), ([2023], 1)):
        totals = data_tests.refresh(spark, layers, monthly, trend, years)
        assert totals.where("table_name = 'staging' AND test = 'unique'").first()["violations"] == found
    full = data_tests.published(spark, layers, monthly, trend).select(*key)
    assert same(data_tests.totals(data_tests.stored(spark, layers)).select(*key), full)
    text = data_tests.yearly(spark, layers, monthly, [2023])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan" in line and re.search(r"price_date#|pricetype#|is_valid", line)]
    assert scans and all(re.search(r"PartitionFilters: \[[^\]]*year#\d+ (= 2023|IN \(2023\))", line) for line in scans)


def test_merged_sums_equal_a_full_build(spark):
    """Rows in three parts, in any order: the same mart, to the last bit; and the one of the plain aggregate."""
    n = F.col("id")
    rows = spark.range(3000).select(
        F.lit(2024).alias("year"), (n % 2 + 1).cast("int").alias("month"), F.lit("2024-01-01").cast("date").alias("month_start"),
        F.when(n % 5 > 0, F.concat(F.lit("c"), n % 5)).alias("county"), F.concat(F.lit("x"), n % 3).alias("commodity"),
        F.when(n % 7 > 0, F.lit("KG")).alias("unit"), F.concat(F.lit("m"), F.xxhash64("id") % 40).alias("market"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**9)) / 10000).cast("decimal(12,4)").alias("price_kes"),
        F.when(n % 4 > 0, (n % 97 + F.lit(0.25))).cast("decimal(12,4)").alias("price_usd"), F.lit(99999999.9999).cast("decimal(12,4)").alias("price_per_kg"), n,
    )
    parts = [rows.where(f"id % 3 = {k}") for k in range(3)]
    sums = [monthly_state.sums(p) for p in parts]
    pairs = [monthly_state.places(p) for p in parts]
    merged = monthly_state.merged(monthly_state.merged(sums[2].unionByName(sums[0])).unionByName(sums[1]))
    both = pairs[1].unionByName(pairs[2]).unionByName(pairs[0]).distinct()
    whole = monthly_state.mart(monthly_state.sums(rows), monthly_state.places(rows))
    assert same(monthly_state.mart(merged, both), whole)
    plain = marts.mart_monthly(rows)
    assert whole.columns == plain.columns and whole.dtypes == plain.dtypes and same(whole, plain)
    level = rows.withColumn("price_kes", F.lit(99999999.9999).cast("decimal(12,4)"))
    assert {r[0] for r in monthly_state.mart(monthly_state.sums(level), monthly_state.places(level)).select("stddev_price_kes").distinct().collect()} == {0.0}


def test_published_files_do_not_overlap(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS r2_marts")
    n = F.col("id")
    rows = spark.range(40000).select(F.lit(2024).alias("year"), (F.xxhash64("id") % 6 + 6).cast("int").alias("month"), F.concat(F.lit("c"), n % 40).alias("county"), n)
    aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows, and still several files
    tables.write_years(rows, "r2_marts.m", "b", ("month", "county"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", aqe)
    held = spark.table("r2_marts.m__data").select("month", "county", F.col("_metadata.file_name").alias("file"))
    spans = sorted(tuple(r) for r in held.groupBy("file").agg(F.min(F.struct("month", "county")), F.max(F.struct("month", "county"))).select(F.col("min(struct(month, county))"), F.col("max(struct(month, county))")).collect())
    assert len(spans) > 3 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    one = held.where("month = 3 AND county = 'c7'").select("file").distinct().count()
    assert one <= 2


def test_a_clash_of_keys_loads_both_members(spark, monkeypatch):
    good = star.hash_key
    few = lambda *columns: F.pmod(good(*columns), F.lit(3)) if len(columns) == len(star.MARKET_KEY) else good(*columns)
    monkeypatch.setattr(star, "hash_key", few)
    staged = spark.range(12).select(F.concat(F.lit("m"), "id").alias("market"), F.lit(None).cast("string").alias("district"), F.lit("c").alias("county"),
                                    F.lit(1).alias("source_market_id"), F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"))
    held = star.dim_market(staged).limit(0)
    for part in ("id < 5", "id >= 0"):
        rows = staged.where(part.replace("id", "int(substring(market, 2))"))
        new = star.new_members(star.dim_market(rows), held, star.MARKET_KEY)
        held = spark.createDataFrame([*held.collect(), *star.free_keys(new, held, star.MARKET_KEY, "market_id").collect()], held.schema)
    found = held.collect()
    assert len(found) == 12 and len({r["market_id"] for r in found}) == 12 and len({r["market_name"] for r in found}) == 12
    assert quality.unique(held, "d", ["market_id"]).first()["passed"]


def test_a_second_writer_waits_or_fails(spark, tmp_path):
    folder = str(tmp_path)
    with WriterLock(spark, folder) as first:
        with pytest.raises(Busy):
            WriterLock(spark, folder).__enter__()
        first.check()
    with WriterLock(spark, folder, lease=0.6) as lost:
        lost._done.set()  # as if its driver had died: nobody renews the lock
        time.sleep(1.0)
        with WriterLock(spark, folder, lease=0.6, wait=5) as second:
            with pytest.raises(Busy):
                lost.check()
            time.sleep(1.2)  # renewed by now
            with pytest.raises(Busy):
                WriterLock(spark, folder, lease=0.6).__enter__()
            second.check()
    assert not [p for p in tmp_path.iterdir() if "writer" in p.name and not p.name.endswith(".crc")]


def test_a_load_fails_while_another_holds_the_lock(spark, tmp_path, lake):
    layers, *_ = lake
    with load_job.writer(spark, layers), pytest.raises(Busy):
        load_job.run_load(spark, write_csv(tmp_path / "x.csv", {}), layers)


def test_broken_records_go_to_the_rejects(spark, tmp_path):
    layers = fresh(spark, "r3_")
    path = write_csv(tmp_path / "x.csv", {}, {"date": "2024-02-15", "market": 'the "old", one'}, {"date": "", "commodity": "rice"})
    good = open(path).read().splitlines()[1]
    broken = [good + ",x,y", ",".join(good.split(",")[:5]), '"' + good, good.replace(",", ',"', 1), good.replace(",", ',"a"b,', 1)]
    with open(path, "a") as out:
        out.write("\n".join(["", *broken, "  ", good.replace("2024-01", "2024-05")]) + "\n")
    got = load_job.run_load(spark, path, layers)
    assert (got["raw"], got["broken"]) == (4, 5)
    refused = spark.table(layers.rejects).where("line IS NOT NULL").collect()
    assert sorted(r["line"] for r in refused) == sorted(broken) and {r["source_file"] for r in refused} == {"x.csv"}
    assert sorted(r["reason"] for r in refused) == ["18 fields, not 16", "5 fields, not 16", *["quotation mark not closed"] * 3]
    assert spark.table(layers.rejects).where("line IS NULL").count() == 1  # the row without a date
    again = load_job.run_load(spark, path, layers)
    assert (again["raw"], again["broken"], again["rejects"]) == (0, 0, 0) and spark.table(layers.rejects).count() == 6


def test_records_over_several_lines(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n1,"two\nlines"\n1,2,3\n"x",y\n')
    rows = files.scan_observations(spark, str(path), multi_line=True).collect()
    assert sorted((r["a"], r["b"]) for r in rows if r["fault"] is None) == [("1", "two\nlines"), ("x", "y")]
    assert [r["fault"] for r in rows if r["fault"]] == ["malformed record"]
    assert [r["fault"] for r in files.scan_observations(spark, str(path)).orderBy("row_seq").collect()] == ["quotation mark not closed", "1 fields, not 2", "3 fields, not 2", None]


def test_a_table_older_than_the_manifest_is_adopted(spark):
    layers = fresh(spark, "r4_")
    row = spark.createDataFrame([("p", "f.csv", "old")], "source_path string, source_file string, load_id string").withColumn("file_time", F.current_timestamp())
    tables.append_rows(row, layers.raw)
    assert journal.adopt(spark, layers) == 1 and journal.adopt(spark, layers) == 0
    assert spark.table(layers.files).first()["load_id"] == "old" and journal.Journal(spark, layers).lost() == []
