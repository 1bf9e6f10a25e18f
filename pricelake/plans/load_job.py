"""The load job: files to raw, clean, gate, staging, dimensions, facts, view and marts.

Every step can be run again: raw rows and rejects come in by file, the others add unseen keys only. A journal tells how far
each load came, and the next load, whatever its files are, first completes what a lost one left. A file that was restated
comes into raw beside its older rows; staging and facts keep the first version of a key, and the number of keys with
another price is reported. A lock keeps a second writer out, because Parquet tables have no unique index.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import quality, star
from ..operators.cleaning import clean, counters
from ..operators.matching import MAX_BROADCAST_DAYS, dates_of, on_dates, unseen
from ..schemas import (
    CLEAN_KEY, COMMODITY_KEY, FILE_KEY, MARKET_KEY, MIRROR_COLUMNS, PRICE, PRICE_COLUMNS, RAW_COLUMNS, STAGING_KEY,
)
from ..scratch import Scratch
from ..session import tuned
from ..sources import journal as J, tables
from ..sources.files import exact_paths, land_copy, list_files, resolve_source, scan_observations, sound_rows
from ..sources.journal import Journal
from ..sources.lock import WriterLock
from ..sources.tables import Layers
from . import data_tests, monthly_state
from .clean_queries import mirrored
from .load_log import file_stats
from .marts import VIEW_FILTER, mart_trend, staged, view_expressions

log = logging.getLogger("pricelake.load")

#: Builds of the monthly mart that were replaced are kept so long for readers who ask for an earlier state.
KEPT = timedelta(days=7)
#: Clustering order of the published marts.
MONTHLY_ORDER, TREND_ORDER = ("month", "county", "commodity"), ("county", "year", "month")

# Raw columns under which already cleaned frames may come back.
RAW_NAMES = {
    "county": "admin1", "district": "admin2", "source": "source_file", "price_kes": "price", "price_usd": "usdprice"
}


def raw_shape(df: DataFrame) -> DataFrame:
    """Lower-case the header, go back to source names, keep the known columns that are present."""
    header = [c.strip().lower() for c in df.columns]
    renamed = df.toDF(*[RAW_NAMES.get(c, c) for c in header])
    known = (*RAW_COLUMNS, "source_file", *FILE_KEY, "row_seq")
    return renamed.select(*[c for c in known if c in renamed.columns])


def load_raw(spark: SparkSession, path: str | list[str], layers: Layers, load_id: str, moment: datetime | None = None, landing: str | None = None) -> tuple[int, int]:
    """Records of files that no load holds yet, sound ones to raw and broken ones to the rejects; returns both counts.

    Only new files are read. With ``landing``, a dated copy of the sound records is kept there as Parquet.
    """
    fresh = J.new_files(list_files(spark, path), spark.table(layers.files))
    names = [r[0] for r in fresh.select("source_path").distinct().collect()]  # as many as the scan lists on the driver
    if not names:
        return 0, 0
    scanned = scan_observations(spark, exact_paths(names))
    rows = tables.append_rows(raw_shape(sound_rows(scanned)).withColumn("load_id", F.lit(load_id)), layers.raw, moment=moment)
    broken = scanned.where("fault IS NOT NULL").select(F.col("fault").alias("reason"), "line", "source_file", *FILE_KEY)
    refused = tables.append_rows(broken.withColumn("load_id", F.lit(load_id)), layers.rejects, moment=moment)
    if landing:
        held = spark.table(layers.raw).where(F.col("load_id") == load_id).drop("load_id", "row_seq")
        land_copy(held, f"{landing.rstrip('/')}/{load_id}", f"{moment or tables.now(spark):%Y-%m-%d}")
    tables.append_rows(fresh.withColumn("load_id", F.lit(load_id)).coalesce(1), layers.files, moment=moment)
    return rows, refused


def load_staging(
    accepted: DataFrame, rejected: DataFrame, layers: Layers, files: DataFrame, days: DataFrame,
    rebalance: bool = True, moment: datetime | None = None,
) -> tuple[int, int]:
    """Append unseen rows to staging, and the rejects of ``files`` (path, time, load) that have none yet."""
    spark = accepted.sparkSession
    existing = on_dates(spark.table(layers.staging), days, "price_date", "year")
    fresh = unseen(accepted, existing, STAGING_KEY)
    added = tables.append_rows(fresh, layers.staging, rebalance_by="year" if rebalance else None, moment=moment)
    told = J.of_files(spark.table(layers.rejects).where("line IS NULL"), files).select("load_id", *FILE_KEY).distinct()
    silent = files.join(told, on=[files[c].eqNullSafe(told[c]) for c in ("load_id", *FILE_KEY)], how="left_anti")
    refused = rejected.join(silent, on=[rejected[c].eqNullSafe(silent[c]) for c in FILE_KEY]).select(*[rejected[c] for c in rejected.columns], "load_id")
    return added, tables.append_rows(refused, layers.rejects, moment=moment)


def restated(accepted: DataFrame, layers: Layers, days: DataFrame) -> int:
    """Keys of ``accepted`` that staging holds with another price: the first version stays, the count tells of it."""
    held = on_dates(accepted.sparkSession.table(layers.staging), days, "price_date", "year").select(*STAGING_KEY, "price_kes")
    changed = unseen(accepted.withColumn("price_kes", F.col("price_kes").cast(PRICE)), held, (*STAGING_KEY, "price_kes"))
    return changed.select(*STAGING_KEY).distinct().count()


def load_dimensions(rows: DataFrame, layers: Layers, moment: datetime | None = None) -> dict[str, int]:
    """Add members that are not there yet, each under a key of its own; existing members never change."""
    spark = rows.sparkSession
    added = {}
    with Scratch(spark) as scratch:
        for name, key, build, surrogate in (
            (layers.dim_market, MARKET_KEY, star.dim_market, "market_id"),
            (layers.dim_commodity, COMMODITY_KEY, star.dim_commodity, "commodity_id"),
        ):
            held = spark.table(name)
            fresh = scratch.store(star.new_members(build(rows), held, key), surrogate)
            fresh = star.free_keys(fresh, held, key, surrogate)
            added[name] = tables.append_rows(fresh, name, stamp="created_at", moment=moment)
    return added


def load_dates(spark: SparkSession, layers: Layers, start: str, end: str) -> int:
    """Add the days from ``start`` to ``end`` that the date dimension does not hold yet."""
    fresh = unseen(star.dim_date(spark, start, end), spark.table(layers.dim_date), ("date_id",))
    return tables.append_rows(fresh, layers.dim_date, stamp=None)


def load_dates_of(days: DataFrame, layers: Layers) -> int:
    """Add the whole years from the first to the last of ``days``."""
    first, last = days.agg(F.min("day"), F.max("day")).first()
    return load_dates(days.sparkSession, layers, f"{first.year:04}-01-01", f"{last.year:04}-12-31") if first else 0


def load_facts(rows: DataFrame, layers: Layers, days: DataFrame, rebalance: bool = True, moment: datetime | None = None) -> tuple[int, int]:
    """Append unseen facts of the valid ``rows``; also returns how many fall outside the date dimension."""
    spark = rows.sparkSession
    dates = spark.table(layers.dim_date)
    known = dates.join(F.broadcast(days), dates["full_date"] == days["day"], "left_semi").select(F.col("full_date").alias("day"), "date_id")
    years = [r[0] for r in days.select(F.year("day")).distinct().collect()]  # as many as the calendar has
    existing = spark.table(layers.fact).where(F.col("year").isin([y for y in years if y is not None]))
    existing = existing.join(F.broadcast(known.select("date_id")), "date_id", "left_semi")
    fresh = star.facts(
        rows,
        dates,
        spark.table(layers.dim_market),
        spark.table(layers.dim_commodity),
        existing=existing,
        broadcast_dates=dates.count() <= MAX_BROADCAST_DAYS,
    )
    fresh = fresh.withColumn("year", F.floor(F.col("date_id") / 10000).cast("int"))
    added = tables.append_rows(fresh, layers.fact, rebalance_by="year" if rebalance else None, moment=moment)
    outside = quality.relationship(rows.where("is_valid_price"), layers.staging, "price_date", dates, "full_date")
    return added, outside.first()["violations"]


def mirror_shape(cleaned: DataFrame) -> DataFrame:
    """The cleaned rows as the second target keeps them: its columns, upper-case names, prices as DOUBLE."""
    wide = cleaned.withColumns({c: F.col(c).cast("double") for c in (*PRICE_COLUMNS, "price_per_kg") if c in cleaned.columns})
    return mirrored(wide.select(*[c for c in MIRROR_COLUMNS if c in wide.columns]))


def load_mirror(cleaned: DataFrame, layers: Layers, moment: datetime | None = None) -> int:
    """Append unseen cleaned rows, rejected ones too, to the second target."""
    spark = cleaned.sparkSession
    rows = mirror_shape(cleaned)
    if spark.catalog.tableExists(layers.mirror):
        key = ["DATE" if k == "price_date" else k.upper() for k in STAGING_KEY]
        existing = on_dates(spark.table(layers.mirror), dates_of(rows, "DATE"), "DATE", "YEAR")
        return tables.append_rows(unseen(rows, existing, key), layers.mirror, stamp="LOADED_AT", moment=moment)
    columns = [c for c in rows.columns if c != "YEAR"]
    stamp = F.lit(moment).cast("timestamp_ntz") if moment else F.localtimestamp()
    watched, seen = tables.counted(rows.select(*columns, stamp.alias("LOADED_AT"), "YEAR"))
    watched.write.format("parquet").partitionBy("YEAR").saveAsTable(layers.mirror)
    return seen.get["rows"]


def monthly_state_of(spark: SparkSession, layers: Layers, build: str, touched: list[int] | None) -> tuple[list[int], dict[int, datetime]]:
    """Write the state of the ``touched`` years (None: all) as ``build``; returns its years and their newest stamps.

    A year's new state is its published one and the staged rows that came after it; the filter on the stamp skips the
    files of older loads. A year without a published state is summed up from all its rows.
    """
    staging = spark.table(layers.staging)
    before, through = tables.published_builds(spark, layers.monthly), tables.published_through(spark, layers.monthly)
    known = {} if touched is None else {y: before[y] for y in touched if y in before and y in through}
    rows = staging.where(VIEW_FILTER)
    if touched is not None:
        rows = rows.where(F.col("year").isin(touched))
        for year in known:
            rows = rows.where((F.col("year") != year) | (F.col("loaded_at") > F.lit(through[year]).cast("timestamp_ntz")))
    if known and len(known) == len(touched):  # what the reader of the files can use to skip them
        rows = rows.where(F.col("loaded_at") > F.lit(min(through[y] for y in known)).cast("timestamp_ntz"))
    view = rows.selectExpr(*view_expressions())
    sums, pairs = monthly_state.sums(view), monthly_state.places(view)
    if known:
        sums = monthly_state.merged(sums.unionByName(tables.of_builds(spark, layers.monthly_sums, known)))
        pairs = pairs.unionByName(tables.of_builds(spark, layers.monthly_places, known)).distinct()
    built = tables.write_years(sums, layers.monthly_sums, build)
    tables.write_years(pairs, layers.monthly_places, build)
    newest = {r["year"]: r["last"] for r in rows.groupBy("year").agg(F.max("loaded_at").alias("last")).collect()}  # a calendar's worth
    return built, {y: through[y] for y in known} | newest


def monthly_mart(spark: SparkSession, layers: Layers, builds: dict[int, str]) -> DataFrame:
    """The monthly mart's rows from the stored state of these builds."""
    return monthly_state.mart(*(tables.of_builds(spark, name, builds) for name in (layers.monthly_sums, layers.monthly_places)))


def build_marts(
    spark: SparkSession, layers: Layers, pattern: str = "%maize%", years: Iterable[int] | None = None,
    loads: Iterable[tuple[str, datetime]] = (), keep: timedelta = KEPT,
) -> dict[str, int]:
    """The view, and new versions of the marts that pass all data tests before readers see them.

    Of the monthly mart only ``years`` are built again (all of them without the argument or on the first build); the trend
    compares with months of other years and is built from the whole monthly mart, which is small beside the staging. The
    journal is told that ``loads`` (id and stamp) are published. Builds that were replaced more than ``keep`` ago are dropped.
    """
    tables.publish_view(spark, layers.view, layers.staging, view_expressions(), VIEW_FILTER)
    build, before = uuid.uuid4().hex[:12], tables.published_builds(spark, layers.monthly)
    touched = sorted(set(years)) if years is not None and before else None
    states = (layers.monthly_sums, layers.monthly_places)
    built, newest = monthly_state_of(spark, layers, build, touched)
    rows = monthly_mart(spark, layers, dict.fromkeys(built, build))
    tables.write_years(rows, layers.monthly, build, MONTHLY_ORDER)
    kept = {} if touched is None else {year: held for year, held in before.items() if year not in touched}
    builds = kept | dict.fromkeys(built, build)
    through = {y: at for y, at in (tables.published_through(spark, layers.monthly) | newest).items() if y in builds}
    monthly = tables.of_builds(spark, layers.monthly, builds)
    trend = tables.write_version(mart_trend(monthly, pattern), layers.trend, TREND_ORDER)
    try:
        data_tests.check(data_tests.refresh(spark, layers, monthly, trend, touched))
    except quality.QualityError:
        for name in (*states, layers.monthly):
            tables.drop_build(spark, name, build, built)
        spark.sql(f"DROP TABLE IF EXISTS {trend}")
        raise
    shown = tables.switch_years(spark, layers.monthly, builds, rows.columns, through)
    counts = {layers.monthly: shown.count(), layers.trend: tables.switch(spark, layers.trend, trend).count()}
    journal, detail = Journal(spark, layers), json.dumps(builds)
    for load_id, moment in list(loads) or [(f"marts-{build}", tables.now(spark))]:
        journal.write(load_id, J.PUBLISHED, moment, builds, detail)
    past = {pair for _, shown_then in journal.shown(tables.now(spark) - keep) for pair in shown_then.items()}
    tables.drop_builds_but(spark, layers.monthly, set(builds.items()) | (past if keep else set()))
    for name in states:
        tables.drop_builds_but(spark, name, set(builds.items()))
    return counts


def monthly_as_of(spark: SparkSession, layers: Layers, moment: datetime) -> DataFrame:
    """The monthly mart as readers saw it at ``moment``, as long as its builds are kept."""
    seen = [builds for at, builds in Journal(spark, layers).shown(moment) if at <= moment]
    if not seen:
        raise LookupError(f"no monthly mart was shown at {moment}")
    rows = tables.of_builds(spark, layers.monthly, seen[-1])
    held = {tuple(r) for r in spark.table(f"{layers.monthly}__data").select("year", "build").distinct().collect()}  # years times kept builds
    gone = sorted(year for year, build in seen[-1].items() if (year, build) not in held)
    if gone:
        raise LookupError(f"the builds of {gone} shown at {moment} are no longer kept")
    return rows


def load_stored(
    spark: SparkSession,
    files: DataFrame,
    layers: Layers,
    moment: datetime,
    dates: tuple[str, str] | None = None,
    keys: Iterable[str] = CLEAN_KEY,
    mirror: bool = False,
    rebalance: bool = True,
) -> dict:
    """From the stored raw rows of ``files`` (path, time, load) to the load record: clean, gate, staging, dimensions, facts.

    Nothing is written to staging or beyond when a critical check fails.
    """
    counts: dict = {}
    with Scratch(spark) as scratch:
        files = scratch.store(files, "files")
        raw = J.of_files(spark.table(layers.raw), files).drop("loaded_at", "load_id")
        cleaned = scratch.store(clean(raw, keys=keys).drop("row_seq"), "cleaned")
        counts["checks"] = quality.gate(quality.report(cleaned))

        accepted, rejected = staged(cleaned, FILE_KEY)
        days = scratch.store(dates_of(accepted, "price_date"), "days")
        counts["years"] = sorted(r[0] for r in days.select(F.year("day")).distinct().collect())  # a calendar's worth
        if dates:
            load_dates(spark, layers, *dates)
        else:
            load_dates_of(days, layers)
        counts["staging"], counts["rejects"] = load_staging(accepted, rejected, layers, files, days, rebalance, moment)
        counts["restated"] = restated(accepted, layers, days)
        if counts["restated"]:
            log.warning("%d keys are in staging with another price; the first version stays", counts["restated"])
        # Dimensions and facts come from the stored rows of these dates, whoever wrote them.
        stored = on_dates(spark.table(layers.staging), days, "price_date", "year")
        counts["dimensions"] = load_dimensions(stored, layers, moment)
        counts["facts"], counts["outside_dates"] = load_facts(stored, layers, days, rebalance, moment)
        if counts["outside_dates"]:
            log.warning("%d valid rows lie outside the date dimension", counts["outside_dates"])
        failure = None
        if mirror:
            try:
                counts["mirror"] = load_mirror(cleaned, layers, moment)
            except Exception as error:  # the second target must not fail the load, and its load record tells of it
                failure = f"{type(error).__name__}: {str(error)[:500]}"
                log.warning("mirror failed: %s", failure)
                counts["mirror"] = None
        taken = {r["counter"]: r["rows"] for r in counters(raw, keys, kept=cleaned.count()).collect()}  # a row per counter
        record = file_stats(cleaned, checks=counts["checks"], counters=taken, mirror_error=failure)
        tables.append_rows(record, layers.metadata, moment=moment)
        counts["cleaning"] = taken
    return counts


def recover(spark: SparkSession, layers: Layers, **options) -> list[tuple[str, datetime, list[int]]]:
    """Complete the loads that were lost on the way; returns their ids, stamps and years, which the marts still lack.

    A load that never finished its raw rows is taken back, so its files can be loaded again. One that the gate refuses is
    closed and stands in no later load's way.
    """
    journal, found = Journal(spark, layers), []
    for lost in journal.lost():
        if J.RAW not in lost.steps:
            journal.discard(lost)
            continue
        files = spark.table(layers.files).where(F.col("load_id") == lost.load_id).select(*FILE_KEY, "load_id")
        # Its own stamp may lie behind a published one by now; what is staged now must count as newer.
        moment = journal.next_moment()
        journal.write(lost.load_id, J.RAW, moment, detail="taken up again")
        try:
            counts = load_stored(spark, files, layers, moment, **options)
        except quality.QualityError as error:
            log.warning("load %s is closed: %s", lost.load_id, error)
            journal.write(lost.load_id, J.CLOSED, lost.moment, detail=str(error)[:500])
            continue
        journal.write(lost.load_id, J.LOADED, moment, counts["years"])
        found.append((lost.load_id, moment, counts["years"]))
    return found


def load_batch(
    spark: SparkSession,
    path: str | list[str],
    layers: Layers,
    dates: tuple[str, str] | None = None,
    keys: Iterable[str] = CLEAN_KEY,
    mirror: bool = False,
    rebalance: bool = True,
    landing: str | None = None,
) -> dict:
    """Everything but the marts for some source files, after what lost loads left.

    Nothing is written to staging or beyond when a critical check fails. The date dimension grows with the accepted
    rows; with ``dates`` it holds that range, and valid rows outside it are counted and left out of the facts. ``years``
    and ``loads`` of the result are what ``build_marts`` has to publish.
    """
    options = {"dates": dates, "keys": tuple(keys), "mirror": mirror, "rebalance": rebalance}
    journal = Journal(spark, layers)
    recovered = recover(spark, layers, **options)
    moment = journal.next_moment()
    load_id = f"{moment:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    counts: dict = {"load_id": load_id, "recovered": [name for name, *_ in recovered]}
    journal.write(load_id, J.BEGUN, moment)
    counts["raw"], counts["broken"] = load_raw(spark, path, layers, load_id, moment, landing)
    journal.write(load_id, J.RAW, moment)
    files = J.held_files(list_files(spark, path), spark.table(layers.files))
    try:
        counts |= load_stored(spark, files, layers, moment, **options)
    except quality.QualityError as error:
        journal.write(load_id, J.CLOSED, moment, detail=str(error)[:500])
        raise
    journal.write(load_id, J.LOADED, moment, counts["years"])
    counts["loads"] = [(load_id, moment), *((name, at) for name, at, _ in recovered)]
    counts["years"] = sorted({*counts["years"], *(y for *_, years in recovered for y in years)})
    return counts


def run_load(
    spark: SparkSession,
    source: str | None = None,
    layers: Layers = Layers(),
    dates: tuple[str, str] | None = None,
    keys: Iterable[str] = CLEAN_KEY,
    mirror: bool = False,
    trend_pattern: str = "%maize%",
    default_source: str | None = None,
    rebalance: bool = True,
    landing: str | None = None,
    wait: float = 0.0,
    keep: timedelta = KEPT,
) -> dict:
    """Load one source from end to end and rebuild the marts; returns the counts of every step.

    A second writer waits up to ``wait`` seconds for this one and then fails with ``Busy``.
    """
    path = resolve_source(spark, source, default=default_source)
    with tuned(spark), writer(spark, layers, wait) as lock:
        J.adopt(spark, layers)
        counts = load_batch(spark, path, layers, dates, keys, mirror, rebalance, landing)
        lock.check()
        counts["marts"] = build_marts(spark, layers, trend_pattern, counts["years"], counts["loads"], keep)
    return counts


def writer(spark: SparkSession, layers: Layers, wait: float = 0.0) -> WriterLock:
    """The lock of these layers, beside their raw tables; the tables are made if they are missing."""
    tables.ensure_tables(spark, layers)
    return WriterLock(spark, spark.catalog.getDatabase(layers.databases[0]).locationUri, wait=wait)
