"""What loads have done: a journal of their steps, and a manifest of the files they brought.

A load writes each step when it is complete, so a later one sees how far a lost load came. The manifest tells which load
holds a file; raw rows and rejects are partitioned by load, so the rows of a file are found without reading other loads.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import FILE_KEY
from . import tables
from .tables import Layers

#: Steps in order: begun, raw rows and rejects of the scan stored, all tables but the marts complete, marts shown. A load
#: that was refused or could not be completed is closed and never taken up again.
BEGUN, RAW, LOADED, PUBLISHED, CLOSED = "begun", "raw", "loaded", "published", "closed"


class Lost(NamedTuple):
    """A load without an end."""

    load_id: str
    moment: datetime
    steps: frozenset[str]


class Journal:
    def __init__(self, spark: SparkSession, layers: Layers):
        self.spark, self.layers = spark, layers

    def write(self, load_id: str, step: str, moment: datetime, years: Iterable[int] = (), detail: str | None = None) -> None:
        """One record; ``moment`` is the load's stamp, the record's own time is taken here."""
        schema = "load_id string, step string, moment timestamp_ntz, years array<int>, detail string"
        row = self.spark.createDataFrame([(load_id, step, moment, sorted(y for y in years if y is not None), detail)], schema)
        tables.append_rows(row.coalesce(1), self.layers.journal, stamp="at")

    def steps(self) -> DataFrame:
        return self.spark.table(self.layers.journal)

    def next_moment(self) -> datetime:
        """The time now, but later than every load before: rows are told apart by their load's stamp."""
        last = self.steps().agg(F.max("moment")).first()[0]
        now = tables.now(self.spark)
        return now if last is None or now > last else last + timedelta(microseconds=1)

    def lost(self) -> list[Lost]:
        """Loads that neither published nor were closed, oldest first; a row per such load comes to the driver."""
        by_load = self.steps().groupBy("load_id").agg(F.min("moment").alias("moment"), F.collect_set("step").alias("steps"))
        open_ = by_load.where(~F.array_contains("steps", PUBLISHED) & ~F.array_contains("steps", CLOSED))
        return sorted((Lost(r["load_id"], r["moment"], frozenset(r["steps"])) for r in open_.collect()), key=lambda x: (x.moment, x.load_id))

    def discard(self, lost: Lost) -> None:
        """Take away what a load left that never finished its raw rows: its files count as not loaded."""
        for name in (self.layers.raw, self.layers.rejects, self.layers.files):
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (load_id = '{lost.load_id}')")
        self.write(lost.load_id, CLOSED, lost.moment, detail="lost before its raw rows were complete")

    def shown(self, since: datetime | None = None) -> list[tuple[datetime, dict[int, str]]]:
        """When which builds of the monthly mart were shown, ascending: the ones shown at ``since`` and all later ones."""
        rows = self.steps().where((F.col("step") == PUBLISHED) & F.col("detail").isNotNull())
        if since is not None:
            first = rows.where(F.col("at") <= F.lit(since).cast("timestamp_ntz")).agg(F.max("at")).first()[0]
            rows = rows.where(F.col("at") >= F.lit(first).cast("timestamp_ntz")) if first else rows
        found = rows.select("at", "detail").distinct().orderBy("at").collect()
        return [(r["at"], {int(y): b for y, b in json.loads(r["detail"]).items()}) for r in found]


def new_files(listed: DataFrame, manifest: DataFrame) -> DataFrame:
    """``listed`` files (path and time) that no load holds."""
    held = manifest.select(*FILE_KEY)
    return listed.join(held, on=[listed[c].eqNullSafe(held[c]) for c in FILE_KEY], how="left_anti")


def held_files(listed: DataFrame, manifest: DataFrame) -> DataFrame:
    """The manifest's rows for ``listed`` files."""
    return manifest.join(listed, on=[manifest[c].eqNullSafe(listed[c]) for c in FILE_KEY], how="left_semi").select(*FILE_KEY, "load_id")


def of_files(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of a table partitioned by load that belong to ``files`` (path, time, load_id); other loads are not read."""
    loads = [r[0] for r in files.select("load_id").distinct().collect()]  # the loads that brought these files
    mine = rows.where(F.col("load_id").isin(loads))
    return mine.join(files, on=[mine["load_id"] == files["load_id"], *(mine[c].eqNullSafe(files[c]) for c in FILE_KEY)], how="left_semi")


def adopt(spark: SparkSession, layers: Layers) -> int:
    """Enter the loads of a raw table that is older than its manifest, once; returns the number of files entered."""
    if not tables.is_empty(spark, layers.journal) or not tables.is_empty(spark, layers.files) or tables.is_empty(spark, layers.raw):
        return 0
    found = spark.table(layers.raw).groupBy(*FILE_KEY, "load_id").agg(F.max("loaded_at").alias("loaded_at"))
    entered = tables.append_rows(found, layers.files, stamp=None)
    old = spark.table(layers.files).groupBy("load_id").agg(F.max("loaded_at").alias("moment"))
    closed = old.withColumns({"step": F.lit(CLOSED), "detail": F.lit("older than the journal")})
    tables.append_rows(closed, layers.journal, stamp="at")
    return entered
