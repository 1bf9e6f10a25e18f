"""Layered Parquet tables: create, reset, append, append by file, publish views and marts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from .. import schemas as S


@dataclass(frozen=True)
class Layers:
    """Database per layer; ``prefix`` keeps several sets apart."""

    prefix: str = ""

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    @property
    def raw(self) -> str:
        return self.name("raw", "raw_food_prices")

    @property
    def metadata(self) -> str:
        return self.name("raw", "raw_metadata")

    @property
    def journal(self) -> str:
        return self.name("raw", "load_journal")

    @property
    def files(self) -> str:
        return self.name("raw", "load_files")

    @property
    def tests(self) -> str:
        return self.name("marts", "data_tests")

    @property
    def monthly_sums(self) -> str:
        return self.name("marts", "monthly_sums")

    @property
    def monthly_places(self) -> str:
        return self.name("marts", "monthly_places")

    @property
    def staging(self) -> str:
        return self.name("staging", "stg_food_prices")

    @property
    def rejects(self) -> str:
        return self.name("staging", "rejects")

    @property
    def dim_date(self) -> str:
        return self.name("warehouse", "dim_date")

    @property
    def dim_market(self) -> str:
        return self.name("warehouse", "dim_market")

    @property
    def dim_commodity(self) -> str:
        return self.name("warehouse", "dim_commodity")

    @property
    def fact(self) -> str:
        return self.name("warehouse", "fact_prices")

    @property
    def view(self) -> str:
        return self.name("analytics", "stg_food_prices")

    @property
    def monthly(self) -> str:
        return self.name("marts", "mart_monthly_avg_prices")

    @property
    def trend(self) -> str:
        return self.name("marts", "mart_maize_price_trends")

    @property
    def mirror(self) -> str:
        return self.name("mirror", "STG_FOOD_PRICES")

    @property
    def databases(self) -> list[str]:
        return [f"{self.prefix}{d}" for d in ("raw", "staging", "warehouse", "analytics", "marts", "mirror")]


# The properties of a view that tell which build of every year it shows, and the newest load in each.
BUILDS, THROUGH = "pricelake.builds", "pricelake.through"

# The row order inside the raw files, kept with the raw rows so that cleaning reads the table only.
ROW_SEQ = T.StructType().add("file_time", "timestamp").add("file", "string").add("block", "long").add("position", "long")
# Raw rows and rejects are partitioned by load: one folder per load, however many files it brings.
LOAD_ID = T.StructField("load_id", T.StringType())
RAW_STORED = T.StructType([*S.RAW_TABLE.fields, T.StructField("row_seq", ROW_SEQ), LOAD_ID])
REJECTS_STORED = T.StructType([*S.REJECTS_TABLE.fields, LOAD_ID])


def _definitions(layers: Layers) -> list[tuple[str, T.StructType, str | None]]:
    return [
        (layers.raw, RAW_STORED, "load_id"),
        (layers.metadata, S.METADATA_TABLE, None),
        (layers.journal, S.JOURNAL_TABLE, None),
        (layers.files, S.FILES_TABLE, "load_id"),
        (layers.tests, S.TESTS_TABLE, None),
        (layers.staging, S.STAGING_TABLE, "year"),
        (layers.rejects, REJECTS_STORED, "load_id"),
        (layers.dim_date, S.DIM_DATE_TABLE, None),
        (layers.dim_market, S.DIM_MARKET_TABLE, None),
        (layers.dim_commodity, S.DIM_COMMODITY_TABLE, None),
        (layers.fact, S.FACT_TABLE, "year"),
    ]


def ensure_tables(spark: SparkSession, layers: Layers) -> list[str]:
    """Create what is missing and leave the rest alone; returns the tables created."""
    for database in layers.databases:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    created = []
    for name, schema, partition in _definitions(layers):
        if spark.catalog.tableExists(name):
            continue
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f" PARTITIONED BY (`{partition}`)" if partition else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by}")
        created.append(name)
    return created


def reset_tables(spark: SparkSession, layers: Layers, reset: bool = False) -> None:
    """Drop every layer and create it empty; refuses unless asked in so many words."""
    if not reset:
        raise ValueError("reset_tables drops all data: pass reset=True")
    for database in layers.databases:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    ensure_tables(spark, layers)


def is_empty(spark: SparkSession, name: str) -> bool:
    return spark.table(name).isEmpty()


def now(spark: SparkSession) -> datetime:
    """The session's local time; a load takes it once, so that all its tables share one stamp."""
    return spark.range(1).select(F.localtimestamp()).first()[0]


def fit(df: DataFrame, schema: T.StructType, stamp: str | None = None, moment: datetime | None = None) -> DataFrame:
    """Project to the table's columns in order, cast; absent columns are NULL and ``stamp`` is ``moment`` or now."""

    def column(field: T.StructField) -> Column:
        if field.name == stamp:
            return (F.localtimestamp() if moment is None else F.lit(moment).cast("timestamp_ntz")).alias(field.name)
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return F.col(f"`{field.name}`").cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count the rows while they are written, without a second pass."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def append_rows(
    df: DataFrame, name: str, stamp: str | None = "loaded_at", rebalance_by: str | None = None, moment: datetime | None = None
) -> int:
    """Append and return the row count, counted during the write.

    ``rebalance_by`` sizes the files of a partitioned table: AQE splits a hot partition over many
    tasks and merges small ones. It costs a shuffle, so leave it out where the rows arrive in order.
    """
    spark = df.sparkSession
    fitted = fit(df, spark.table(name).schema, stamp, moment)
    if rebalance_by:
        fitted = fitted.hint("rebalance", F.col(rebalance_by))
    watched, seen = counted(fitted)
    watched.write.mode("append").insertInto(name)
    return seen.get["rows"]


def publish_view(spark: SparkSession, name: str, source: str, expressions: Iterable[str], where: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(expressions)} FROM {source} WHERE {where}")


def clustered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows dealt out by ranges of ``order`` and sorted inside each: files of one write do not overlap, so a filter on
    its first columns skips most of them. A stored table has no other order."""
    columns = [F.col(c).asc_nulls_first() for c in order]
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns) if columns else df


def write_version(df: DataFrame, name: str, order: Sequence[str] = ()) -> str:
    """Write rows, clustered by ``order``, as a new version of a published table, which readers do not see yet."""
    version = f"{name}__v{uuid.uuid4().hex[:8]}"
    try:
        clustered(df, order).write.format("parquet").saveAsTable(version)
    except Exception:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    return version


def switch(spark: SparkSession, name: str, version: str) -> DataFrame:
    """Make ``version`` what readers of ``name`` see, in one statement, and drop the versions before it.

    The published name is a view, so there is no moment without it; a crash leaves the old version in place.
    """
    database, _, short = name.rpartition(".")
    held = {t.name: t.tableType for t in spark.catalog.listTables(database)}
    if held.get(short.lower(), "VIEW") != "VIEW":  # published as a table once
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for other in held:
        if other.startswith(f"{short.lower()}__v") and f"{database}.{other}" != version.lower():
            spark.sql(f"DROP TABLE IF EXISTS {database}.{other}")
    return spark.table(name)


def _property(spark: SparkSession, name: str, key: str) -> dict[int, str]:
    if not spark.catalog.tableExists(name):
        return {}
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return {int(year): value for year, value in json.loads(held.get(key, "{}")).items()}


def published_builds(spark: SparkSession, name: str) -> dict[int, str]:
    """Which build of every year readers of a table published by year see."""
    return _property(spark, name, BUILDS)


def published_through(spark: SparkSession, name: str) -> dict[int, datetime]:
    """The stamp of the newest rows in every year's build, where it is known."""
    return {year: datetime.fromisoformat(text) for year, text in _property(spark, name, THROUGH).items()}


def write_years(df: DataFrame, name: str, build: str, order: Sequence[str] = ()) -> list[int]:
    """Write the rows of some years, clustered by ``order``, as a new build, which readers do not see yet; returns the years."""
    spark, data = df.sparkSession, f"{name}__data"
    columns = [c for c in df.columns if c != "year"]
    rows = clustered(df.select(*columns, F.lit(build).alias("build"), "year"), ("year", *order) if order else ())
    rows.write.format("parquet").mode("append").partitionBy("build", "year").saveAsTable(data)
    return sorted(r[0] for r in spark.table(data).where(F.col("build") == build).select("year").distinct().collect())  # a calendar's worth


def of_builds(spark: SparkSession, name: str, builds: dict[int, str]) -> DataFrame:
    """The stored rows of these builds, one per year."""
    return spark.table(f"{name}__data").where(build_expression(builds)).drop("build")


def drop_build(spark: SparkSession, name: str, build: str, years: Iterable[int]) -> None:
    for year in years:
        spark.sql(f"ALTER TABLE {name}__data DROP IF EXISTS PARTITION (build = '{build}', year = {year})")


def drop_builds_but(spark: SparkSession, name: str, kept: set[tuple[int, str]]) -> None:
    """Drop the builds of a table published by year that are not among ``kept`` (year, build)."""
    for (spec,) in spark.sql(f"SHOW PARTITIONS {name}__data").collect():  # years times kept builds
        build, year = (part.split("=", 1)[1] for part in spec.split("/"))
        if (int(year), build) not in kept:
            drop_build(spark, name, build, [int(year)])


def build_expression(builds: dict[int, str]) -> Column:
    """The rows that belong to their year's build."""
    by: dict[str, list[int]] = {}
    for year, build in builds.items():
        by.setdefault(build, []).append(year)
    return reduce(lambda a, b: a | b, ((F.col("build") == build) & F.col("year").isin(years) for build, years in by.items()), F.lit(False))


def switch_years(spark: SparkSession, name: str, builds: dict[int, str], columns: Sequence[str], through: dict[int, datetime] | None = None) -> DataFrame:
    """Show every year's build to the readers of ``name`` in one statement; the builds before stay until they are dropped."""
    by: dict[str, list[str]] = {}
    for year, build in builds.items():
        by.setdefault(build, []).append(str(year))
    where = " OR ".join(f"(build = '{build}' AND year IN ({', '.join(years)}))" for build, years in by.items()) or "false"
    known = {BUILDS: builds, THROUGH: {year: moment.isoformat() for year, moment in (through or {}).items()}}
    properties = ", ".join(f"'{key}' = '{json.dumps({str(y): v for y, v in value.items()})}'" for key, value in known.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({properties}) AS SELECT {', '.join(columns)} FROM {name}__data WHERE {where}")
    return spark.table(name)


def publish_table(df: DataFrame, name: str, order: Sequence[str] = ()) -> DataFrame:
    """Build the rows into a new version, then show it in one switch."""
    return switch(df.sparkSession, name, write_version(df, name, order))


def keep_result(df: DataFrame, name: str) -> DataFrame:
    """Hold a result for reuse under a view name without running it again."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.createOrReplaceTempView(name)
    return kept


def preview(df: DataFrame, rows: int = 5) -> list:
    """A few rows to look at, from as few partitions as give them."""
    return df.take(rows)


def as_of(df: DataFrame, moment: Column, column: str = "loaded_at") -> DataFrame:
    """An append-only table as it was at ``moment``; the filter reaches the scan."""
    return df.where(F.col(column) <= moment)
