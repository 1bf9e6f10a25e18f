"""Incremental load of a landing folder: new files only, remembered by the stream's checkpoint.

The reports stay batch queries. The stream replaces nothing but the scan: each micro-batch of new
files goes through the same raw, clean, gate and staging steps as the load job, which are safe to
repeat if a batch is replayed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.load_job import build_marts, load_batch, writer
from ..schemas import CLEAN_KEY
from ..session import tuned
from ..sources import tables
from ..sources.files import exact_paths
from ..sources.tables import Layers

# The fixed columns of Spark's binaryFile source.
BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def new_files(spark: SparkSession, folder: str, pattern: str = "*.csv", per_batch: int = 1000) -> DataFrame:
    """A stream of the paths of files that appear in ``folder``; their content is not read here."""
    listing = spark.readStream.format("binaryFile").options(pathGlobFilter=pattern, maxFilesPerTrigger=per_batch)
    return listing.schema(BINARY_FILE).load(folder).select("path")


def load_new_files(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    layers: Layers = Layers(),
    dates: tuple[str, str] | None = None,
    pattern: str = "*.csv",
    per_batch: int = 1000,
    keys: Iterable[str] = CLEAN_KEY,
    mirror: bool = False,
    trend_pattern: str = "%maize%",
    wait: float = 600.0,
) -> StreamingQuery:
    """Load every file that has arrived since the last call, rebuild the marts, then stop; returns the started query."""
    tables.ensure_tables(spark, layers)

    def load(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # at most ``per_batch`` file names
        if paths:
            with tuned(spark), writer(spark, layers, wait) as lock:
                counts = load_batch(spark, exact_paths(paths), layers, dates, keys, mirror)
                lock.check()
                build_marts(spark, layers, trend_pattern, counts["years"], counts["loads"])

    stream = new_files(spark, folder, pattern, per_batch).writeStream.foreachBatch(load)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
