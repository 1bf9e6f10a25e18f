"""Tables that live for one job, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Read when a query begins; Spark then deletes the query's shuffle files when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files. Else these stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one beside the tables of the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


class Scratch:
    """Intermediate tables of one job: written once as Parquet, read many times, dropped when no longer needed.

    ``with Scratch(spark) as scratch`` drops everything at the end, also after a failure. Without ``with`` the tables
    last until ``clear`` or the end of the driver, because a result may still be read from them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
        atexit.register(self._clear_late)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back, so that what follows starts from the files and not from its lineage."""
        path = f"{self.root}/{name}"
        with shuffles_dropped(self.spark):
            df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        self._delete(f"{self.root}/{name}")

    def clear(self) -> None:
        self._delete(self.root)
        atexit.unregister(self._clear_late)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def _clear_late(self) -> None:
        """At the end of the driver the session may be gone already; then the folder's own retention has to do it."""
        if self.spark.sparkContext._jsc is not None:
            self._delete(self.root)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.clear()
