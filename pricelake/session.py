"""Session settings for our own runs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# The JVM never compiles a method above 8000 bytes of code. Cleaning all columns at once is such a
# method if it is generated as one; with this limit Spark generates it in small methods.
CODE_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def build_session(app: str = "pricelake", cores: str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A local session for tests and benchmarks; a cluster job brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {**SETTINGS, CODE_LIMIT[0]: CODE_LIMIT[1], "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def tuned(spark: SparkSession) -> Iterator[SparkSession]:
    """Set what the cleaning plans need for the length of a job, then put the caller's setting back."""
    before = spark.conf.get(CODE_LIMIT[0], None)
    spark.conf.set(*CODE_LIMIT)
    try:
        yield spark
    finally:
        spark.conf.unset(CODE_LIMIT[0]) if before is None else spark.conf.set(CODE_LIMIT[0], before)
