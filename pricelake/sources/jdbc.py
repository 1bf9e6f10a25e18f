"""JDBC sink and key read. The database itself is the user's; only its URL is given."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows per INSERT batch.
BATCH_ROWS = 1000


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_rows: int = BATCH_ROWS,
    max_connections: int = 32,
) -> None:
    """Append in batches; the number of parallel connections is bounded, not the number of rows."""
    options = {**(properties or {}), "batchsize": str(batch_rows), "numPartitions": str(max_connections)}
    df.write.jdbc(url, table, mode="append", properties=options)


def read_keys(
    spark: SparkSession,
    url: str,
    table: str,
    keys: Iterable[str],
    years: Iterable[int],
    date: str = "price_date",
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Only the key columns, one query per year so that no single task reads the whole table.

    Give the years of the incoming rows: the date is part of the key, so other years cannot match. Without any year there
    is nothing to match, and nothing is read.
    """
    predicates = [f"{date} >= DATE '{y}-01-01' AND {date} < DATE '{y + 1}-01-01'" for y in sorted(set(years))]
    options = dict(properties or {})
    df = spark.read.jdbc(url, table, predicates=predicates or ["1 = 0"], properties=options)
    return df.select(*keys)
