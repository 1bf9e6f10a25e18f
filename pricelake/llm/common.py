"""Small helpers that several operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: The white space between words in all operators that count words.
BLANKS = "\\x20\\x09-\\x0D"
WORD = f"[^{BLANKS}]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def values(column: pa.Array, step: int = 256) -> Iterator:
    """Python values of an Arrow column, few at a time, so that a batch of long texts is not held twice."""
    for start in range(0, len(column), step):
        yield from column.slice(start, step).to_pylist()


def fresh(taken: list[str], *names: str) -> list[str]:
    """Column names like ``names`` that clash with none of ``taken`` in any case."""
    used = {name.lower() for name in taken}
    lead = next("_" * n for n in range(1, len(used) + 3) if not any(("_" * n + name).lower() in used for name in names))
    return [lead + name for name in names]


def in_worker(kind: str, key: str, make: Callable):
    """``make(key)``, kept in the Python worker: Spark uses a worker again, and big tables need loading once only."""
    kept = sys.modules.setdefault("pricelake_worker_state", ModuleType("pricelake_worker_state")).__dict__
    if kept.get(kind, (None,))[0] != key:
        kept[kind] = (key, make(key))
    return kept[kind][1]


class Kept(dict):
    """Answers of a function by argument; the older ones go when there are too many."""

    def __init__(self, answer: Callable, most: int):
        super().__init__()
        self.answer, self.most, self.older = answer, most, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.answer(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found
