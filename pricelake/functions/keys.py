"""Key expressions: stable surrogate keys and null-safe key columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def _key_text(columns: Iterable[Column]) -> Column:
    parts = []
    for c in columns:
        text = c.cast("string")
        tagged = F.concat(F.length(text).cast("string"), F.lit(":"), text, F.lit(";"))
        parts.append(F.coalesce(tagged, F.lit("-;")))
    return F.concat(*parts)


def hash_key(*columns: Column) -> Column:
    """60-bit key of the business key, for dimensions; the same in every run and load order.

    Parts are length-prefixed and NULL has its own tag, so different keys never share a text.
    """
    digest = F.substring(F.md5(_key_text(columns)), 1, 15)
    return F.conv(digest, 16, 10).cast("bigint")


def row_fingerprint(*columns: Column) -> Column:
    """128-bit key text, for tables whose row count is too large for 60 bits."""
    return F.md5(_key_text(columns))


def match_columns(df: DataFrame, keys: Iterable[str], prefix: str = "_k_") -> tuple[DataFrame, list[str]]:
    """Add NULL-free copies of ``keys``: a filled value plus a flag per key.

    Plain equality on them is null-safe equality on the keys, and grouping, de-duplicating and
    joining on them all share one hash partitioning.
    """
    names, extra = [], {}
    for key in keys:
        filled = {"string": F.lit(""), "date": F.lit("1970-01-01").cast("date")}.get(
            df.schema[key].dataType.simpleString(), F.lit(0).cast(df.schema[key].dataType)
        )
        extra[f"{prefix}{key}"] = F.coalesce(F.col(key), filled)
        extra[f"{prefix}{key}_null"] = F.col(key).isNull()
        names += [f"{prefix}{key}", f"{prefix}{key}_null"]
    return df.withColumns(extra), names


def match_value(key: str, prefix: str = "_k_") -> Column:
    """``key`` again from the copies that ``match_columns`` adds."""
    return F.when(~F.col(f"{prefix}{key}_null"), F.col(f"{prefix}{key}")).alias(key)
