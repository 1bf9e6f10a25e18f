"""Load metadata: one JSON record of counts and quality notes per source file."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


def file_stats(
    cleaned: DataFrame, file: str = "source_file", checks: Iterable = (), counters: Mapping[str, int] | None = None,
    mirror_error: str | None = None,
) -> DataFrame:
    """file_name and ``stats``, a variant with the row counts and an array of quality notes.

    ``checks`` (rows of the quality report), ``counters`` and why the second target failed are of the whole load; the
    record of every file holds them.
    """
    counts = cleaned.groupBy(F.col(file).alias("file_name")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("date").isNull()).alias("no_date"),
        F.count_if(F.col("market").isNull()).alias("no_market"),
        F.count_if(F.col("price_kes").isNull()).alias("no_price"),
        F.count_if("is_valid_price").alias("valid"),
    )

    def note(text: str, column: str) -> Column:
        return F.when(F.col(column) > 0, F.concat(F.lit(text + ": "), F.col(column).cast("string")))

    notes = F.array_compact(
        F.array(
            note("rows without a date", "no_date"),
            note("rows without a market", "no_market"),
            note("rows without a price", "no_price"),
        )
    )
    of_load = []
    if checks:
        fields = ("name", "status", "level", "detail", "value")
        made = [F.struct(*[F.lit(r[f]).cast("string").alias(f) for f in fields]) for r in checks]
        of_load.append(F.array(*made).alias("checks"))
    if counters:
        of_load.append(F.struct(*[F.lit(n).alias(name) for name, n in counters.items()]).alias("cleaning"))
    if mirror_error:
        of_load.append(F.lit(mirror_error).alias("mirror_error"))
    record = F.struct("rows", "valid", notes.alias("quality_notes"), *of_load)
    return counts.select("file_name", F.parse_json(F.to_json(record)).alias("stats"))


def flatten_notes(metadata: DataFrame, path: str = "$.quality_notes") -> DataFrame:
    """One row per note; records without notes give none."""
    notes = F.try_variant_get("stats", path, "array<string>")
    kept = [c for c in metadata.columns if c != "stats"]
    return metadata.select(*kept, F.explode(notes).alias("quality_note"))


def json_field(df: DataFrame, column: str, path: str, dtype: str, into: str) -> DataFrame:
    """A typed value out of a JSON text; NULL for a missing path or text that is not JSON."""
    return df.withColumn(into, F.try_variant_get(F.try_parse_json(column), path, dtype))
