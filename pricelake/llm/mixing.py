"""Mixing sources to target weights by systematic sampling, with built-in functions only.

Every document of a source expects the same number of copies (target / size of the source, 3 at most). Documents of a
source stand in one line, ordered by size, and a running sum of expected copies starts at one random offset per source.
A document is taken once for every whole number that its stretch of the sum crosses, so neighbours of like size share
the rounding and the taken words stay near the target.

A place in the line is a rank, counted in three bounded steps so that no task holds a whole source: rows of a cell
(source, band of sizes, salted bucket), cells of a band, bands of a source.

Texts that are null or empty have size 0. A null source is a source of its own, last in order. Repeated rows are taken
one by one. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import Scratch
from .common import WORD

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
ROWS_PER_BUCKET = 100_000
BUCKETS = 64


def spread(value: Column) -> Column:
    """A whole number from 0 to 2^32 - 1 that looks random, equal in every engine that has MD5."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: shares by weight of all sizes, none above ``most`` sizes.

    Excess is dealt out again by weight until no target is above its cap. That ends where all uncapped sources have
    the same target per weight, so sorting by cap per weight finds it at once: a source is capped if dealing the rest
    to it and all later ones would exceed its cap. One row per source goes through one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int"))
    listed = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    line = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, later = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    level = rest / F.sum("weight").over(later)  # words per weight if this source and all later ones share the rest
    staged = listed.withColumn("level", level)
    # The level rises while capped sources leave the line and falls once an uncapped one does.
    staged = staged.withColumn("fair", F.max("level").over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("fair") * F.col("weight"))
    return staged.select("source", "source_size", target.alias("target"))


def word_counts(docs: DataFrame, text_column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[int, ...] = WEIGHTS, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` of every document."""
    sized, starts, buckets = _starts(docs, id_column, text_column, source_column, weights, scratch or Scratch(docs.sparkSession))
    taken = _taken(_placed(sized, buckets), starts, ["size", "id"])
    return taken.select(F.col("id").alias(id_column), "source", "size", "source_size", "target", "copies")


def sample(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[int, ...] = WEIGHTS, scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    _, starts, buckets = _starts(docs, id_column, text_column, source_column, weights, scratch or Scratch(docs.sparkSession))
    sized = _sized(docs, id_column, text_column, source_column, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"))
    taken = _taken(_placed(sized, buckets, "whole"), starts, ["size", "id", F.xxhash64("whole")])
    repeated = taken.where("copies > 0").select("whole", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return repeated.select("whole.*")


def _sized(docs: DataFrame, id_column: str, text_column: str, source_column: str, *more: Column) -> DataFrame:
    return docs.select(F.col(id_column).alias("id"), F.col(source_column).alias("source"), word_counts(docs, text_column).alias("size"), *more)


def _placed(sized: DataFrame, buckets: int, *more: str) -> DataFrame:
    return sized.select(
        "id", "source", "size", *more, _name(F.col("source")).alias("name"),
        F.floor(F.sqrt("size")).alias("band"),
        F.pmod(F.coalesce(spread(F.col("id")), F.lit(0)), F.lit(buckets)).alias("bucket"),
    )


def _name(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))  # so that null matches null in joins


def _starts(docs: DataFrame, id_column: str, text_column: str, source_column: str, weights: tuple[int, ...], scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """Sizes of all documents; per cell its first rank in the source's line, with size and target of the source; buckets."""
    sized = scratch.store(_sized(docs, id_column, text_column, source_column), "sizes")
    buckets = BUCKETS + sized.count() // ROWS_PER_BUCKET
    cells = _placed(sized, buckets).groupBy("name", "source", "band", "bucket").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    bands = cells.groupBy("name", "source", "band").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    goals = targets(bands.groupBy("source").agg(F.sum("words").alias("source_size")), weights)
    goals = goals.select(_name(F.col("source")).alias("name"), "source_size", "target")
    before = lambda by, order: F.coalesce(
        F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    band_starts = bands.select("name", "band", before(["name"], "band").alias("in_source")).join(goals, "name")
    cell_starts = cells.select("name", "band", "bucket", before(["name", "band"], "bucket").alias("in_band"))
    return sized, cell_starts.join(band_starts, ["name", "band"]), buckets


def _taken(placed: DataFrame, starts: DataFrame, order: list) -> DataFrame:
    """``placed`` with ``copies``: whole numbers that a document's stretch of the running sum crosses."""
    rank = F.row_number().over(Window.partitionBy("name", "band", "bucket").orderBy(*order))
    ranked = placed.withColumn("rank", rank).join(starts, ["name", "band", "bucket"])
    place = F.col("in_source") + F.col("in_band") + F.col("rank")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = spread(F.col("name")) / 4294967296.0
    copies = F.floor(offset + place * expected) - F.floor(offset + (place - 1) * expected)
    return ranked.withColumn("copies", copies.cast("long"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM {docs}
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS cap,
         (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), fair AS (
  SELECT *, max(level) OVER () AS fair FROM levels
), goals AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), fair * weight) AS target,
         CAST(('0x' || substr(md5(coalesce('s' || source, 'null')), 1, 8)) AS BIGINT) / 4294967296.0 AS shift
  FROM fair
), placed AS (
  SELECT doc_id, source, size, floor(sqrt(size)) AS band,
         coalesce(CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT), 0)
           % (64 + (SELECT count(*) FROM sized) // 100000) AS bucket
  FROM sized
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY band, bucket, size, doc_id NULLS FIRST) AS place FROM placed
), taken AS (
  SELECT r.doc_id, r.source, r.size, g.source_size, g.target, g.shift, r.place,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS expected
  FROM ranked r JOIN goals g ON r.source IS NOT DISTINCT FROM g.source
), mixed AS (
  SELECT doc_id, source, size, source_size, target,
         CAST(floor(shift + place * expected) - floor(shift + (place - 1) * expected) AS BIGINT) AS copies
  FROM taken
)
"""
