"""Importance resampling towards a target distribution: hashed features, gains per bucket, Gumbel top share.

Words are runs of digits, letters a-z and characters beyond ASCII, after A-Z went to lower case. Features are all runs of
``least`` to ``most`` neighbouring words, joined by one blank, repeats counted. A feature's bucket is its CRC-32 modulo
``buckets``, computed for all features of many texts at once (``crc``). A bucket's gain is the scaled log of how much
commoner it is in the target than in the documents, both smoothed by one. A document weighs the sum of its gains; a Gumbel
number from the seed and its id is added, and the highest scores are drawn, which samples by weight without putting back.

Counting reads every text whole; what comes to the driver is one number per bucket and one per partition of the ordering.
Ranks need no task that sees all rows: scores are dealt by ranges, sorted inside a range, and ranges count up.

Null and empty texts have no features and weight 0. Null ids hash like an empty id and stand last among equal scores;
rows equal in score and id follow in any order. Repeated rows are scored one by one. Other columns are ignored. An empty
target gives gains against an even distribution, an empty table an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .common import values
from .crc import span_crcs

BUCKETS = 10_000
SEED = 2024
SHARE = 10
WORDS = 20
#: Bytes of texts that are hashed together, unless one text has more, and features per step.
TOGETHER, STEP = 1 << 20, 1 << 16


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts, one blank after each, and starts, ends and text of every word."""
    raw = np.frombuffer("\n".join([*texts, ""]).encode(), np.uint8)
    raw = raw + np.uint8(32) * ((raw >= 65) & (raw <= 90))
    inside = (raw >= 128) | ((raw >= 97) & (raw <= 122)) | ((raw >= 48) & (raw <= 57))
    after = np.append(False, inside[:-1]) & ~inside
    kept = inside | after
    of = np.searchsorted(np.cumsum([len(t.encode()) + 1 for t in texts]), np.flatnonzero(after))
    data = np.where(after, np.uint8(32), raw)[kept]
    ends = np.flatnonzero(data == 32)
    return data, np.append(0, ends[:-1] + 1)[: len(ends)], ends, of


def features(words: tuple, least: int, most: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and texts (by number, ascending) of the features of ``words_of`` some texts, some at a time."""
    data, starts, ends, of = words
    for size in range(least, most + 1):
        last = np.arange(size - 1, len(ends))
        last = last[of[last] == of[last - size + 1]]
        for at in range(0, len(last), STEP):
            some = last[at : at + STEP]
            yield span_crcs(data, starts[some - size + 1], ends[some]) % np.uint32(buckets), of[some]


def _chunks(column: pa.Array) -> Iterator[list[str]]:
    """Texts of a column, about ``TOGETHER`` characters at a time."""
    held, size = [], 0
    for text in values(column):
        held.append(text or "")
        size += len(held[-1])
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def bucket_counts(texts: DataFrame, least: int = 1, most: int = 1, buckets: int = BUCKETS) -> list[int]:
    """How many features of all ``texts`` (first column) fall into every bucket; a task passes on one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for chunk in _chunks(batch.column(0)):
                for found, _ in features(words_of(chunk), least, most, buckets):
                    counts += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    counted = texts.select(texts.columns[0]).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * buckets
    for row in counted.collect():  # ``buckets`` rows at most
        out[row["bucket"]] = row["n"]
    return out


def gains(documents: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 ln) of how much likelier every bucket is in the target than in the documents."""
    s, t = np.array(documents, float), np.array(target, float)
    odds = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(odds)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, id_column: str = "doc_id", text_column: str = "text", least: int = 1, most: int = 1) -> DataFrame:
    """``id, n_words, n_features, weight`` of every text."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for chunk in _chunks(batch.column(1)):
                words, sums = words_of(chunk), np.zeros((3, len(chunk)), np.int64)
                sums[0] = np.bincount(words[3], minlength=len(chunk))
                for at, of in features(words, least, most, buckets):
                    edges = np.append(0, np.flatnonzero(np.diff(of)) + 1)
                    sums[1, of[edges]] += np.diff(np.append(edges, len(of)))
                    sums[2, of[edges]] += np.add.reduceat(gain[at], edges)
                found.append(sums)
            together = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, together)], names=["id", "n_words", "n_features", "weight"])

    columns = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return columns.mapInArrow(run, f"id {dict(docs.dtypes)[id_column]}, n_words long, n_features long, weight long")


def scored(weights: DataFrame, seed: int = SEED) -> DataFrame:
    """``weights`` with ``score``: the weight and a Gumbel number that the seed and the id decide."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weights.withColumn("score", F.col("weight") + gumbel)


def ranked(rows: DataFrame, scratch: Scratch, share: int = SHARE, words: int = WORDS) -> DataFrame:
    """``rows`` with ``rank`` from 1 for the ``share`` per cent highest scores of those with ``words`` words, else null.

    Rows are dealt by ranges of (score, id) and sorted inside each, and the stored number of a row tells its range and
    place. ``uid`` parts equal rows, so a range holds no more than its share even if one row repeats without end.
    """
    rows = scratch.store(rows.withColumn("uid", F.monotonically_increasing_id()), "scored")
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("uid")]
    dealt = rows.where(F.col("n_words") >= words).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = scratch.store(dealt.drop("uid").withColumn("place", F.monotonically_increasing_id()), "dealt")
    part, place = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = sorted(tuple(r) for r in dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # a row per range
    total, starts = 0, []
    for number, size in sizes:
        starts.append((number, total))
        total += size
    starts = rows.sparkSession.createDataFrame(starts, "part long, before long")
    rank = F.col("before") + place + 1
    drawn = dealt.join(F.broadcast(starts), part == F.col("part")).withColumn("rank", F.when(rank <= share * total // 100, rank))
    rest = rows.where(F.col("n_words") < words).withColumn("rank", F.lit(None).cast("long"))
    names = [c for c in rows.columns if c != "uid"]
    return drawn.select(*names, "rank").unionByName(rest.select(*names, "rank"))


def resample(
    docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text", target_column: str = "text",
    least: int = 1, most: int = 1, buckets: int = BUCKETS, seed: int = SEED, share: int = SHARE, words: int = WORDS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``id, n_features, weight, score, rank`` of every document; ``rank`` is null for those not drawn."""
    scratch = scratch or Scratch(docs.sparkSession)
    held = bucket_counts(docs.select(text_column), least, most, buckets)
    gain = gains(held, bucket_counts(target.select(target_column), least, most, buckets))
    rows = scored(weighed(docs, gain, id_column, text_column, least, most), seed)
    found = ranked(rows, scratch, share, words)
    return found.select(F.col("id").alias(id_column), "n_features", "weight", "score", "rank")


#: Checksums are computed per distinct word, byte by byte, from a table that the first lines make from the polynomial.
ORACLE = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda r, i:
           CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS step
), held AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words, row_number() OVER () AS uid FROM {docs}
), wanted AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM {target}
), listed AS (
  SELECT uid, unnest(words) AS word FROM held
), hashed AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(hex(word)) // 2),
           lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT))),
           lambda r, b: xor(r >> 8, step[(xor(r, b) & 255) + 1]))) % 10000 AS bucket
  FROM (SELECT word FROM listed UNION SELECT word FROM wanted), crc
), counted AS (
  SELECT bucket, CAST(sum(s) AS DOUBLE) AS s, CAST(sum(t) AS DOUBLE) AS t
  FROM (SELECT word, count(*) AS s, 0 AS t FROM listed GROUP BY word
        UNION ALL SELECT word, 0, count(*) FROM wanted GROUP BY word) JOIN hashed USING (word) GROUP BY bucket
), gained AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((SELECT coalesce(sum(s), 0) FROM counted) + 10000)
           / ((s + 1) * ((SELECT coalesce(sum(t), 0) FROM counted) + 10000)))) AS BIGINT) AS gain FROM counted
), weighed AS (
  SELECT uid, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM listed JOIN hashed USING (word) JOIN gained USING (bucket) GROUP BY uid
), scored AS (
  SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE)) / 4294967296))) AS BIGINT) AS score
  FROM held LEFT JOIN weighed USING (uid)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id ASC NULLS LAST) AS place FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank
FROM placed
"""
