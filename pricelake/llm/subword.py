"""A quality classifier over supervised subword embeddings.

A text is the bag of its words, pairs of neighbouring words and character n-grams of every word with its two ends marked.
All are hashed into one table of learnt vectors; a text's vector is the mean over its bag, and a softmax over the classes
follows. A pair of equal words is one feature whatever the word, so repetition is seen in words that were never seen. One
more feature stands in every text, so that a text without words has a vector too. Vectors and softmax are trained together by
stochastic gradient descent on at most ``SAMPLE`` labelled texts outside the held-out part, those whose ids have the lowest
hashes; a text's features are hashed in tasks and come to the driver as one count per used bucket.

Scoring needs one number per bucket, the difference of the classes along its vector: hashes, look-ups and sums run over
whole arrays of characters, and every text is read whole.

Words are runs of anything but blanks (space, tab to carriage return). Null and empty texts hold the common feature alone.
Labels that are null are not learnt from; of an id with several labels the highest counts. Without usable labels every score
is 0. Repeated rows are scored one by one. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import values
from .shingles import BASE, U, _power, mix

#: Labelled texts that are learnt from, at most.
SAMPLE = 4_000
#: Buckets as a power of two, numbers in a vector, lengths of the character n-grams.
BITS, SIZE, GRAMS = 16, 8, (3, 4, 5)
EPOCHS, RATE, SEED = 8, 2.0, 1
PREDICTED = 0.7
#: Characters of texts that are hashed together, unless one text has more, and n-grams per step.
TOGETHER, STEP = 1 << 15, 1 << 18
COMMON, AGAIN = 0, 1  # buckets of the feature of every text and of a repeated word


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (mix(hashes) >> U(64 - bits)).astype(np.int64)


def features(texts: list[str], bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and texts (by number, ascending) of the features of all ``texts``, in several pairs of arrays."""
    yield np.full(len(texts), COMMON), np.arange(len(texts))
    codes = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    # One blank stays before every word, and one at the end.
    kept = ~blank
    kept[:-1] |= ~blank[1:]
    kept[-1] = True
    of = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), np.flatnonzero(kept), "left")
    codes = np.where(blank, np.uint32(32), codes)[kept].astype(U)
    ends = np.flatnonzero(codes == 32)
    if len(ends) < 2:
        return
    starts, ends = ends[:-1] + 1, ends[1:]
    sums = np.cumsum(codes * _power(0, len(codes)), dtype=U)
    words = (sums[ends - 1] - sums[starts - 1]) * _power(1, len(codes))[starts] + U(1)
    texts_of = of[starts]
    yield _bucket(words, bits), texts_of
    beside = np.flatnonzero(texts_of[1:] == texts_of[:-1])
    pairs = _bucket(words[beside] * U(BASE) + words[beside + 1], bits)
    yield np.where(words[beside] == words[beside + 1], AGAIN, pairs), texts_of[beside]
    inner = np.cumsum(codes == 32)
    for at in range(0, len(codes), STEP):
        part = codes[at : at + STEP + max(GRAMS) - 1]
        hashes = np.zeros(min(STEP, len(codes) - at), U)
        for size in range(1, max(GRAMS) + 1):
            many = min(STEP, len(part) - size + 1)
            if many <= 0:
                break
            hashes = hashes[:many] + part[size - 1 : size - 1 + many] * U(pow(BASE, size, 1 << 64))
            if size in GRAMS:
                # Blanks only at the ends: an n-gram is of one word.
                whole = np.flatnonzero(inner[at + size - 2 : at + size - 2 + many] == inner[at : at + many])
                yield _bucket(hashes[whole] + U(size), bits), of[at + 1 + whole]


def _chunks(column: pa.Array) -> Iterator[list[str]]:
    held, size = [], 0
    for text in values(column):
        held.append(text or "")
        size += len(held[-1])
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 4 == 2


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], bits: int = BITS, size: int = SIZE, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> np.ndarray:
    """Per bucket, how much its vector speaks for class 1 over class 0. ``bags`` are (buckets, counts)."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / size, 1 / size, (1 << bits, size)).astype(np.float32)
    classes = np.zeros((2, size), np.float32)
    shares = [(counts / counts.sum()).astype(np.float32) for _, counts in bags]
    step, steps = 0, epochs * len(bags)
    for _ in range(epochs):
        for k in rng.permutation(len(bags)).tolist():
            at, share = bags[k][0], shares[k]
            hidden = share @ vectors[at]
            z = classes @ hidden
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[k]] -= 1
            p *= -rate * (1 - step / steps)
            vectors[at] += share[:, None] * (p @ classes)
            classes += p[:, None] * hidden
            step += 1
    return (vectors @ (classes[1] - classes[0])).astype(np.float64)


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", sample: int = SAMPLE) -> np.ndarray | None:
    """One number per bucket, learnt from at most ``sample`` labelled texts outside the held-out part."""
    usable = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull() & ~held_out(F.col(id_column)))
    usable = usable.groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).cast("int").alias("label"))
    chosen = usable.orderBy(F.xxhash64("id"), "id").limit(sample)  # bounded by ``sample``, so it may be broadcast
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(values(batch.column(0), 16), batch.column(1).to_pylist(), strict=True):
                counts = np.zeros(1 << BITS, np.int64)
                for found, _ in features([text or ""]):
                    counts += np.bincount(found, minlength=1 << BITS)
                used = np.flatnonzero(counts)
                columns = [pa.array([label], pa.int32()), *(pa.array([a.astype("<i4").tobytes()], pa.binary()) for a in (used, counts[used]))]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "buckets", "counts"])

    rows = texts.join(F.broadcast(chosen), "id").select("text", "label").mapInArrow(run, "label int, buckets binary, counts binary")
    # At most ``sample`` ids with a count per bucket; sorted, because the order of the rows decides what is learnt.
    found = sorted((bytes(r["buckets"]), bytes(r["counts"]), r["label"]) for r in rows.collect())
    if not found:
        return None
    return train([(np.frombuffer(b, "<i4"), np.frombuffer(c, "<i4")) for b, c, _ in found], [label for *_, label in found])


def score(docs: DataFrame, model: np.ndarray | None, id_column: str = "doc_id", text_column: str = "text", predicted: float = PREDICTED) -> DataFrame:
    """``id, held_out, score, predicted`` of every text."""
    table = None if model is None else model.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0)]
            for chunk in _chunks(batch.column(1)):
                if table is None:
                    found.append(np.zeros(len(chunk)))
                    continue
                sums, many = np.zeros(len(chunk)), np.zeros(len(chunk))
                for at, of in features(chunk):
                    sums += np.bincount(of, table[at], len(chunk))
                    many += np.bincount(of, minlength=len(chunk))
                found.append(1 / (1 + np.exp(-np.clip(sums / many, -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found))], names=[id_column, "score"])

    columns = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    scored = columns.mapInArrow(run, f"`{id_column}` {dict(docs.dtypes)[id_column]}, score double")
    return scored.select(id_column, held_out(F.col(id_column)).alias("held_out"), "score", (F.col("score") >= predicted).cast("int").alias("predicted"))
