"""Checksums of spans and importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import docs_of  # noqa: F401
from pricelake.llm import resampling
from pricelake.llm.crc import BLOCK, span_crcs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_checksums_of_spans():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 100_000).astype(np.uint8)
    sizes = np.concatenate([np.arange(4 * BLOCK + 3), rng.integers(0, 50_000, 20)])
    starts = rng.integers(0, 50_000, len(sizes))
    expected = [zlib.crc32(data[s : s + n].tobytes()) for s, n in zip(starts, sizes)]
    assert span_crcs(data, starts, starts + sizes).tolist() == expected
    assert len(span_crcs(data, starts[:0], starts[:0])) == 0


def plain_features(text, least, most):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, least, most, buckets, seed, share, least_words):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    held = [(key, *plain_features(text, least, most)) for key, text, _ in rows]
    s, t = Counter(bucket(f) for *_, fs in held for f in fs), Counter(bucket(f) for text in target for f in plain_features(text, least, most)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out = []
    for key, n, fs in held:
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in fs)
        out.append([key, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    drawn = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {id(r): k for k, r in enumerate(drawn[: share * len(drawn) // 100], 1)}
    return [(r[0], *r[2:], ranks.get(id(r))) for r in out]


@pytest.mark.parametrize("least, most, buckets, share", [(1, 1, 10_000, 10), (1, 3, 97, 50), (2, 2, 1000, 100)])
def test_resampling_is_that_of_plain_python(spark, docs_of, least, most, buckets, share):
    rng = random.Random(least + most)
    parts = ["Ra", "to", "mI", "é", "É", "x1", "\x00", "-", "a.b", "ſ", "q" * 70, "日本"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", " . ", "z" * 100_000, "word " * 30_000, *texts[:5]]
    rows = [(i * 3, text, "s") for i, text in enumerate(texts)] + [(None, texts[1], "s"), (None, "a " * 25, "s"), (3, texts[1], "s"), (3, texts[1], "s")]
    target = [*(" ".join(rng.choice(parts[:6]) for _ in range(40)) for _ in range(20)), None, ""]
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, score int")
    found = resampling.resample(docs_of(rows), wanted, least=least, most=most, buckets=buckets, seed=7, share=share, words=20)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    order = lambda r: tuple(map(str, r))
    expected = plain(rows, target, least, most, buckets, 7, share, 20)
    assert sorted(map(tuple, found.collect()), key=order) == sorted(expected, key=order)
    assert sum(r[-1] is not None for r in expected) > 10


def test_ranks_of_one_row_without_end(spark, docs_of):
    """Equal rows are dealt over all ranges, and their ranks are 1, 2, 3 ... all the same."""
    docs = docs_of([(5, "a b c d e f", "s")]).crossJoin(spark.range(3000).select("id").withColumnRenamed("id", "copy"))
    found = resampling.resample(docs, docs_of([]), words=3).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 301)) and len(found) == 3000


def test_empty_tables(spark, docs_of):
    assert resampling.resample(docs_of([]), docs_of([])).collect() == []
    only = resampling.resample(docs_of([(1, None, "s")]), docs_of([(1, "x", "s")])).first()
    assert (only["n_features"], only["weight"], only["rank"]) == (0, 0, None)
