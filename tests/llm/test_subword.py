"""The quality classifier: its features, held-out accuracy, and what labels it may see."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import docs_of  # noqa: F401
from pricelake.llm import queries, subword

SAMPLE = "/root/testdata/sf0.01"
WORDS = [a + b + c for a in "abcdefgh" for b in ("ra", "to", "mi") for c in ("lu", "ne", "so")]


def counts_of(texts, number):
    return sum((np.bincount(at[of == number], minlength=1 << subword.BITS) for at, of in subword.features(texts)), np.zeros(1 << subword.BITS, int))


def plain_counts(text):
    """The same bag from words and slices: every distinct feature asks for its bucket as the only word of a text."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(g for w in words for n in subword.GRAMS for marked in [f" {w} "] for g in (marked[i : i + n] for i in range(len(marked) - n + 1)))
    return len(words), sum(grams.values()), Counter(a == b for a, b in zip(words, words[1:]))


def test_features_of_a_text_do_not_depend_on_the_others():
    texts = ["Ra to mi", "", "x", "a  a\ta b\n\nc", "é" * 50, "  ", "日本 日本 , ,", "w" * 3000, "\U0001f600 ok"]
    for number, text in enumerate(texts):
        alone = counts_of([text], 0)
        assert (counts_of(texts, number) == alone).all(), text
        words, grams, pairs = plain_counts(text)
        assert alone.sum() == 1 + words + grams + pairs.total() and alone[subword.COMMON] >= 1 and alone[subword.AGAIN] >= pairs[True]
    one, other = counts_of(["lo lo lo"], 0), counts_of(["zu zu zu"], 0)
    assert one[subword.AGAIN] == other[subword.AGAIN] == 2
    step, subword.STEP = subword.STEP, 7
    assert (counts_of(texts, 3) == counts_of([texts[3]], 0)).all()
    subword.STEP = step
    assert (counts_of(texts, 7) == counts_of([texts[7]], 0)).all()


def labelled(spark, rng, n):
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(10, 60))]
        good = rng.random() < 0.7
        if not good:
            words = [w + "$$$" for w in words] if i % 2 else [w for w in words[:6] for _ in range(9)]
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(good)))
    return rows, labels


def test_held_out_labels_are_not_seen_and_are_met(spark, docs_of):
    rows, labels = labelled(spark, random.Random(1), 600)
    kinds = "doc_id long, quality int"
    docs = docs_of([*rows, (9001, None, "s"), (9002, "", "s"), (9003, "ra " * 30_000, "s"), (None, "ra to", "s"), rows[0]])
    held = {i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2}
    model = subword.learn(docs, spark.createDataFrame([*labels, (None, 0), (9001, None)], kinds))
    lied = subword.learn(docs, spark.createDataFrame([(i, 1 - y if i in held else y) for i, y in labels], kinds))
    assert (model == lied).all()
    found = subword.score(docs, model).collect()
    assert len(found) == 605 and found[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    by = {r["doc_id"]: r for r in found}
    assert np.mean([by[i]["predicted"] == y for i, y in labels if i in held]) > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"] or "").encode()) % 4 == 2) for r in found if r["doc_id"] != 0)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    assert by[9001]["score"] == by[9002]["score"]


def test_without_labels_and_rows(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = docs_of([(1, "a b", "s"), (2, None, "s")])
    assert subword.learn(docs, none) is None
    assert [r["score"] for r in subword.score(docs, None).collect()] == [0.0, 0.0]
    empty = docs_of([])
    assert subword.score(empty, subword.learn(empty, none)).collect() == []


def test_accuracy_on_the_sample_tables(spark):
    found = {r["doc_id"]: r for r in queries.op12_quality_embeddings(spark, SAMPLE).collect()}
    labels = spark.read.parquet(f"{SAMPLE}/labels.parquet").collect()
    assert len(found) == 1000
    right = [(found[r["doc_id"]]["predicted"], r["quality"]) for r in labels if found[r["doc_id"]]["held_out"]]
    assert np.mean([a == b for a, b in right]) > 0.95 and np.mean([a for a, b in right if b]) > 0.97
