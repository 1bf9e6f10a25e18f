"""Runs of words against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from llm_fixtures import docs_of  # noqa: F401
from pricelake.llm import queries, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_lyndon(words):
    out = []
    for i in range(len(words)):
        j = i + 1
        while j < len(words) and words[j:] > words[i:]:
            j += 1
        out.append(j - i)
    return out


def plain_runs(words, least=6, times=4):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, times * q):
                found.setdefault((start, i + q - start), q)  # the smallest period comes first
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def looped_words(key, words):
    h = zlib.crc32(str(key).encode() if key is not None else b"")
    if h % 10 or not words:
        return words
    g = h // 10
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return [word if i < a else words[a + (i - a) % p] for i, word in enumerate(words)]


def some_words(rng, most=70):
    words = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, most))]
    if words and rng.random() < 0.5:
        at, p = rng.randrange(len(words)), rng.randint(1, 7)
        words[at:] = [words[at + (i - at) % p] if at + (i - at) % p < len(words) else 9 for i in range(at, len(words))]
    return words


def test_groups_give_the_lyndon_array():
    rng = random.Random(1)
    for _ in range(1500):
        words = some_words(rng)
        assert runs.lyndon_array(words) == plain_lyndon(words), words


@pytest.mark.parametrize("least, times", [(6, 4), (2, 2), (4, 3), (6, 5), (9, 2)])
def test_runs_are_those_of_brute_force(least, times):
    rng = random.Random(least * times)
    for _ in range(600):
        words = some_words(rng)
        assert runs.find_runs(words, least, times) == plain_runs(words, least, times), words


def test_cutting_keeps_runs_between_other_words():
    rng = random.Random(3)
    for _ in range(60):
        words = []
        while len(words) < 600:
            words += [f"w{rng.randrange(40)}" for _ in range(rng.randint(0, 60))]
            root = [f"w{rng.randrange(5)}" for _ in range(rng.randint(1, 9))]
            words += (root * 9)[: rng.randint(2, 9 * len(root))]
        assert runs.find_runs(words) == plain_runs(words)
    assert runs.find_runs([1] * 100_000) == [(0, 100_000, 1)]
    a, b = [0], [0, 1]
    while len(b) < 5000:
        a, b = b, b + a
    assert runs.find_runs(b[:5000], 2, 2) == plain_runs(b[:5000], 2, 2) and runs.find_runs(b[:5000]) == []


def test_query_against_brute_force(spark, docs_of, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["ra", "to", "mi", "é", " x", "x y"]) for _ in range(rng.randint(1, 150))) for _ in range(150)]
    texts += [None, "", " \t\n", "one", "a " * 20_000, "ab\x0bab\x0cab\rab\nab\tab ab", texts[0], "  " * 7]
    rows = [(i * 7, text, "s") for i, text in enumerate(texts)] + [(None, "a b " * 6, "s"), (0, texts[0], "s"), (0, texts[1], "s")]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    expected = []
    for key, text, _ in rows:
        words = looped_words(key, WORD.findall(text or ""))
        held = [(0, len(words), 1)] if len(words) > 10_000 else plain_runs(words)
        s, n, q = max(held, key=lambda r: (r[1], -r[0], -r[2])) if held else (None, None, None)
        gone = {i for a, size, p in held for i in range(a + p, a + size)}
        listed = "".join(f"{a},{size},{p}\n" for a, size, p in held)
        kept = " ".join(word for i, word in enumerate(words) if i not in gone)
        expected.append((key, len(held), s, n, q, n and 1000 * n // q, *(hashlib.sha256(t.encode()).hexdigest() for t in (listed, kept))))
    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.collect()), key=order) == sorted(expected, key=order)
    assert sum(r[1] > 0 for r in expected) > 10


def test_other_columns_stay_and_empty_tables_are_empty(spark, docs_of):
    docs = docs_of([(1, "x y x y x y x y z", "s")]).withColumn("runs", runs.F.lit("other"))
    found, runs_name, collapsed = runs.word_runs(docs)
    row = found.first()
    assert row["runs"] == "other" and row["key"] == "other key" and [tuple(r) for r in row[runs_name]] == [(0, 8, 2)] and row[collapsed] == "x y z"
    assert runs.digests(docs_of([])).collect() == []
