"""Mixing: targets by dealing out step by step, copies near the target, DuckDB on the same rows."""

import random

import duckdb
import pytest

from llm_fixtures import docs_of  # noqa: F401
from pricelake.llm import mixing as M


def dealt(sizes: dict, weights=(1, 2, 3), most=3):
    """Targets by the rule as written: share by weight, cap, deal the excess out again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while open_ and rest > 1e-9:
        share = rest / sum(weight[s] for s in open_)
        rest = 0.0
        for s in list(open_):
            target[s] += share * weight[s]
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                rest += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return target


def rows_of(rng, n=600):
    out = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["hot"] * 6 + ["b", "a", "é", "z", None])) for i in range(n)]
    return out + [(5000, None, "small"), (5001, "", "small"), (5002, "\x0b one\ttwo ", "tiny"), (None, "x y", "a"), (7, "again", "a")]


def test_targets_and_words(spark, docs_of):
    rows = rows_of(random.Random(1))
    found = M.mix(docs_of(rows)).collect()
    assert len(found) == len(rows)
    sizes, taken, copies = {}, {}, {}
    for r in found:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 3
    expected = dealt(sizes)
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(expected[r["source"]])
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 60, s
    again = M.mix(docs_of(rows)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_rows_are_taken_whole(spark, docs_of):
    rows = rows_of(random.Random(2), 100)
    docs = docs_of(rows)
    mixed = {r["doc_id"]: r["copies"] for r in M.mix(docs).collect() if r["doc_id"] not in (7, None)}
    sampled = M.sample(docs)
    assert sampled.columns == docs.columns
    seen = {}
    for r in sampled.collect():
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
    assert {i: n for i, n in seen.items() if i not in (7, None)} == {i: n for i, n in mixed.items() if n}


def test_same_as_duckdb_and_empty(spark, docs_of):
    rows = rows_of(random.Random(3), 300)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    expected = con.execute(M.ORACLE.format(docs="documents") + "SELECT doc_id, size, source_size, target, copies FROM mixed").fetchall()
    got = M.mix(docs_of(rows)).select("doc_id", "size", "source_size", "target", "copies").collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert M.mix(docs_of([])).collect() == [] and M.sample(docs_of([])).collect() == []
    zero = M.mix(docs_of([(1, "", "a"), (2, None, None)])).collect()
    assert {(r["target"], r["copies"]) for r in zero} == {(0.0, 0)}
