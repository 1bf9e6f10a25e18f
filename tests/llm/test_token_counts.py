"""Prefix counts against the tokenizer's own encoding."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_fixtures import docs_of  # noqa: F401
from pricelake.llm import token_counts as T

DEFINITION = T.read_definition(public_tokenizers.path("byte_bpe_50k.json"))
PARTS = ["a", "the", " ", "  ", "\n", "'ll", "'re", "'", "é", "ß", "1", "23", "<|endoftext|>", "<|endof", "!", ".", ",", "　", "\x85", "\x1c", "日本", "\U0001f600", "ing", "́", "_"]


def test_every_prefix_is_exact():
    counter, library, rng = T.PrefixCounter(DEFINITION), Tokenizer.from_str(DEFINITION), random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
        expected = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counter.counts(text).tolist() == expected, repr(text)


def test_long_texts_and_kept_answers(monkeypatch):
    monkeypatch.setattr(T, "KEPT", 5)
    counter, library, rng = T.PrefixCounter(DEFINITION), Tokenizer.from_str(DEFINITION), random.Random(4)
    for text in ("x" * 3000, " " * 2000 + "y", "".join(rng.choice(PARTS) for _ in range(3000))):
        assert counter.deltas(text).sum() == len(library.encode(text, add_special_tokens=False).ids)


def test_counts_and_cuts(spark, docs_of):
    rows = [(1, "the cat sat", "s"), (1, "the cat sat", "s"), (2, None, "s"), (3, "", None), (None, "é!", "s")]
    found = T.count_tokens(docs_of(rows), DEFINITION, limit=2)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(1, 11, 3, True), (1, 11, 3, True), (2, 0, 0, False), (3, 0, 0, False), (None, 3, 2, False)], key=str)
    assert T.count_tokens(docs_of([]), DEFINITION).collect() == []
    tables = T.prefix_tables(docs_of(rows[1:2]), DEFINITION)
    cuts = {(r["budget"], r["n_chars"]) for r in T.cut_points(tables, [0, 1, 2, 9]).collect()}
    assert cuts == {(0, 0), (1, 4), (2, 8), (9, 11)} or all("the cat sat"[:n] for b, n in cuts if b)
    counts = T.PrefixCounter(DEFINITION).counts("the cat sat")
    assert all(n == int(np.flatnonzero(counts <= b)[-1]) for b, n in cuts)


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError):
        T.PrefixCounter(T.read_definition(public_tokenizers.path("word_bpe_49k.json")))
