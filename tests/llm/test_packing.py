"""Packing against the tokenizer, exact fill and a lower bound."""

import random
import zlib
from array import array
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

from llm_fixtures import docs_of  # noqa: F401
from pricelake.llm import packing as P
from pricelake.llm.token_counts import read_definition

DEFINITION = read_definition(public_tokenizers.path("word_bpe_49k.json"))
PARTS = ["a", "The", " ", "\n", "'ll", "'RE", "é", "É", "ß", "23", "<|endoftext|>", "<|ENDOFTEXT|>", ".", ",", "　", "\x85", "日", "́", "İ", "Σ", "_", "Ü"]


def test_ids_are_the_librarys():
    ids, library, rng = P.WordIds(DEFINITION), Tokenizer.from_str(DEFINITION), random.Random(5)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        assert ids(text) == array("I", library.encode(text, add_special_tokens=False).ids).tobytes(), repr(text)


def test_fullest_is_the_best_subset():
    rng = random.Random(6)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(5)}
        chosen = P.fullest(counts, 30)
        longest = max(counts)
        items = [k for k, n in counts.items() for _ in range(n - (k == longest))]
        reach = {0}
        for k in items:
            reach |= {r + k for r in reach if r + k <= 30 - longest}
        assert sum(k * n for k, n in chosen.items()) == longest + max(reach)
        assert all(n <= counts[k] for k, n in chosen.items()) and chosen[longest]


def check(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
        assert sum(n for _, n in places) <= capacity
    return len(bins)


def test_sequences_are_whole_and_few(spark, docs_of):
    rng, library = random.Random(7), Tokenizer.from_str(DEFINITION)
    rows = [(i, " ".join(["word"] * rng.randint(0, 120)), "s") for i in range(400)] + [(900, None, None), (901, "", "s"), (900, None, None), (None, "x", "s")]
    rows += [(1000 + i, "same copy of a text", "s") for i in range(150)]  # one length holds a third of the rows
    pieces = P.token_pieces(docs_of(rows), DEFINITION, capacity=64, keep_ids=True)
    found = P.pack(pieces, capacity=64).collect()
    total = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    assert sum(r["length"] for r in found) == total
    assert check(found, 64) <= -(-total // 64) + 1
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in found)
    whole = defaultdict(list)
    for r in found:
        whole[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for i, text, _ in rows[:400]:
        n = len(library.encode(text, add_special_tokens=False).ids) + 1
        assert sorted(whole[i]) == [(p, 64 * p, min(64, n - 64 * p)) for p in range(-(-n // 64))]
    assert len(whole[900]) == 2 and len(whole[None]) == 1


def test_empty_table(spark, docs_of):
    assert P.pack(P.token_pieces(docs_of([]), DEFINITION)).collect() == []
