"""Exact token counts of every prefix of a text by dynamic programming over its bytes.

A byte-level BPE encodes the pieces of a text one by one. Within a piece, a sequence of tokens is the encoding of its
text exactly if every two neighbours are the encoding of theirs. So the last token of every prefix follows from shorter
prefixes: it is the one token that ends there and fits the last token of the prefix before it. The count of a prefix
is the count of that shorter prefix plus one, and one pass over a text answers how many tokens any prefix has.

Pieces never reach over the start of a run of white space, so a text is cut there and equal chunks are counted once
per task. A special string of the tokenizer is one token where it is complete and plain text where a prefix cuts it.

Null texts count as empty. Other columns are ignored, so clashing names do no harm.
"""

from __future__ import annotations

import gc
import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Kept, in_worker, values

#: The white space of the tokenizer's own pattern (the Unicode property White_Space).
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Texts are cut before white space and, since a run of letters ends there anyway, before a comma or full stop.
CHUNK = re.compile(f"[{WHITE}]*+(?:[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]++(?=[.,])|[^{WHITE}]++)|[{WHITE}]++")
#: A chunk that is one piece, and how the byte alphabet writes a space.
PLAIN, SPACE = re.compile(" ?[A-Za-z]++"), "\u0120"
#: Endings that the tokenizer's pattern takes as a piece of their own.
ENDINGS = ("'re", "'ve", "'ll")
#: Distinct chunks and pairs of tokens kept per Python worker; older ones go when there are twice as many.
KEPT = 400_000
#: Prefixes of pieces whose states are kept for other pieces that begin alike, by length in bytes.
BEGINNINGS = (9, 7, 5)
#: Above every token number.
WIDE = 1 << 24


class PrefixCounter:
    """Token counts of prefixes for a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        if spec.get("normalizer") or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError("prefix counts need a byte-level BPE without normaliser")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special strings that take in their surroundings are not supported")
        tokenizer = Tokenizer.from_str(definition)
        self.model, self.pieces = tokenizer.model, tokenizer.pre_tokenizer.pre_tokenize_str
        self.vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.longest = max(map(len, self.vocabulary), default=1)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.names = {number: token for token, number in self.vocabulary.items()}
        self.alone = {n for t, n in self.vocabulary.items() if [x.value for x in self.model.tokenize(t)] == [t]}
        self.fit: dict[int, bool] = {}  # by number of the left token * WIDE + number of the right one
        self.begun: dict[str, tuple[list[int], list[int]]] = {}
        self.chunks = Kept(self.chunk_deltas, KEPT)

    def _fits(self, pair: int) -> bool:
        if len(self.fit) > 2 * KEPT:
            self.fit.clear()
        left, right = (self.names[n] for n in divmod(pair, WIDE))
        found = self.fit[pair] = [t.value for t in self.model.tokenize(left + right)] == [left, right]
        return found

    def piece_counts(self, piece: str) -> list[int]:
        """Tokens of every prefix of one piece, written in the byte alphabet of the vocabulary.

        The state of a prefix does not depend on what follows, so pieces that begin alike share their first steps.
        """
        numbers, alone, fit, fits, longest = self.vocabulary.get, self.alone, self.fit.get, self._fits, self.longest
        counts, bases, known, begun = [0], [0], 0, self.begun  # bases: of the last token of every prefix, its number * WIDE
        for known in BEGINNINGS:
            if known < len(piece) and (state := begun.get(piece[:known])):
                counts, bases = state[0][: known + 1], state[1][: known + 1]
                break
        else:
            known = 0
        start, token = known, ""
        for end, byte in enumerate(piece[known:] if known else piece, known + 1):
            # Exactly one start is right, so they may be tried in any order: the last one first, then longest tokens.
            token += byte
            number = numbers(token)
            if number is None or not (fit(bases[start] + number) if start else number in alone):
                for start in range(end - longest if end > longest else 0, end):
                    token = piece[start:end]
                    number = numbers(token)
                    if number is not None:
                        if not start:
                            good = number in alone
                        else:
                            good = fit(bases[start] + number)
                            if good is None:
                                good = fits(bases[start] + number)
                        if good:
                            break
                else:
                    raise ValueError(f"no token ends at byte {end} of a piece")
            counts.append(counts[start] + 1)
            bases.append(number * WIDE)
        if len(begun) > KEPT:
            begun.clear()
        for size in BEGINNINGS:
            if known < size < len(piece):
                begun[piece[:size]] = (counts, bases)
        return counts

    def _run(self, text: str) -> list[int]:
        """Counts after every character of a text, piece by piece."""
        if PLAIN.fullmatch(text):  # one piece, and one byte a character
            return self.piece_counts(text.replace(" ", SPACE))[1:]
        out, before = [], 0
        for piece, (start, end) in self.pieces(text):
            counts = self.piece_counts(piece)
            own = counts[1:]
            if len(own) != end - start:  # characters of several bytes
                ends = accumulate(len(c.encode()) for c in text[start:end])
                own = [counts[at] for at in ends]
            if text[start:end] in ENDINGS:  # a cut ending is an apostrophe and a letter, two pieces
                own[1] = own[0] + 1
            out += [before + n for n in own] if before else own
            before = out[-1]
        return out

    def chunk_deltas(self, chunk: str) -> bytes:
        """Change of the count at every character of a run of white space and what follows it, as int32."""
        counts = self._run(chunk)
        blank = len(chunk) - len(chunk.lstrip(WHITE))
        if 1 < blank < len(chunk):  # a prefix that ends with the whole run has it as one piece
            counts[blank - 1] = self._run(chunk[:blank])[-1]
        return array("i", map(sub, counts, [0, *counts])).tobytes()

    def deltas(self, text: str) -> np.ndarray:
        """Change of the count at every character; the sum up to i is the count of ``text[:i]``."""
        if not text:
            return np.zeros(0, np.int32)
        found = list(self.special.finditer(text)) if self.special else []
        if not found:
            return np.frombuffer(b"".join(map(self.chunks.__getitem__, CHUNK.findall(text))), np.int32)
        parts, at = [], 0
        for match in found:
            plain = text[at : match.start()]
            parts.append(self._plain(plain))
            # Until it is complete, the special string goes on from the chunk before it as plain text.
            tail = CHUNK.findall(plain)[-1] if plain else ""
            joined = np.cumsum(self._plain(tail + match[0]))
            own = joined[len(tail) :] - (self._plain(tail).sum() if tail else 0)
            own[-1] = 1
            parts.append(np.diff(own, prepend=0).astype(np.int32))
            at = match.end()
        parts.append(self._plain(text[at:]))
        return np.concatenate(parts)

    def _plain(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, CHUNK.findall(text))), np.int32)

    def counts(self, text: str) -> np.ndarray:
        """Tokens of ``text[:0]``, ``text[:1]`` and so on, up to the whole text."""
        return np.concatenate(([0], np.cumsum(self.deltas(text), dtype=np.int64)))


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens. Counts may fall again: a later cut can be shorter."""
    return int(np.flatnonzero(counts <= budget)[-1])


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _scan(docs: DataFrame, definition: str, id_column: str, text_column: str, schema: str, answer) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(definition)  # one vocabulary file: does not grow with the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = in_worker("prefix counter", sent.value, PrefixCounter)
        gc.disable()  # the counter keeps very many lists that hold no cycles
        try:
            for batch in batches:
                rows = [answer(counter, text or "") for text in values(batch.column(1))]
                if rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c)) for c in zip(*rows, strict=True))], names=names)
        finally:
            gc.enable()

    names = [part.split()[0] for part in schema.split(",")]
    kind = dict(docs.dtypes)[id_column]
    columns = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return columns.mapInArrow(run, f"{names[0]} {kind}, " + schema.split(",", 1)[1])


def count_tokens(docs: DataFrame, definition: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more tokens than ``limit``) of every whole text."""

    def answer(counter: PrefixCounter, text: str):
        tokens = int(counter.deltas(text).sum(dtype=np.int64))
        return len(text.encode()), tokens, tokens > limit

    return _scan(docs, definition, id_column, text_column, f"{id_column} long, n_bytes long, n_tokens long, over_limit boolean", answer)


def prefix_tables(docs: DataFrame, definition: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``prefix_deltas``: little-endian int32 changes of the count, one per character.

    Stored beside the texts, this answers every later question about budgets without the tokenizer; see ``cut_points``.
    """
    return _scan(docs, definition, id_column, text_column, f"{id_column} long, prefix_deltas binary", lambda counter, text: (counter.deltas(text).tobytes(),))


def cut_points(tables: DataFrame, budgets: list[int], id_column: str = "doc_id") -> DataFrame:
    """``doc_id``, ``budget``, ``n_chars``: the longest prefix of at most so many tokens, from stored prefix tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for deltas in batch.column(1).to_pylist():
                counts = np.concatenate(([0], np.cumsum(np.frombuffer(deltas or b"", np.int32), dtype=np.int64)))
                found.append([longest_prefix(counts, budget) for budget in budgets])
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), len(budgets))))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.array(budgets, np.int64), batch.num_rows)), pa.array([n for row in found for n in row], pa.int64())],
                names=[id_column, "budget", "n_chars"],
            )

    kind = dict(tables.dtypes)[id_column]
    return tables.select(id_column, "prefix_deltas").mapInArrow(run, f"{id_column} {kind}, budget long, n_chars long")
