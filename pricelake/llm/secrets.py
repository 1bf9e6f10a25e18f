"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The field tags the blank-separated tokens of every line as begin, inside or outside of a secret. Its features are the
token's shape, its neighbours and facts about the whole text; Viterbi finds the best tags. It is fitted on a bounded
sample of lines: those with the lowest hashes among lines with a pattern match (tagged by the match) and among all
others (tagged outside). Weights of a feature that the sample never shows are zero, and scores of a token depend on a
bounded number of features, so the fitted model is small whatever the data's size.

Decoding is exact without visiting every line: a line is all outside unless some token prefers begin or inside by more
than any change of transitions could cost, so only lines with such a token are decoded.

Null texts count as empty and have no spans. Offsets are code points, ends exclusive. Repeated rows are scanned one by
one; other columns are ignored. Without any pattern match in the whole table there is no model and nothing is added.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import values

# The patterns of the three kinds, and the shortest match that counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "tagged")

OUTSIDE, BEGIN, INSIDE = range(3)
#: Lines of each sort in the sample the field is fitted on, and tokens kept on either side of a line's match.
SAMPLE_LINES, SAMPLE_REACH = 300, 20
FIT_STEPS, FIT_RATE, FIT_DECAY = 60, 0.3, 1e-3
#: Distinct tokens whose scores are kept per task.
KEPT = 200_000


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping per kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run of 24 or more is found where the whole run starts, so shorter runs need no match of their own.
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _shape(token: str) -> str:
    kinds = ["d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c for c in token[:64]]
    return "".join(c for i, c in enumerate(kinds) if i == 0 or c != kinds[i - 1])[:10]


def _bits(token: str) -> int:
    """Bits of entropy per character, rounded."""
    counts = [token.count(c) / len(token) for c in set(token)]
    return round(-sum(p * math.log2(p) for p in counts))


def word_of(token: str) -> str:
    """The letters of a token that is a plain word with or without punctuation after it, else nothing."""
    core = token.rstrip(".,;:")
    return core if core.isalpha() else ""


def token_features(token: str) -> list[str]:
    if word := word_of(token):
        return ["word", f"size {min(len(word).bit_length(), 7)}", "upper" if word.isupper() else "other"]
    key, mark, value = token.partition("=")
    digits = sum(c.isdigit() for c in token[:64])
    out = [f"shape {_shape(token)}", f"size {min(len(token).bit_length(), 7)}", f"digits {digits * 4 // len(token[:64])}", f"bits {_bits(token[:64])}"]
    if mark:
        out += [f"key {key.lower()[:16]}=", "bare key" if not value else "key and value"]
    return out + [f"has {c}" for c in "@:/%*" if c in token]


def neighbour_feature(token: str) -> str:
    word = word_of(token)
    return word[:16].lower() if word else _shape(token)


def text_features(text: str) -> list[str]:
    return [f"chars {min(len(text).bit_length(), 20) // 2}"] + [f"has {c}" for c in "=:{<" if c in text]


def tokens_of(line: str) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer(r"\S+", line)]


def _lines(text: str) -> Iterator[tuple[int, str]]:
    at = 0
    for line in text.split("\n"):
        yield at, line
        at += len(line) + 1


def _example(text: str, offset: int, line: str, spans) -> str:
    """Tokens and tags around the first match of a line, with a token (or null) on either side, as JSON."""
    places = tokens_of(line)
    tags = [OUTSIDE] * len(places)
    for start, end, _ in spans:
        inside = [i for i, (a, b) in enumerate(places) if a + offset < end and b + offset > start]
        for n, i in enumerate(inside):
            tags[i] = BEGIN if n == 0 else INSIDE
    first = next((i for i, t in enumerate(tags) if t), next((i for i, (a, b) in enumerate(places) if not word_of(line[a:b])), 0))
    low, high = max(0, first - SAMPLE_REACH), min(len(places), first + SAMPLE_REACH)
    tokens = [None, *(line[a:b] for a, b in places), None]
    return json.dumps({"tokens": tokens[low : high + 2], "text": text_features(text), "tags": tags[low:high]})


def _features(example: dict) -> list[list[str]]:
    near = ["edge" if t is None else neighbour_feature(t) for t in example["tokens"]]
    own = [[f"self {f}" for f in token_features(t)] for t in example["tokens"][1:-1]]
    rest = [f"text {f}" for f in example["text"]]
    return [row + [f"before {near[i]}", f"after {near[i + 2]}"] + rest for i, row in enumerate(own)]


def _oddity(line: str) -> int:
    """2 with a digit, 1 with another token that is no plain word, else 0."""
    return 2 if any(map(str.isdigit, line)) else int(not all(map(word_of, line.split())))


def sample_lines(docs: DataFrame, lines: int = SAMPLE_LINES) -> list[str]:
    """At most ``lines`` examples of each sort, those with the lowest hashes.

    Sorts: lines with a pattern match, and others by their oddest token (with a digit, not a plain word, plain word).
    """
    # Of texts without match, a share that still leaves more than enough is turned into examples.
    sparse = 2**32 * min(1.0, 20 * lines / max(1, docs.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sorts, hashes, made = [], [], []
            for text in values(batch.column(0)):
                text = text or ""
                spans, choice = base_spans(text), zlib.crc32(text.encode())
                listed = [x for x in _lines(text) if x[1].strip()] if spans or choice < sparse else []
                hits = [(o, x, own) for o, x in listed if (own := [s for s in spans if s[0] >= o and s[1] <= o + len(x)])]
                if hits:
                    offset, line, own = hits[choice % len(hits)]
                elif listed and not spans:
                    chosen, own = listed[choice % len(listed)], []
                    offset, line = max(listed, key=lambda x: (_oddity(x[1]), x is chosen))
                else:
                    continue
                sorts.append(3 if own else _oddity(line))
                hashes.append(zlib.crc32(line.encode()))
                made.append(_example(text, offset, line, own))
            yield pa.RecordBatch.from_arrays([pa.array(sorts, pa.int32()), pa.array(hashes, pa.int64()), pa.array(made, pa.string())], names=["sort", "hash", "made"])

    found = docs.mapInArrow(run, "sort int, hash long, made string").dropDuplicates(["sort", "hash", "made"])
    rank = F.row_number().over(Window.partitionBy("sort").orderBy("hash", "made"))
    return sorted(r["made"] for r in found.withColumn("rank", rank).where(F.col("rank") <= lines).collect())


class Field:
    """Weights of a linear-chain conditional random field over begin, inside and outside."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.index, self.weights, self.moves = index, weights, moves

    @classmethod
    def fit(cls, examples: list[str]) -> Field | None:
        """Maximum likelihood with a small quadratic penalty, by Adagrad over all examples at once."""
        made = [(rows, x["tags"]) for x in map(json.loads, examples) if (rows := _features(x))]
        if not any(any(tags) for _, tags in made):
            return None
        index: dict[str, int] = {}
        for rows, _ in made:
            for feature in (f for row in rows for f in row):
                index.setdefault(feature, len(index))
        longest, width = max(len(rows) for rows, _ in made), max(len(row) for rows, _ in made for row in rows)
        shown = np.full((len(made), longest, width), len(index))  # the last row of weights stays zero
        tags, real = np.zeros((len(made), longest), int), np.zeros((len(made), longest), bool)
        for n, (rows, own) in enumerate(made):
            for t, row in enumerate(rows):
                shown[n, t, : len(row)], tags[n, t], real[n, t] = [index[f] for f in row], own[t], True
        weights, moves = np.zeros((len(index) + 1, 3)), np.zeros((3, 3))
        moves[OUTSIDE, INSIDE] = -30.0  # inside never follows outside
        frozen, sums, move_sums = moves < 0, np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
        truth = np.eye(3)[tags] * real[..., None]
        pairs = np.einsum("nta,ntb->ab", truth[:, :-1], truth[:, 1:])
        for _ in range(FIT_STEPS):
            marginal, moved = _marginals(weights[shown].sum(2), moves, real)
            step = np.zeros_like(weights)
            np.add.at(step, shown, (truth - marginal)[:, :, None, :])
            step -= FIT_DECAY * weights * len(made)
            step[-1] = 0
            sums += step**2
            weights += FIT_RATE * step / np.sqrt(sums)
            change = np.where(frozen, 0, pairs - moved - FIT_DECAY * moves * len(made))
            move_sums += change**2
            moves += FIT_RATE * change / np.sqrt(move_sums)
        return cls(index, weights, moves)

    def scores(self, features: list[str]) -> np.ndarray:
        return sum((self.weights[i] for f in features if (i := self.index.get(f)) is not None), np.zeros(3))


def _marginals(emit: np.ndarray, moves: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tag probabilities per token and summed probabilities of neighbouring tags, forward and backward."""
    n, steps, _ = emit.shape
    ahead, back = np.zeros_like(emit), np.zeros_like(emit)
    start = np.array([0.0, 0.0, -30.0])
    ahead[:, 0] = emit[:, 0] + start
    for t in range(1, steps):
        new = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + emit[:, t]
        ahead[:, t] = np.where(real[:, t, None], new, ahead[:, t - 1])
    for t in range(steps - 2, -1, -1):
        new = np.logaddexp.reduce(moves + (emit[:, t + 1] + back[:, t + 1])[:, None, :], axis=2)
        back[:, t] = np.where(real[:, t + 1, None], new, 0)
    total = np.logaddexp.reduce(ahead[:, -1], axis=1)[:, None]
    marginal = np.exp(ahead + back - total[:, None]) * real[..., None]
    both = ahead[:, :-1, :, None] + moves + (emit + back)[:, 1:, None, :] - total[:, None, :, None]
    return marginal, (np.exp(np.minimum(both, 0)) * real[:, 1:, None, None]).sum((0, 1))


def viterbi(emit: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tags of one line."""
    best, came = emit[0] + np.array([0.0, 0.0, -30.0]), []
    for row in emit[1:]:
        options = best[:, None] + moves
        came.append(options.argmax(0))
        best = options.max(0) + row
    tags = [int(best.argmax())]
    for back in reversed(came):
        tags.append(int(back[tags[-1]]))
    return np.array(tags[::-1])


class Tagger:
    """Finds tagged spans of texts; keeps the scores of tokens it has seen."""

    def __init__(self, field: Field):
        self.field, self.moves = field, field.moves
        self.slack = 2 * max(0.0, float((field.moves - field.moves[OUTSIDE, OUTSIDE]).max()))
        self.edges = [field.scores([f"{where} edge"]) for where in ("before", "after")]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.rows: dict[tuple, int] = {}
        self.table = np.zeros((1024, 9))

    def _number(self, token: str) -> int:
        """Row of scores for a token; plain words of one size share a row unless the sample knows them as neighbours."""
        word, near = word_of(token), neighbour_feature(token)
        seen = tuple(near if f"{where} {near}" in self.field.index else None for where in ("before", "after"))
        key = (min(len(word).bit_length(), 7), word.isupper(), *seen) if word else (token,)
        if key not in self.rows:
            parts = ([f"self {f}" for f in token_features(token)], [f"before {near}"], [f"after {near}"])
            number = self.rows[key] = len(self.rows)
            if number == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[number] = np.concatenate([self.field.scores(p) for p in parts])
        self.known[token] = self.rows[key]
        return self.rows[key]

    def _emissions(self, lines: list[list[str]], bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > KEPT:
            self._forget()
        known, number = self.known, self._number
        ids = np.array([known[t] if t in known else number(t) for tokens in lines for t in tokens], np.int64)
        sizes = np.array([len(x) for x in lines])
        starts = np.concatenate(([0], np.cumsum(sizes)))
        scored = self.table[ids]
        emit = scored[:, :3] + bias
        emit[1:] += scored[:-1, 3:6]
        emit[:-1] += scored[1:, 6:]
        # At the edges of lines, the neighbour is the edge and not the next line's token.
        heads, tails = starts[:-1], starts[1:] - 1
        emit[heads] += self.edges[0] - np.where((heads > 0)[:, None], scored[heads - 1, 3:6], 0)
        emit[tails] += self.edges[1] - np.where((tails < len(ids) - 1)[:, None], scored[np.minimum(tails + 1, len(ids) - 1), 6:], 0)
        return emit, starts

    def __call__(self, text: str) -> list[tuple[int, int]]:
        lines = [(at, line) for at, line in _lines(text) if line and not line.isspace()]
        if not lines:
            return []
        bias = self.field.scores([f"text {f}" for f in text_features(text)])
        emit, starts = self._emissions([line.split() for _, line in lines], bias)
        active = np.maximum(emit[:, BEGIN], emit[:, INSIDE]) - emit[:, OUTSIDE] + self.slack > 0
        found = []
        for n in np.unique(np.searchsorted(starts, np.flatnonzero(active), side="right") - 1):
            at, line = lines[n]
            places = tokens_of(line)
            tags = viterbi(emit[starts[n] : starts[n + 1]], self.moves)
            for i in np.flatnonzero(tags == BEGIN):
                last = i
                while last + 1 < len(tags) and tags[last + 1] == INSIDE:
                    last += 1
                start, end = places[i][0] + at, places[last][1] + at
                while end > start + 1 and text[end - 1] in ".,;":
                    end -= 1
                found.append((start, end))
        return found


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE_LINES) -> DataFrame:
    """``doc_id`` and ``found``: array of (start, end, kind), by start and then kind. Tagged spans overlap no other."""
    columns = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    field = Field.fit(sample_lines(columns.select("text"), sample))  # on the driver: at most 4 * sample lines
    sent = docs.sparkSession.sparkContext.broadcast(field)  # bounded by the sample's features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(sent.value) if sent.value else None
        for batch in batches:
            out = []
            for text in values(batch.column(1)):
                text = text or ""
                spans = base_spans(text)
                added = [(a, b, "tagged") for a, b in (tagger(text) if tagger else []) if all(b <= s or a >= e for s, e, _ in spans)]
                out.append([dict(zip(("start", "end", "kind"), s, strict=True)) for s in sorted(spans + added, key=lambda s: (s[0], KINDS.index(s[2])))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=[id_column, "found"])

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    return columns.mapInArrow(run, f"{id_column} {dict(docs.dtypes)[id_column]}, found array<struct<start:long,end:long,kind:string>>")


def report(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts per kind and the spans as text, from ``scan``."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"] != "tagged")
    return found.select(
        id_column, *map(count, KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), count("tagged")
    )
