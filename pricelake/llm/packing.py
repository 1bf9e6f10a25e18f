"""Best-fit packing by minimum bin slack.

Texts become token ids with an end id, cut into pieces of at most ``capacity`` tokens. Only lengths matter for packing,
and there are at most ``capacity`` different ones. So the driver works on a table of (length, how many pieces) that
cannot grow with the data: per bin, subset sums of the lengths at hand (a bitset, one shift per length and power of two)
give the fullest combination that holds the longest length left. The combination is then taken as often as its lengths
allow, at once. Pieces find their place by their rank among those of equal length; ranks are counted in salted buckets,
because a third of all pieces may have one length.

Null and empty texts are one piece that holds the end id. Repeated rows are packed as often as they occur. Null ids are
kept. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import Scratch
from .common import Kept, in_worker, values

#: Letters whose lower case and byte alphabet are known one by one.
LETTERS = "a-z\xdf-\xf6\xf8-\xff"
#: Texts are cut at white space, where the tokenizer always starts anew, and between a word and a comma or full stop.
PART = re.compile(f"[{LETTERS}]++(?=[.,])|[^ \t\n\r\x0b\x0c]++")
PLAIN = re.compile(f"[{LETTERS}]++")
#: Distinct parts whose ids are kept per Python worker; older ones go when there are twice as many.
KEPT = 150_000
ROWS_PER_BUCKET = 100_000
BUCKETS = 64


class WordIds:
    """Ids of whole texts, little-endian uint32, for a tokenizer that never joins words across white space."""

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.alphabet = {n: pieces(chr(n))[0][0] for n in range(97, 256) if PLAIN.fullmatch(chr(n))}
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts = Kept(self._ids, KEPT)
        probe = "It's x1 - A, <y> Z\xdcrich. z"
        if self(probe) != self._encoded(probe):
            raise ValueError("this tokenizer depends on what stands around a word")

    def _encoded(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _ids(self, part: str) -> bytes:
        if PLAIN.fullmatch(part):  # one piece that normalising leaves alone
            return array("I", [t.id for t in self.tokenizer.model.tokenize(part.translate(self.alphabet))]).tobytes()
        return self._encoded(part)

    def __call__(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            lowered = text.lower()  # as the tokenizer does for these characters
            if not any(map(lowered.__contains__, self.special)):  # special strings are found before that
                text = lowered
        return b"".join(map(self.parts.__getitem__, PART.findall(text)))


def token_pieces(docs: DataFrame, definition: str, capacity: int = 2048, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``, little-endian uint32) of every piece of every text."""
    sent = docs.sparkSession.sparkContext.broadcast(definition)  # one vocabulary file: does not grow with the data
    kind = dict(docs.dtypes)[id_column]
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = in_worker("word ids", sent.value, WordIds)
        for batch in batches:
            rows, cut, at = [], [], 0
            for i, text in enumerate(values(batch.column(1))):
                ids = ids_of(text or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((i, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    if keep_ids:
                        cut.append(part)
            if rows:
                at, piece, start, length, crc = (pa.array(c, pa.int64()) for c in zip(*rows, strict=True))
                columns = [batch.column(0).take(at), piece.cast(pa.int32()), start, length, crc]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(cut, pa.binary())] * keep_ids, names=names)

    names = [id_column, "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = f"{id_column} {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, schema)


def fullest(counts: dict[int, int], capacity: int) -> Counter:
    """Lengths, with repeats, that fill a bin best: the longest one left, and the subset that leaves the least slack."""
    longest = max(counts)
    room = capacity - longest
    steps: list[tuple[int, int, int]] = []  # (length, copies, sums reachable before them)
    reach, whole = 1, (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        copies = min(counts[length] - (length == longest), room // length)
        power = 1
        while copies > 0 and not reach >> room & 1:
            taken = min(power, copies)
            steps.append((length, taken, reach))
            reach |= reach << (length * taken) & whole
            copies -= taken
            power *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, Counter({longest: 1})
    for length, copies, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += copies
            total -= length * copies
    return chosen


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Combinations and how often each is taken, until no piece is left."""
    left, out = {k: n for k, n in counts.items() if n > 0}, []
    while left:
        chosen = fullest(left, capacity)
        times = min(left[length] // copies for length, copies in chosen.items())
        out.append((chosen, times))
        for length, copies in chosen.items():
            left[length] -= times * copies
            if not left[length]:
                del left[length]
    return out


def _shelves(counts: dict[int, int], capacity: int) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, copies a bin, first bin, place in the bin) in order of rank."""
    out: dict[int, list] = {}
    used, bins = Counter(), 0
    for chosen, times in patterns(counts, capacity):
        place = 0
        for length in sorted(chosen, reverse=True):
            out.setdefault(length, []).append((used[length], chosen[length], bins, place))
            used[length] += times * chosen[length]
            place += length * chosen[length]
        bins += times
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pack(pieces: DataFrame, capacity: int = 2048, scratch: Scratch | None = None) -> DataFrame:
    """``pieces`` with ``sequence_id`` (from 0) and ``offset``: bins of at most ``capacity``, filled without gaps."""
    spark = pieces.sparkSession
    scratch = scratch or Scratch(spark)
    pieces = scratch.store(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    buckets = BUCKETS + sum(counts.values()) // ROWS_PER_BUCKET
    order = [c for c in pieces.columns if c not in ("ids", "length")]
    salted = pieces.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = salted.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    ranked = salted.withColumn("rank", within).join(starts, ["length", "bucket"])
    ranked = ranked.select(*pieces.columns, (F.col("first") + F.col("rank")).alias("rank"))
    sent = spark.sparkContext.broadcast(_shelves(counts, capacity))  # bounded by the capacity: its lengths, and bins without repeats
    names = [*pieces.columns, "sequence_id", "offset"]
    at, last = names.index("length"), len(pieces.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelves = sent.value
        for batch in batches:
            lengths, ranks = batch.column(at).to_numpy(), batch.column(last).to_numpy()
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                shelf = shelves[int(length)]
                first, copies, bins, place = shelf[np.searchsorted(shelf[:, 0], ranks[own], side="right") - 1].T
                nth = ranks[own] - first
                sequence[own], offset[own] = bins + nth // copies, place + nth % copies * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(sequence), pa.array(offset)], names=names)

    kinds = [f"`{name}` {kind}" for name, kind in pieces.dtypes]
    return ranked.mapInArrow(run, ", ".join([*kinds, "sequence_id long", "offset long"]))
