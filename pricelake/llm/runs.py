"""Runs: stretches of words that repeat with a period, by grouping suffixes, Lyndon arrays and extension of Lyndon roots.

The first phase of a grouping suffix sorter orders places into groups by the longest Lyndon word that starts there. Groups
are taken from the highest down; every member points to the nearest lower place before it, and places that l members point
to move to a new group right above their own, whose word is l times the taken group's word longer. What is left are groups
of equal Lyndon words, so a group's length is the Lyndon array of its members. It is built under an order of the words and
under the reverse one: of every run, a Lyndon root is the longest Lyndon word of its place in one of the two. Roots are
extended to both sides as far as words one period apart are equal.

Only stretches that can hold a run are grouped: a run that repeats its period ``times`` times holds each of its triples
of words ``times`` - 1 times (fewer for a period of one), so stretches are cut where a triple is rarer, and cut again
inside what is left. Cutting loses no run and bounds nothing; it spares the texts that repeat nothing.

Words are runs of anything but blanks (space, tab to carriage return). Null and empty texts have no words and no runs. Runs
may overlap; equal ones are told once. Repeated rows are looked at one by one. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, fresh, values

LEAST, TIMES = 6, 4
#: Words compared at once when a root is extended, at first; and rounds of cutting, after which stretches go on as they are.
STRIDE, ROUNDS = 64, 6
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def lyndon_array(words: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at every place, the end counting as the smallest word."""
    n = len(words)
    members: list[list[int]] = []
    group = [0] * n
    first: dict[int, int] = {}
    for word in sorted(set(words)):
        first[word] = len(members)
        members.append([])
    for i, word in enumerate(words):
        group[i] = g = first[word]
        members[g].append(i)
    length = [1] * len(members)
    lower = list(range(-1, len(members) - 1))
    upper = [*range(1, len(members)), -1]
    taken, before = [False] * n, [-1] * n
    at = len(members) - 1
    while at >= 0:
        hits: dict[int, int] = {}
        for i in members[at]:
            if group[i] != at:
                continue  # moved up since
            p = i - 1
            while p >= 0 and taken[p]:
                p = before[p]
            before[i] = p
            taken[i] = True
            if p >= 0:
                hits[p] = hits.get(p, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for p, hit in hits.items():  # ascending, as members and their pointers are
            moves.setdefault((hit, group[p]), []).append(p)
        for hit, old in sorted(moves, reverse=True) if len(moves) > 1 else moves:
            new, above = len(members), upper[old]
            members.append(moves[hit, old])
            length.append(length[old] + hit * length[at])
            lower.append(old)
            upper.append(above)
            lower[above] = upper[old] = new  # a lower group is never the highest one
            for p in members[new]:
                group[p] = new
        at = lower[at]
    return [length[g] for g in group]


def _same(words: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from ``a`` and ``b`` on (a < b) are equal, forwards or backwards."""
    most = len(words) - b if step > 0 else a + 1
    done, stride = 0, STRIDE
    while done < most:
        size = min(stride, most - done)
        if step > 0:
            x, y = words[a + done : a + done + size], words[b + done : b + done + size]
        else:
            x, y = words[a - done - size + 1 : a - done + 1][::-1], words[b - done - size + 1 : b - done + 1][::-1]
        unlike = x != y
        if unlike.any():
            return done + int(unlike.argmax())
        done, stride = done + size, 2 * stride
    return done


def _runs(words: np.ndarray, least: int, times: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of a stretch."""
    found, places = set(), np.arange(len(words))
    for order in (words, -words):
        roots = np.array(lyndon_array(order.tolist()))
        fits = roots * times <= len(words)
        if times >= 3:  # such a run holds the root twice in a row, both with the root's length
            following = np.minimum(places + roots, len(words) - 1)
            fits &= (places + roots < len(words)) & (roots[following] == roots)
        reached: dict[int, int] = {}
        for i, q in zip(places[fits].tolist(), roots[fits].tolist()):
            if i + q < reached.get(q, 0):
                continue  # inside the run that was extended last with this period
            end = i + q + _same(words, i, i + q, 1)
            start = i - (_same(words, i - 1, i + q - 1, -1) if i else 0)
            reached[q] = end
            if end - start >= max(least, times * q):
                found.add((start, end - start, q))
    return found


def stretches(words: np.ndarray, least: int, times: int) -> Iterator[tuple[int, int]]:
    """Parts of ``words`` (start, end) that hold all runs."""
    often = min(times - 1, max(least, times) - 2)
    if often < 2 or least < 3:
        yield 0, len(words)
        return
    ids = words.astype(np.uint64)  # products may wrap: that only makes triples look alike
    most = ids.max(initial=np.uint64(0)) + np.uint64(1)
    triples = (ids[:-2] * most + ids[1:-1]) * most + ids[2:]
    waiting = [(0, len(words), 0)]
    while waiting:
        start, end, turn = waiting.pop()
        if end - start < least:
            continue
        inside = triples[start : end - 2]
        ordered = np.sort(inside)
        many = ordered[often - 1 :][ordered[often - 1 :] == ordered[: len(ordered) - often + 1]]
        if not len(many):
            continue
        good = many[np.minimum(np.searchsorted(many, inside), len(many) - 1)] == inside
        if good.all() or turn == ROUNDS:
            yield start, end
            continue
        edges = np.flatnonzero(np.diff(good, prepend=False, append=False))
        waiting += [(start + int(a), start + int(b) + 2, turn + 1) for a, b in zip(edges[::2], edges[1::2])]


def find_runs(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` words and ``times`` periods, by start and period."""
    if len(words) < max(least, times):
        return []
    known: dict = {}
    ids = np.array([known.setdefault(word, len(known)) for word in words], np.int64)
    found: set[tuple[int, int, int]] = set()
    for start, end in stretches(ids, least, times):
        found |= {(start + at, size, period) for at, size, period in _runs(ids[start:end], least, times)}
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside the repeated part of every run, joined by one blank."""
    if runs:
        depth = np.zeros(len(words) + 1, np.int64)
        for start, size, period in runs:
            depth[start + period] += 1
            depth[start + size] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
    return b" ".join(words)


def word_runs(docs: DataFrame, text_column: str = "text", least: int = LEAST, times: int = TIMES) -> tuple[DataFrame, str, str]:
    """``docs`` with the runs of every text and the collapsed text, and the names of these two columns."""
    at, (runs_name, collapsed_name) = docs.columns.index(text_column), fresh(docs.columns, "runs", "collapsed")
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, collapsed = [], []
            for text in values(batch.column(at)):
                words = (text or "").encode().split()
                found = find_runs(words, least, times)
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                collapsed.append(collapse(words, found).decode())
            columns = [*batch.columns, pa.array(runs, kind), pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, runs_name, collapsed_name])

    made = T.StructType.fromDDL(f"`{runs_name}` array<{RUN}>, `{collapsed_name}` string")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *made.fields])), runs_name, collapsed_name


def looped(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, text``: from a place on, words give way to a loop of them if the hash of the id ends in 0."""
    h = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.col(text_column), F.lit(WORD), F.lit(0)))
    split = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), words.alias("words"), F.floor(h / 10).cast("long").alias("g"))
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8)).cast("int")
    loop = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), a), F.slice(loop, F.lit(1), n - a)), " ")
    return split.select(F.col("id").alias(id_column), F.when(n > 0, made).otherwise(F.col("text")).alias(text_column))


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    found, runs, collapsed = word_runs(docs.select(F.col(id_column), F.col(text_column)), text_column, least, times)
    longest = F.reduce(runs, F.lit(None).cast(RUN), lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best))
    listed = F.concat_ws("", F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    found = found.select(id_column, F.col(runs).alias(runs), F.col(collapsed).alias(collapsed), longest.alias("longest"))
    return found.select(
        id_column,
        F.size(runs).cast("long").alias("n_runs"),
        *[F.col(f"longest.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.col(collapsed), 256).alias("collapsed_sha256"),
    )
