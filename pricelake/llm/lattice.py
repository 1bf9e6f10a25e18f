"""Near duplicates among embeddings by lattice hashing.

A table projects a unit vector at random onto a few groups of eight numbers and rounds every group to the nearest point of
the E8 lattice; the points name a cell. A vector is listed in its own cell and in those one step on, where one group takes
its second nearest point (the neighbour its remainder points to). Vectors that share a cell in any table are candidates;
their cosine is computed in double precision. Groups per table follow the number of vectors, so cells stay small, and
the number of tables follows the rate at which vectors at the threshold meet in simulated tables, for ``RECALL``.

Short lists are joined to pairs, which their length bounds. Long lists (a dense group) are compared block by block:
a task holds two blocks, and returns counts of links and a spanning forest, never the pairs. A pair that meets in several
long lists is counted in the one with the smallest key, and pairs of short lists that share a long one are left to it.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Vectors of different lengths
never link. Rows with equal id and vector are one vector. Null ids are kept. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .graph import components
from .shingles import U, mix

DESIGN, RECALL = 0.9, 0.95
#: Width of the lattice relative to the projected unit vectors, and about how many cells one group then tells apart.
SCALE, CELLS = 1.8, 600
#: Longest list that is joined to pairs, and vectors in a block of longer ones.
SHORT, BLOCK = 64, 256
SEED = 20


def _even_nearest(x: np.ndarray) -> np.ndarray:
    """The nearest point with whole coordinates of even sum: round, and if the sum is odd turn the worst one round."""
    point = np.rint(x)
    rest = x - point
    odd = np.flatnonzero(point.sum(1) % 2)
    worst = np.abs(rest[odd]).argmax(1)
    point[odd, worst] += np.where(rest[odd, worst] >= 0, 1, -1)
    return point


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8 (whole or half coordinates of even sum) to each row of eight numbers."""
    whole, half = _even_nearest(x), _even_nearest(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


def shortest() -> np.ndarray:
    """The 240 shortest vectors of the lattice: two coordinates of +-1, or all +-1/2 with an even number of minus signs."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1.0, -1.0):
                for b in (1.0, -1.0):
                    out.append(np.zeros(8))
                    out[-1][[i, j]] = a, b
    signs = 1 - 2.0 * ((np.arange(256)[:, None] >> np.arange(8)) & 1)
    return np.concatenate([out, signs[signs.prod(1) > 0] / 2])


class Tables:
    """Random projections and cells for vectors of one length."""

    def __init__(self, length: int, tables: int, groups: int):
        random = np.random.default_rng([SEED, length])
        self.tables, self.groups = tables, groups
        self.projection = random.normal(size=(tables, groups, length, 8)) / SCALE
        self.shift = random.uniform(0, 1, size=(tables, groups, 8))
        self.steps = shortest()
        self.salt = random.integers(1, 1 << 62, size=(tables, groups, 8)).astype(U) | U(1)

    def keys(self, units: np.ndarray, table: int) -> np.ndarray:
        """Cells of each unit vector in a table: its own and one per group with that group's second nearest point."""
        own, other = [], []
        for group in range(self.groups):
            x = units @ self.projection[table, group] + self.shift[table, group]
            point = nearest(x)
            step = self.steps[((x - point) @ self.steps.T).argmax(1)]
            own.append(self._number(point, table, group))
            other.append(self._number(point + step, table, group))
        total = sum(own, np.zeros(len(units), U))
        cells = [total] + [total - a + b for a, b in zip(own, other, strict=True)]
        return mix(np.stack(cells, axis=1) + U(table * self.projection.shape[2] + 1)).astype(np.int64)

    def _number(self, point: np.ndarray, table: int, group: int) -> np.ndarray:
        return mix(((2 * point).astype(np.int64).astype(U) * self.salt[table, group]).sum(1, dtype=U))


def design(vectors: int, length: int, cosine: float = DESIGN, recall: float = RECALL) -> tuple[int, int]:
    """(tables, groups) for so many vectors, from simulated pairs at a cosine."""
    groups = max(1, math.ceil(math.log(max(vectors, 2)) / math.log(CELLS)))
    random, pairs, length = np.random.default_rng(SEED), 2000, max(length, 2)
    a, b = random.normal(size=(2, pairs, length))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    tried = Tables(length, 4, groups)
    met = 0
    for table in range(4):
        x, y = tried.keys(a, table), tried.keys(cosine * a + math.sqrt(1 - cosine**2) * b, table)
        met += (x[:, :, None] == y[:, None, :]).any((1, 2)).mean() / 4
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(max(met, 1e-3), 1 - 1e-9)))), groups


def _units(rows: DataFrame) -> DataFrame:
    """``node, id, unit``: one row per row, without unit where the vector links with nothing."""
    number = F.xxhash64(F.col("id").isNull(), "id", F.col("vector").isNull(), "vector").alias("node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = []
            for value in batch.column(2):
                x = np.array([np.nan] if value.as_py() is None else value.as_py(), dtype=np.float64)
                # Scaled first, so that squares neither overflow nor vanish.
                most = np.abs(x).max(initial=0.0)
                units.append((y / np.linalg.norm(y)).tobytes() if np.isfinite(x).all() and most > 0 and np.isfinite(y := x / most).all() else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(units, pa.binary())], names=["node", "id", "unit"])

    return rows.select(number, "id", "vector").mapInArrow(run, f"node long, id {dict(rows.dtypes)['id']}, unit binary")


def _listed(units: DataFrame, tables: int, groups: int) -> DataFrame:
    """``key, node`` of every cell of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Tables] = {}
        for batch in batches:
            nodes, stored = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            sizes = np.array([len(x) // 8 for x in stored])
            for length in np.unique(sizes):
                own = np.flatnonzero(sizes == length)
                matrix = np.frombuffer(b"".join(stored[i] for i in own)).reshape(len(own), length)
                if int(length) not in made:
                    made[int(length)] = Tables(int(length), tables, groups)
                cells = made[int(length)]
                for table in range(tables):
                    keys = cells.keys(matrix, table)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(nodes[own], keys.shape[1]))], names=["key", "node"])

    return units.select("node", "unit").mapInArrow(run, "key long, node long")


def _linked_pairs(pairs: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    one = units.select(F.col("node").alias("a"), F.col("unit").alias("x"))
    two = units.select(F.col("node").alias("b"), F.col("unit").alias("y"))
    both = pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b").where(F.length("x") == F.length("y")).select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [float(np.frombuffer(x) @ np.frombuffer(y)) >= threshold for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _block_links(rows: DataFrame, threshold: float) -> DataFrame:
    """``node, links, root`` per block pair: links counted there, and a linked node to hang on (a spanning forest).

    ``rows`` (key, node, unit, long, chunk, low, high): members of the chunks low and high of a long list, with the keys of
    all long lists the member stands in.
    """

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        key, low, high = int(block["key"].iloc[0]), int(block["low"].iloc[0]), int(block["high"].iloc[0])
        out = []
        for length in block["unit"].str.len().unique():
            same = block[block["unit"].str.len() == length]
            one, two = same[same["chunk"] == low], same[same["chunk"] == high]
            if not len(one) or not len(two):
                continue
            x, y = (np.frombuffer(b"".join(part["unit"])).reshape(len(part), -1) for part in (one, two))
            hits = x @ y.T >= threshold
            if low == high:
                np.fill_diagonal(hits, False)
            # A pair belongs to the smallest key that both stand under.
            earlier = sorted({k for keys in same["long"] for k in keys if k < key})
            place = {k: i for i, k in enumerate(earlier)}
            marks = []
            for part in (one, two):
                mark = np.zeros((len(part), len(earlier)), np.float32)
                for i, keys in enumerate(part["long"]):
                    mark[i, [place[k] for k in keys if k < key]] = 1
                marks.append(mark)
            hits &= ~(marks[0] @ marks[1].T > 0)
            names = [part["node"].to_numpy() for part in (one, two)]
            roots = [names[0].copy(), names[1].copy()]
            far = np.iinfo(np.int64).max
            while True:
                down = np.minimum(roots[1], np.where(hits, roots[0][:, None], far).min(0))
                up = np.minimum(roots[0], np.where(hits, down[None, :], far).min(1))
                if low == high:
                    down = up = np.minimum(up, down)
                if (down == roots[1]).all() and (up == roots[0]).all():
                    break
                roots = [up, down]
            out.append(pd.DataFrame({"node": names[0], "links": hits.sum(1), "root": roots[0]}))
            if low != high:
                out.append(pd.DataFrame({"node": names[1], "links": hits.sum(0), "root": roots[1]}))
        found = pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "root": []})
        return found[found["links"] > 0].astype("int64")

    return rows.groupBy("key", "low", "high").applyInPandas(compare, "node long, links long, root long")


def near_groups(vectors: DataFrame, threshold: float = 0.9, id_column: str = "vec_id", vector_column: str = "embedding", scratch: Scratch | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    scratch = scratch or Scratch(vectors.sparkSession)
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
    everyone = scratch.store(_units(rows), "units")
    units = scratch.store(everyone.where("unit is not null").dropDuplicates(["node"]).select("node", "unit"), "nodes")
    size = units.agg(F.count("*").alias("n"), F.max(F.length("unit")).alias("bytes")).first()
    tables, groups = design(size["n"], (size["bytes"] or 0) // 8, threshold)

    lists = scratch.store(_listed(units, tables, groups).distinct(), "lists")
    sizes = scratch.store(lists.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    short = scratch.store(lists.join(sizes.where(F.col("n") <= SHORT).select("key").hint("merge"), "key"), "short")
    long = scratch.store(lists.join(sizes.where(F.col("n") > SHORT).hint("merge"), "key"), "long")
    under = scratch.store(long.groupBy("node").agg(F.array_sort(F.collect_list("key")).alias("long")), "under")  # at most a row per table and probe

    pairs = short.select("key", F.col("node").alias("a")).join(short.select("key", F.col("node").alias("b")), "key").where("a < b").select("a", "b").distinct()
    if not under.isEmpty():
        one, two = (under.select(F.col("node").alias(name), F.col("long").alias(f"{name}_long")) for name in "ab")
        apart = ~F.coalesce(F.arrays_overlap("a_long", "b_long"), F.lit(False))
        pairs = pairs.join(one.hint("merge"), "a", "left").join(two.hint("merge"), "b", "left").where(apart).select("a", "b")
    pairs = scratch.store(_linked_pairs(scratch.store(pairs, "pairs"), units, threshold), "links")

    chunks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = long.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    dealt = dealt.join(units.hint("merge"), "node").join(under.hint("merge"), "node")
    dealt = dealt.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select("key", "node", "unit", "long", "chunk", F.least("chunk", "partner").alias("low"), F.greatest("chunk", "partner").alias("high"))
    dense = scratch.store(_block_links(dealt, threshold), "dense")

    single = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).withColumn("links", F.lit(1).cast("long"))
    counts = scratch.store(single.unionByName(dense.select("node", "links")).groupBy("node").agg(F.sum("links").alias("n_links")), "counts")
    edges = pairs.unionByName(dense.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    groups_ = components(scratch, edges, "groups")

    placed = everyone.select("node", "id").join(groups_.hint("merge"), "node", "left").join(counts.hint("merge"), "node", "left")
    placed = scratch.store(placed.select("id", F.coalesce("component", "node").alias("group"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "placed")
    least = scratch.store(placed.groupBy("group").agg(F.min("id").alias("least")), "least")
    found = placed.join(least.hint("merge"), "group")
    return found.select(F.col("id").alias(id_column), "n_links", F.col("least").alias("component_id"), F.col("id").eqNullSafe(F.col("least")).alias("kept"))
