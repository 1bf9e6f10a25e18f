"""Exact n-gram Jaccard join, size-aware: small sets by their subsets, large sets by inverted lists.

Two sets of sizes s and t link when their intersection holds at least o(s, t) = ceil(p (s + t) / (100 + p)) shingles,
which is the same as 100 * intersection >= p * union. Equal sets become one node first.

Small sets: for every size t that may link, a set emits its subsets of size o(s, t). Sets that meet on a subset link
without any check, so a list of any length needs only links to one of its members.

Large sets: lists are kept for parts of a set rather than for single shingles, because a shingle of a common passage
stands in very many sets. The hashes are cut into m ranges; linked sets of a size class differ in at most d < m shingles,
so some range holds the same shingles in both, and a list holds the sets with one content in one range. A set with m - d
or more empty ranges could agree on empty ranges only; such sets also emit their first shingles (prefix filter).
Sets that link share a number of lists that follows from their sizes and empty ranges, so each set leaves out its longest
ones. Candidates whose parities allow a link are checked on their whole sets, list by list against hubs, see ``graph.linked``.

The boundary is the largest size whose subsets cost no more rows than its lists and the reading of its words do.

Null texts and texts without words have no shingles and link with nothing. Null ids are kept; a group's id is its smallest
one that is not null. Repeated rows are equal sets. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..scratch import Scratch
from .common import fresh, values
from .graph import components, linked
from .shingles import U, mix, overlap, set_id, shingle_set

#: Ranges beyond those that linked sets may differ in, as a share.
SLACK = 0.15
#: Sizes whose subsets are counted when the boundary is chosen.
LARGEST_SMALL = 24
#: Low bits of a key that tell its kind: the size class, and lists of ranges from lists of single shingles.
KINDS = 512
#: Bits of the parity of a set.
PARITY = 1024


class Plan:
    """Everything that depends on the threshold alone: needed overlaps, size classes and the boundary."""

    def __init__(self, percent: int = 80, width: int = 5):
        if not 50 < percent <= 100:
            raise ValueError("the threshold must be above 50 and at most 100 percent")
        self.percent, self.width = percent, width
        # Smallest size of every class; a set links with sets of its own and the neighbouring classes only.
        self.lowest = [1]
        while self.lowest[-1] < 1 << 48:
            self.lowest.append(100 * self.lowest[-1] // percent + 1)
        self.boundary = max((s for s in range(1, LARGEST_SMALL + 1) if self._subsets(s) <= self._list_rows(s) + 2 * s), default=0)

    def needed(self, s: int, t: int) -> int:
        return -(-self.percent * (s + t) // (100 + self.percent))

    def partners(self, s: int) -> range:
        return range(-(-self.percent * s // 100), 100 * s // self.percent + 1)

    def _subsets(self, s: int) -> int:
        return sum(comb(s, self.needed(s, t)) for t in self.partners(s))

    def _list_rows(self, s: int) -> int:
        return sum(self.ranges(j)[0] for j in self.classes(s))

    def classes(self, s: int) -> list[int]:
        """Classes a set is listed in: j holds sizes of class j and the next one."""
        j = bisect_right(self.lowest, s) - 1
        return [j - 1, j] if j else [0]

    def ranges(self, j: int) -> tuple[int, int]:
        """(m, d) of a class: number of ranges, and shingles in which linked sets may differ."""
        largest = self.lowest[j + 2] - 1
        differ = 2 * largest - 2 * self.needed(largest, largest)
        differ = max(differ, int(2 * largest * (100 - self.percent) / (100 + self.percent)))
        return differ + 1 + int(SLACK * differ), differ

    def subset_rows(self, hashes: np.ndarray) -> list[tuple[int, int]]:
        """(key, side) of a small set. Side 0 and 1 are the smaller and larger size of a key, 2 means both are equal."""
        s, out = len(hashes), []
        with np.errstate(over="ignore"):
            for t in self.partners(s):
                if t > self.boundary:
                    break
                some = np.array(list(combinations(hashes, self.needed(s, t))), U).reshape(-1, self.needed(s, t))
                salt = mix(np.array([min(s, t) * 4099 + max(s, t)], U))
                keys = mix(mix(some + salt).sum(1, dtype=U) + salt).astype(np.int64)
                out += [(int(k), 2 if s == t else int(s > t)) for k in keys]
        return out

    def list_keys(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the lists that a set stands in, the kind in the low bits, and how many lists of a kind a link shares.

        Linked sets agree on m - d ranges at least. They can agree on empty ones, which are in no list, so a set with e
        empty ranges shares at least m - d - e lists with any set it links with.
        """
        s, keys, needs = len(hashes), [], []
        blended = mix(hashes + U(0x2545F4914F6CDD1D))
        for j in self.classes(s):
            m, d = self.ranges(j)
            at = ((hashes >> U(32)) * U(m)) >> U(32)  # ranges of the hash, so they follow each other in a sorted set
            first = np.flatnonzero(np.diff(at, prepend=U(m)))
            salt = U(j * 2 + 1) << U(40)
            keys.append((mix(np.add.reduceat(blended, first) + mix(at[first] + salt)) & ~U(KINDS - 1)) | U(2 * j))
            needs.append(np.full(len(first), max(len(first) - d, 1), np.int32))
            if len(first) <= d:  # every range that is sure to agree may be an empty one
                prefix = s - max(-(-self.percent * s // 100), 1) + 1
                keys.append((mix(blended[:prefix] + mix(np.array([salt + U(1 << 39)], U))) & ~U(KINDS - 1)) | U(2 * j + 1))
                needs.append(np.ones(prefix, np.int32))
        return np.concatenate(keys).astype(np.int64), np.concatenate(needs)


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id, text, row``: with the id, a hash of the text tells rows apart; ids may be null or repeat without end."""
    text = F.col(f"`{text_column}`")
    return docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("row"))


SUBSETS = pa.list_(pa.struct([("key", pa.int64()), ("side", pa.int32())]))


def _nodes(rows: DataFrame, plan: Plan) -> DataFrame:
    """``id, row, size, node, subsets``; the node is null for an empty set, subsets are those of small sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in values(batch.column(1)):
                hashes = shingle_set(text, plan.width)
                small = 0 < len(hashes) <= plan.boundary
                subsets = [{"key": key, "side": side} for key, side in plan.subset_rows(hashes)] if small else None
                out.append((len(hashes), set_id(hashes) if len(hashes) else None, subsets))
            columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), SUBSETS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=["id", "row", "size", "node", "subsets"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, row long, size long, node long, subsets array<struct<key:long,side:int>>")


def _listed(rows: DataFrame, plan: Plan) -> DataFrame:
    """``key, node, need`` of the inverted lists of large sets, and of small ones that may link with them."""
    least = plan.partners(plan.boundary + 1)[0]

    def table(keys: list, nodes: list) -> pa.RecordBatch:
        sizes = [len(k) for k, _ in keys]
        columns = [np.concatenate([k for k, _ in keys]), np.repeat(np.array(nodes), sizes), np.concatenate([n for _, n in keys])]
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["key", "node", "need"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within the task would emit the same rows again
        for batch in batches:
            keys, nodes = [], []
            for text in values(batch.column(0)):
                hashes = shingle_set(text, plan.width)
                if len(hashes) >= least and (node := set_id(hashes)) not in seen:
                    seen.add(node)
                    keys.append(plan.list_keys(hashes))
                    nodes.append(node)
                if len(keys) >= 500:
                    yield table(keys, nodes)
                    keys, nodes = [], []
            if keys:
                yield table(keys, nodes)

    return rows.select("text").mapInArrow(run, "key long, node long, need int")


def _shared(lists: DataFrame) -> DataFrame:
    """The rows of keys that have two different nodes, from a shuffle by key and a sort that can spill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, told = None, False  # the row that the batch before ended with, and whether it is out
        for batch in batches:
            rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1)
            if not len(rows):
                continue
            carried = last is not None and rows[0, 0] == last[0]
            told = told and carried
            if carried:
                rows = np.concatenate([last[None, :], rows])
            new_key = np.append(True, rows[1:, 0] != rows[:-1, 0])
            new_node = np.append(False, rows[1:, 1] != rows[:-1, 1]) & ~new_key
            starts = np.flatnonzero(new_key)
            several = np.logical_or.reduceat(new_node, starts)
            if told:
                several[0] = True
            keep = several[np.cumsum(new_key) - 1] & (new_key | new_node)
            if told:
                keep[0] = False
            last, told = rows[-1], bool(several[-1])
            if keep.any():
                columns = [pa.array(rows[keep, 0]), pa.array(rows[keep, 1]), pa.array(rows[keep, 2].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "need"])

    return lists.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "key long, node long, need int")


def _rare(scratch: Scratch, lists: DataFrame) -> DataFrame:
    """``key, node``: of every set all lists but its need - 1 longest ones of a kind.

    Two sets that share as many lists as both need also share one of those that are left (the prefix filter, with lists
    as elements and the longest last), so the lists of passages that very many sets share are met by few.
    """
    lists = scratch.store(lists, "shared")
    sizes = lists.groupBy("key").agg(F.count("*").alias("n"))
    kind = F.col("key").bitwiseAND(KINDS - 1)
    longest = Window.partitionBy("node", kind).orderBy(F.desc("n"), "key")
    left = lists.join(sizes, "key").withColumn("rank", F.row_number().over(longest)).where("rank >= need").select("key", "node")
    left = scratch.store(left, "rare")
    several = left.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    lists = scratch.store(left.join(scratch.store(several, "several").hint("merge"), "key"), "lists")
    for part in ("shared", "rare", "several"):
        scratch.drop(part)
    return lists


def _sets(rows: DataFrame, wanted: DataFrame, plan: Plan) -> DataFrame:
    """``node, size, parity, hashes`` of the wanted nodes (id, row, node), computed again from their texts."""
    named = wanted.withColumnsRenamed({"id": "wanted", "row": "hash"})
    picked = rows.join(named, F.col("id").eqNullSafe(F.col("wanted")) & (F.col("row") == F.col("hash"))).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text, plan.width) for text in values(batch.column(1))]
            made = [
                batch.column(0),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array([parity(x).tolist() for x in sets], pa.list_(pa.int64())),
                pa.array([x.tobytes() for x in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(made, names=["node", "size", "parity", "hashes"])

    return picked.mapInArrow(run, "node long, size long, parity array<long>, hashes binary")


def parity(hashes: np.ndarray) -> np.ndarray:
    """Of every of ``PARITY`` classes of shingles, whether a set holds an odd number: two sets differ in at least as many
    shingles as in bits, and in hardly more while the sets are smaller than that."""
    odd = np.bincount((hashes & U(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _may_link(plan: Plan):
    """Whether two sets can link, by the bits in which their parities differ."""

    def close(left, right):
        bits = F.aggregate(F.zip_with(left("parity"), right("parity"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        both = left("size") + right("size")
        return bits <= both - 2 * F.ceil(plan.percent * both / F.lit(100 + plan.percent))

    return close


def _checked(pairs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b) whose sets really link."""
    one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    both = pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(values(batch.column(2)), values(batch.column(3))):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                keep.append(overlap(x, y) >= plan.needed(len(x), len(y)))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _grouped(rows: DataFrame, plan: Plan, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``id, size, node, group`` of every row, and per group ``least``: the smallest (id, node) whose id is not null."""
    info = scratch.store(_nodes(rows, plan), "nodes")

    met = info.select("node", F.explode("subsets").alias("at")).select("at.key", "node", "at.side").distinct()
    met = scratch.store(met, "subsets")
    hubs = met.groupBy("key").agg(F.min("side").alias("low"), F.max("side").alias("high"), F.min("node").alias("hub"), F.max("node").alias("far"))
    hubs = scratch.store(hubs.where("hub != far and (low = 2 or (low = 0 and high = 1))").select("key", "hub"), "subset-hubs")
    small = met.join(hubs.hint("merge"), "key").where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))

    lists = _rare(scratch, _shared(_listed(rows, plan)))
    names = info.where("node is not null").groupBy("node").agg(F.min(F.struct("id", "row")).alias("one")).select("node", "one.id", "one.row")
    wanted = scratch.store(names.join(lists.select("node").distinct(), "node", "left_semi"), "wanted")
    sets = scratch.store(_sets(rows, wanted, plan).dropDuplicates(["node"]), "sets")
    large = linked(scratch, lists, lambda pairs: _checked(pairs, sets, plan), "large", _may_link(plan), about=sets.select("node", "size", "parity"))

    edges = small.unionByName(large.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b")))
    groups = components(scratch, edges, "groups")
    placed = info.join(groups.hint("merge"), "node", "left").select("id", "size", "node", F.coalesce("component", "node").alias("group"))
    placed = scratch.store(placed, "placed")
    for part in ("nodes", "subsets", "subset-hubs", "wanted", "sets", "lists"):
        scratch.drop(part)
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("node"))
    least = placed.where("group is not null").groupBy("group").agg(F.min(order).alias("first")).select("group", F.col("first.id").alias("least"), F.col("first.node").alias("least_node"))
    return placed, scratch.store(least, "least")


def join_groups(docs: DataFrame, percent: int = 80, width: int = 5, id_column: str = "doc_id", text_column: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` (smallest id reachable over links) of every row of ``docs``."""
    placed, least = _grouped(_rows(docs, id_column, text_column), Plan(percent, width), scratch or Scratch(docs.sparkSession))
    found = placed.join(least.hint("merge"), "group", "left")
    component = F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("least"))
    return found.select(F.col("id").alias(id_column), F.col("size").alias("n_shingles"), component.alias("component_id"))


def keep_first(docs: DataFrame, percent: int = 80, width: int = 5, id_column: str = "doc_id", text_column: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with one row of every group, one with the smallest id; rows without words all stay."""
    scratch, plan, names = scratch or Scratch(docs.sparkSession), Plan(percent, width), docs.columns
    _, least = _grouped(_rows(docs, id_column, text_column), plan, scratch)
    at = names.index(text_column)
    node, kept, kept_node = fresh(names, "node", "kept", "kept_node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (shingle_set(text, plan.width) for text in values(batch.column(at)))
            nodes = pa.array([set_id(x) if len(x) else None for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, nodes], names=[*names, node])

    marked = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(node, T.LongType())]))
    firsts = scratch.store(least.select(F.col("least").alias(kept), F.col("least_node").alias(kept_node)), "firsts")
    same = F.col(f"`{id_column}`").eqNullSafe(F.col(kept)) & (F.col(node) == F.col(kept_node))
    found = marked.where(F.col(node).isNotNull()).join(firsts.hint("merge"), same, "left_semi").dropDuplicates([id_column, node])
    return found.unionByName(marked.where(F.col(node).isNull())).drop(node)


GROUPS_SQL = r"""
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM {docs}
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words
), classes AS (
  SELECT list_sort(s) AS s, min(doc_id) AS node FROM sets WHERE len(s) > 0 GROUP BY 1
), tokens AS (
  SELECT node, len(s) AS size, unnest(s) AS token FROM classes
), links AS (
  SELECT a.node AS a, b.node AS b FROM tokens a JOIN tokens b ON a.token = b.token AND a.node < b.node
    AND 100 * a.size >= 80 * b.size AND 100 * b.size >= 80 * a.size
  GROUP BY a.node, b.node, a.size, b.size HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT node AS start, node AS least FROM classes
  UNION SELECT r.start, e.b FROM reach r JOIN both_ways e ON r.least = e.a
), groups AS (
  SELECT start AS node, min(least) AS component FROM reach GROUP BY start
), joined AS (
  SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(g.component, s.doc_id) AS component_id
  FROM sets s LEFT JOIN classes c ON list_sort(s.s) = c.s LEFT JOIN groups g ON g.node = c.node
)
"""
ORACLE = "WITH RECURSIVE " + GROUPS_SQL + "SELECT doc_id, n_shingles, component_id FROM joined"
