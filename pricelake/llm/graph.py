"""Connected components, and links inside candidate lists without listing all pairs of a list.

Joins here meet hot keys: the hub of a large group, the key of a long list. Both sides of such a join are stored tables,
so that adaptive execution may split the hot partition, and nothing above the join needs the rows of a key together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch


#: Edges that one task may put together.
LOCAL_EDGES = 200_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, component`` of the edges of one task, by union-find; smaller roots win."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    nodes = list(root)
    if nodes:
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["node", "component"])


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """``node, component`` (smallest node reachable) of every node of ``edges`` (a, b: long).

    Up to ``LOCAL_EDGES`` edges are put together by one task; more of them by alternating stars, with the same result.
    """
    edges = scratch.store(edges.select("a", "b"), f"{name}-given")
    few = edges.count() <= LOCAL_EDGES
    found = scratch.store(edges.coalesce(1).mapInArrow(_forest, "node long, component long"), name) if few else star_components(scratch, edges, name)
    scratch.drop(f"{name}-given")
    return found


def star_components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """The same for any number of edges.

    A large star hangs every larger neighbour of a node on the smallest one, a small star every smaller one; both keep
    components and bring paths down to stars in a logarithmic number of rounds.
    """
    tables: list[str] = []

    def store(df: DataFrame, part: str) -> DataFrame:
        tables.append(f"{name}-{len(tables)}-{part}")
        return scratch.store(df, tables[-1])

    current = store(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = store(large, "large")
        parents = store(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "parents")
        if parents.where("n > 1").isEmpty() and parents.join(large.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            break
        small = large.join(parents.select("a", "m").hint("merge"), "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = store(small.unionByName(parents.select("a", F.col("m").alias("b"))).distinct(), "small")
    found = parents.select(F.col("a").alias("node"), F.col("m").alias("component"))
    found = scratch.store(found.unionByName(found.select(F.col("component").alias("node"), "component").distinct()), name)
    for table in tables:
        scratch.drop(table)
    return found


def linked(scratch: Scratch, lists: DataFrame, verify: Callable[[DataFrame], DataFrame], name: str, close: Callable | None = None, rounds: int = 6, per_node: int = 4, about: DataFrame | None = None) -> DataFrame:
    """``node, component`` under the links that ``verify`` confirms among pairs that share a list.

    ``lists`` (key, node, and columns that ``close`` needs) names the candidates; ``verify`` takes pairs (a, b) and returns
    those that link. ``close(left, right)`` gets two functions from such a column's name to the column and returns a
    condition that every link meets; it is tested inside the join, so pairs that fail it are never rows. Wide columns for
    ``close`` come in ``about``, one row per node, and join the lists once those with the same members are gone.

    Pairs of nodes that hang together already need no check. So lists first check their members against one hub each,
    then, as long as that joins much, against the next hub. What is left then is checked pair by pair, so every link
    between different components is found whatever the rounds. Nodes without any confirmed link are not in the result.
    """
    carried = [c for c in lists.columns if c not in ("key", "node")]
    # Of lists with the same members, one is enough.
    alike = lists.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    alike = scratch.store(alike.where("n > 1").groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key"), f"{name}-alike")
    lists = lists.join(alike.hint("merge"), "key")
    if about is not None:
        carried = [c for c in about.columns if c != "node"]
        lists = lists.select("key", "node").join(about.hint("merge"), "node")
    lists = scratch.store(lists, f"{name}-lists")
    scratch.drop(f"{name}-alike")
    close = close or (lambda left, right: F.lit(True))
    edges, labels, before = None, None, None
    for turn in range(rounds + 1):
        if labels is None:
            marked = lists.withColumn("component", F.col("node"))
        else:
            marked = lists.join(labels.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
        marked = scratch.store(marked.select("key", "node", *carried, "component"), f"{name}-marked-{turn}")
        parts = marked.groupBy("key", "component").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", *carried)).alias("first"))
        # The hub is a member of the largest part, another one in every round.
        shared = parts.groupBy("key").agg(
            F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"), F.max(F.struct("n", "first", "component")).alias("hub")
        )
        of_hub = [F.col(f"hub.first.{c}").alias(f"hub_{c}") for c in ("node", *carried)]
        shared = scratch.store(shared.where("parts > 1").select("key", "n", "same", *of_hub, F.col("hub.component").alias("at")), f"{name}-shared-{turn}")
        left = shared.agg(F.count("*").alias("lists"), F.sum((F.col("n") * F.col("n") - F.col("same")) / 2).alias("pairs"), F.sum("n").alias("members")).first()
        if not left["lists"]:
            break
        last = turn == rounds or left["pairs"] <= per_node * left["members"] or (before is not None and left["pairs"] > 0.8 * before)
        before = left["pairs"]
        if last:
            several = scratch.store(marked.join(shared.select("key").hint("merge"), "key", "left_semi"), f"{name}-several")
            one, two = (several.select("key", *(F.col(c).alias(f"{c}_{side}") for c in ("node", "component", *carried))) for side in "ab")
            apart = (F.col("component_a") != F.col("component_b")) & (F.col("node_a") < F.col("node_b"))
            near = close(lambda c: F.col(f"{c}_a"), lambda c: F.col(f"{c}_b"))
            pairs = one.join(two.withColumnRenamed("key", "key_b").hint("merge"), (F.col("key") == F.col("key_b")) & apart & near)
            pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        else:
            near = close(F.col, lambda c: F.col(f"hub_{c}"))
            pairs = marked.join(shared.withColumnRenamed("key", "hub_key").hint("merge"), (F.col("key") == F.col("hub_key")) & (F.col("component") != F.col("at")) & near)
            pairs = pairs.select(F.least("node", "hub_node").alias("a"), F.greatest("node", "hub_node").alias("b"))
        found = verify(scratch.store(pairs.distinct(), f"{name}-pairs-{turn}"))
        edges = scratch.store(found if edges is None else edges.unionByName(found), f"{name}-edges-{turn}")
        labels = components(scratch, edges, f"{name}-components-{turn}")
        for part in ("marked", "shared", "pairs"):
            scratch.drop(f"{name}-{part}-{turn}")
        for part in ("edges", "components"):
            scratch.drop(f"{name}-{part}-{turn - 1}")
        if last:
            break
    if labels is None:
        return lists.select("node", F.col("node").alias("component")).limit(0)
    for part in ("lists", "several", f"marked-{turn}", f"shared-{turn}"):
        scratch.drop(f"{name}-{part}")
    return labels
