"""Connected components of a table of links, by local forests and alternating stars; nothing meets on the driver."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintgraph.llm.shared import written

#: Links that one task joins by itself.
FOREST = 1 << 19


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: each node's larger neighbours go to its least neighbour; small star: the others do.
    Links are (a, b) with a > b. The least neighbours are written first, so that the join with a
    node of very many links can be split."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")), "stars").select("a", F.least("a", "m").alias("m"))
        linked = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = written(edges.groupBy("a").agg(F.min("b").alias("m")), "stars")
        moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        linked = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return linked.where("a <> b").dropDuplicates(["a", "b"])


def _forest(ends: DataFrame) -> DataFrame:
    """node, root: what the links (a > b) of a task alone join, each node with the least one of its tree."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := up.setdefault(x, x)) != x:
                up[x] = x = up[y]
            return x

        for b in batches:
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x, y = top(x), top(y)
                up[max(x, y)] = min(x, y)
        nodes = list(up)
        for k in range(0, len(nodes), 1 << 16):
            own = nodes[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([top(x) for x in own], pa.int64())], names=["node", "root"])

    return ends.mapInArrow(work, "node bigint, root bigint")


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the least node that can be reached) of every node of ``links`` (a, b; in any
    order, repeated or not). Links of a node with itself make it a component of its own; null ends are left out.

    Each task first joins FOREST links by itself; where that took several, their trees are then joined
    by alternating stars."""
    ends = links.where("a is not null and b is not null").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    nodes = written(ends, "links")
    tasks = max(1, -(-nodes.count() // FOREST))
    forest = written(_forest(nodes.coalesce(tasks)), "forest")
    if tasks == 1:
        return forest.withColumnRenamed("root", "component")
    edges = written(forest.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).dropDuplicates(), "links")
    state = None
    while True:
        edges = written(_star(written(_star(edges, True), "links"), False), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    every = forest.select("node").dropDuplicates()
    return every.join(edges.withColumnsRenamed({"a": "node", "b": "_least"}), "node", "left").select("node", F.coalesce("_least", "node").alias("component"))
