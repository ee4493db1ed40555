"""Exact top-k search by inner product with cover trees on both sides.

Rows are dealt into cells around sampled centres, large cells into parts; each block of about
``block_rows`` rows gets a cover tree of its data and one of its queries. Blocks meet in two rounds:
every query group with its own block, which gives each query a first kth score; then with all blocks
whose covering radii allow a score that good. That is tested on centres and radii alone, before any
vector is moved: a block is sent to those groups of query blocks only that it may serve. Within a
pair of blocks both trees are descended at once, and a pair of nodes is dropped if the largest product
their radii allow is below the worst kth score of the query node. Pruning is only ever by bounds
that hold, so results are exact; on data without clusters nothing can be pruned and every query
meets every row, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stintgraph.llm.shared import raw, written

K, BLOCK_ROWS, LEAF_ROWS = 20, 1024, 128
#: Centres are rows of a sample of at most so many, the first in order of their ids' hashes, that lie apart.
MAX_CENTRES = 256
#: Blocks that share a task: so many of data with so many of queries.
TOGETHER = 8
#: Blocks whose centres and radii are tested in one task, with as many query blocks.
TESTED = 2048


class CoverTree:
    """Nodes as (point, covering radius, norm of the point, rows, children); rows of a leaf in one array.
    A node stands for a row of its own. On each level the scale halves: children are the node itself
    (nesting) and rows that lie over the scale from it and from each other (separation), and every row
    is under the first child within the scale (covering). A node stays a leaf with LEAF_ROWS rows or
    fewer, or where the next level would part most rows from all others."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points.astype(np.float64)
        rows = np.arange(len(points))
        far = self._far(self.points.mean(0), rows) if len(rows) else rows
        self.root = self._node(int(np.argmin(far)), rows, math.inf) if len(rows) else (np.zeros(points.shape[1]), 0.0, 0.0, rows, ())

    def _far(self, of: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.points[rows] - of) ** 2).sum(1))

    def _node(self, own: int, rows: np.ndarray, scale: float) -> tuple:
        point = self.points[own]
        radius = float(self._far(point, rows).max(initial=0.0))
        node = (point, radius, float(np.sqrt((point**2).sum())), rows)
        if len(rows) <= LEAF_ROWS or radius == 0:
            return (*node, ())
        scale, left, parts = min(scale, radius) / 2, rows, []
        while len(left):
            child = own if not parts else int(left[0])
            near = self._far(self.points[child], left) <= scale
            near[left == child] = True
            parts.append((child, left[near]))
            left = left[~near]
            if len(parts) * 4 > len(rows):
                return (*node, ())
        return (*node, tuple(self._node(c, p, scale) for c, p in parts))


def bound(a: tuple, b: tuple) -> float:
    """No product of a row of node ``a`` and one of ``b`` is larger."""
    top = float(a[0] @ b[0]) + a[2] * b[1] + b[2] * a[1] + a[1] * b[1]
    return top + 1e-9 * (abs(top) + (a[2] + a[1]) * (b[2] + b[1])) + 1e-6


def bounds(a: np.ndarray, ra: np.ndarray, b: np.ndarray, rb: np.ndarray) -> np.ndarray:
    """``bound`` of all pairs of centres ``a`` and ``b``, with their radii."""
    na, nb = np.sqrt((a**2).sum(1))[:, None], np.sqrt((b**2).sum(1))[None, :]
    ra, rb = ra[:, None], rb[None, :]
    top = a @ b.T + na * rb + nb * ra + ra * rb
    return top + 1e-9 * (np.abs(top) + (na + ra) * (nb + rb)) + 1e-6


def apart(points: np.ndarray, n: int) -> list[int]:
    """``n`` of the points (all, if fewer), each as far from those before it as any is."""
    out, far = [0], np.full(len(points), np.inf)
    while len(out) < min(n, len(points)):
        far = np.minimum(far, ((points - points[out[-1]]) ** 2).sum(1))
        out.append(int(np.argmax(far)))
    return out


def chained(centres: np.ndarray) -> list[int]:
    """An order of the centres in which each is followed by the nearest one that is left."""
    left, out = list(range(1, len(centres))), [0] if len(centres) else []
    while left:
        out.append(left.pop(int(np.argmin(((centres[left] - centres[out[-1]]) ** 2).sum(1)))))
    return out


def small(whole: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as hold them all, behind their number."""
    least, most = int(whole.min(initial=0)), int(whole.max(initial=0))
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= least and most <= np.iinfo(t).max)
    return bytes([np.dtype(kind).itemsize]) + raw(whole.astype(kind))


def grown(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<i{packed[0]}", offset=1).astype(np.int64)


class Best:
    """The k best (score, id) of each query: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.kth = k, np.full(n, -np.inf)
        self.q, self.score, self.id = np.empty(0, np.int64), np.empty(0, object), np.empty(0, np.int64)

    def add(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        """``scores``: of queries ``q`` (with ids ``own``) by rows of ``ids``."""
        fits = own[:, None] != ids[None, :]
        least = self.kth[q][:, None]
        if scores.shape[1] > self.k and scores.dtype != object:
            ranked = np.where(fits, scores, -np.inf)
            least = np.maximum(least, np.partition(ranked, -self.k, 1)[:, -self.k][:, None])
        at, col = np.nonzero(fits & (scores >= least))
        if not len(at):
            return
        new = scores[at, col]
        self.q, self.score, self.id = np.concatenate([self.q, q[at]]), np.concatenate([self.score, new]) if len(self.q) else new, np.concatenate([self.id, ids[col]])
        order = np.lexsort((self.id, -self.score, self.q)) if self.score.dtype != object else np.array(sorted(range(len(self.q)), key=lambda i: (self.q[i], -self.score[i], self.id[i])), int)
        self.q, self.score, self.id = self.q[order], self.score[order], self.id[order]
        first = np.searchsorted(self.q, self.q)
        rank = np.arange(len(self.q)) - first
        held = rank < self.k
        last = rank == self.k - 1
        self.kth[self.q[last]] = self.score[last].astype(float)
        self.q, self.score, self.id = self.q[held], self.score[held], self.id[held]


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """In which whole products of ``a`` and ``b`` are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def search(queries: CoverTree, query_ids: np.ndarray, whole_queries: np.ndarray, data: CoverTree, ids: np.ndarray, whole: np.ndarray, best: Best) -> None:
    """Dual-tree descent; better pairs of nodes first."""
    kind = exact_type(whole_queries, whole)
    left, right = whole_queries.astype(kind), whole.astype(kind)
    stack = [(queries.root, data.root)]
    while stack:
        a, b = stack.pop()
        if not len(a[3]) or not len(b[3]) or bound(a, b) < best.kth[a[3]].min():
            continue
        if not a[4] and not b[4]:
            best.add(a[3], left[a[3]] @ right[b[3]].T, ids[b[3]], query_ids[a[3]])
            continue
        split_left = a[4] and (not b[4] or a[1] >= b[1])
        pairs = [(x, b) for x in a[4]] if split_left else [(a, x) for x in b[4]]
        stack += sorted(pairs, key=lambda p: bound(*p))


def quantized(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """_id, _v (array of long: floor(scale * x)), of vectors that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    ok = vectors.select(F.col(f"`{key}`").cast("bigint").alias("_id"), v.alias("_v")).where(F.col("_id").isNotNull() & F.col("_v").isNotNull())
    usable = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return ok.where(usable).select("_id", F.transform("_v", lambda x: F.floor(x * scale)).alias("_v"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim)


def top_k(vectors: DataFrame, every: int, k: int = K, key: str = "vec_id", vector: str = "embedding", scale: int = 64, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id long, rank int (from 1), vec_id long, score long: for every row whose id is divisible by
    ``every``, its k rows of highest whole inner product (all, if fewer), ties to smaller ids. Rows
    of the query's own id are left out.

    Vectors null, with a null id, or holding null or non-finite components take no part. Vectors of
    different lengths don't meet. Of rows that repeat an id each is a query and a candidate. Extra
    columns aren't read. Components and scores beyond the range of long are held at its ends.
    """
    rows = quantized(vectors, key, vector, scale).withColumn("_dim", F.size("_v"))
    sample = rows.orderBy(F.xxhash64("_id"), "_id").limit(MAX_CENTRES).collect()
    centres = {d: np.array([r._v for r in sample if r._dim == d], float) for d in {r._dim for r in sample}}

    n = rows.count()
    wanted = max(1, math.ceil(n / block_rows))
    # neighbours in number are neighbours in space, as far as a chain can be
    centres = {d: c[chained(c)] for d, c in ((d, c[apart(c, wanted)]) for d, c in centres.items())}

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = np.random.default_rng(TaskContext.get().partitionId())
        for b in batches:
            cells = np.zeros(b.num_rows, np.int32)
            dims = b.column(2).to_numpy()
            for d in set(dims.tolist()) & centres.keys():
                at, c = np.flatnonzero(dims == d), centres[d]
                if d:
                    x = b.column(1).take(pa.array(at)).flatten().to_numpy().reshape(len(at), d).astype(float)
                    cells[at] = np.argmax(x @ c.T - (c**2).sum(1) / 2, 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells), pa.array(dealt.random(b.num_rows))], names=["_id", "_v", "_dim", "_cell", "_any"])

    celled = written(rows.mapInArrow(cell, "_id bigint, _v array<bigint>, _dim int, _cell int, _any double"), "vectors")
    sizes = celled.groupBy("_dim", "_cell").count()
    parts = sizes.select("_dim", "_cell", F.ceil(F.col("count") / block_rows).alias("_parts"))
    # a row for each cell, of which there are MAX_CENTRES for a length of vectors
    starts = F.sum("_parts").over(Window.orderBy("_dim", "_cell")) - F.col("_parts")
    parts = written(parts.withColumn("_start", starts), "cells")
    total = parts.agg(F.sum("_parts")).first()[0] or 0
    number = (F.col("_start") + F.floor(F.col("_any") * F.col("_parts"))).alias("_block")
    dealt = celled.join(parts, ["_dim", "_cell"]).select("_id", "_v", "_dim", number)
    block_schema = "_block bigint, _dim int, ids binary, whole binary, qids binary, queries binary, centre binary, radius double, qcentre binary, qradius double, kth double, own binary"

    def block(table: pa.Table) -> pa.Table:
        dim = table["_dim"][0].as_py()
        ids, whole = table["_id"].to_numpy(), _matrix(table["_v"], dim)
        asked = ids % every == 0
        data, queries = CoverTree(whole), CoverTree(whole[asked])
        best = Best(int(asked.sum()), k)
        search(queries, ids[asked], whole[asked], data, ids, whole, best)
        worst = float(best.kth.min()) if asked.any() else math.inf
        row = [table["_block"][0].as_py(), dim, raw(ids), small(whole), raw(ids[asked]), small(whole[asked]), raw(data.root[0]), data.root[1], raw(queries.root[0]), queries.root[1], worst, pack_best(best)]
        names = [x.split(" ")[0] for x in block_schema.split(", ")]
        return pa.table([pa.array([x], t) for x, t in zip(row, _BLOCK_TYPES, strict=True)], names=names)

    numbered = written(dealt.groupBy("_dim", "_block").applyInArrow(block, block_schema), "blocks")
    data_side = numbered.select("_block", "_dim", "ids", "whole", "centre", "radius")
    query_side = numbered.where(F.octet_length("qids") > 0).select(F.col("_block").alias("_of"), F.col("_dim").alias("_qdim"), "qids", "queries", "qcentre", "qradius", "kth", "own")

    def allowed(data: pa.Table, queries: pa.Table) -> pa.Table:
        """Of blocks and query blocks that may meet: kind 0, a block and a group of query blocks; kind 1, a query block and a group of blocks."""
        found: set[tuple[int, int, int]] = set()
        for dim in set(data["_dim"].to_pylist()) & set(queries["_qdim"].to_pylist()):
            d, q = (t.filter(pa.compute.equal(t[c], dim)) for t, c in ((data, "_dim"), (queries, "_qdim")))
            x, y = (np.frombuffer(b"".join(c.to_pylist())).reshape(-1, dim) if dim else np.zeros((len(c), 0)) for c in (d["centre"], q["qcentre"]))
            tops = bounds(y, q["qradius"].to_numpy(), x, d["radius"].to_numpy())
            number, of = d["_block"].to_numpy(), q["_of"].to_numpy()
            i, j = np.nonzero((tops >= q["kth"].to_numpy()[:, None]) | (of[:, None] == number[None, :]))
            found.update(zip([0] * len(i), number[j].tolist(), (of[i] // TOGETHER).tolist(), strict=True))
            found.update(zip([1] * len(i), of[i].tolist(), (number[j] // TOGETHER).tolist(), strict=True))
        columns = [*map(list, zip(*found, strict=True))] if found else [[], [], []]
        return pa.table([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["kind", "number", "group"])

    tested = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(0, (total - 1) // TESTED)).cast("bigint")))
    of_chunk = lambda c: F.floor(F.col(c) / TESTED)
    slim = data_side.select("_block", "_dim", "centre", "radius", of_chunk("_block").alias("_x"), tested.alias("_y"))
    asking = query_side.select("_of", "_qdim", "qcentre", "qradius", "kth", of_chunk("_of").alias("_y"), tested.alias("_x"))
    pairs = slim.groupBy("_x", "_y").cogroup(asking.groupBy("_x", "_y")).applyInArrow(allowed, "kind int, number bigint, group bigint")
    meeting = written(pairs.dropDuplicates(), "meeting")
    to = lambda kind, c, group: meeting.where(F.col("kind") == kind).select(F.col("number").alias(c), F.col("group").alias(group)).hint("merge")
    by = lambda c: F.floor(F.col(c) / TOGETHER).alias(f"{c}_group")
    left = data_side.join(to(0, "_block", "_of_group"), "_block").select("*", by("_block"))
    right = query_side.join(to(1, "_of", "_block_group"), "_of").select("*", by("_of"))

    def meet(data: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        loaded: dict[int, tuple] = {}
        for q in queries.to_pylist():
            dim = q["_qdim"]
            qids, asked = np.frombuffer(q["qids"], np.int64), grown(q["queries"]).reshape(-1, dim)
            best, tree = unpack_best(q["own"], len(qids), k), None
            qroot = (np.frombuffer(q["qcentre"]), q["qradius"], float(np.sqrt((np.frombuffer(q["qcentre"]) ** 2).sum())))
            home = False
            for i in range(data.num_rows):
                number = data["_block"][i].as_py()
                if data["_dim"][i].as_py() != dim:
                    continue
                if number == q["_of"]:
                    home = True
                    continue
                centre = np.frombuffer(data["centre"][i].as_py())
                if bound(qroot, (centre, data["radius"][i].as_py(), float(np.sqrt((centre**2).sum())))) < best.kth.min():
                    continue
                if number not in loaded:
                    whole = grown(data["whole"][i].as_py()).reshape(-1, dim)
                    loaded[number] = (CoverTree(whole), np.frombuffer(data["ids"][i].as_py(), np.int64), whole)
                tree = tree or CoverTree(asked)
                search(tree, qids, asked, *loaded[number], best)
            # the first round's own rows are told once, where the query's own block is; elsewhere only what is new
            seen = unpack_best(q["own"], len(qids), k)
            old = set() if home else set(zip(seen.q.tolist(), seen.id.tolist(), seen.score.tolist(), strict=True))
            out += [(q["_of"], int(a), int(qids[a]), int(i), _long(s)) for a, i, s in zip(best.q, best.id, best.score, strict=True) if home or (a, i, s) not in old]
        columns = [*map(list, zip(*out, strict=True))] if out else [[], [], [], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["_of", "_at", "query_id", "vec_id", "score"])

    keys = ["_block_group", "_of_group"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "_of bigint, _at bigint, query_id bigint, vec_id bigint, score bigint")
    return _ranked(met, k)


_BLOCK_TYPES = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.binary(), pa.float64(), pa.float64(), pa.binary()]


def _long(x: object) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(x)))


def pack_best(best: Best) -> bytes:
    return raw(np.concatenate([best.q, np.array([_long(x) for x in best.score], np.int64), best.id]).astype(np.int64))


def unpack_best(packed: bytes, n: int, k: int) -> Best:
    best = Best(n, k)
    best.q, score, best.id = np.frombuffer(packed, np.int64).reshape(3, -1)
    best.score = score.astype(float) if (np.abs(score.astype(float)) < 2.0**53).all() else score.astype(object)
    counts = np.bincount(best.q, minlength=n)
    last = np.cumsum(counts) - 1
    full = counts == k
    best.kth[full] = best.score[last[full]].astype(float)
    return best


def _ranked(met: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_of", "_at").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_cover_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=20)


QUERIES = {"op5_cover_tree_top_k": op5_cover_tree_top_k}
ORACLE_SQL = {
    "op5_cover_tree_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score FROM v q, v d WHERE q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20"""
}
