"""Nearest neighbours by cosine: vantage-point trees over shards, pruned by the triangle inequality times a factor."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, small_batches
from .embeddings import _unit, _valid

#: Vectors in a shard, in a leaf of its tree, and queries in a block that is sent to all shards (8 MB at 64 dimensions).
SHARD, LEAF, QUERIES = 16_384, 64, 16_384
#: Most numbers in a shard: fewer of long vectors make one.
VALUES = 1 << 24
#: Share of the exact reach in which subtrees are entered: 1 is exact search, less is faster and may miss neighbours.
FACTOR = 0.9
#: Cosines that differ by less are compared again, pair by pair, before ids break the tie.
SLACK = 1e-9


def build_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes) of a vantage-point tree over unit vectors of one length.

    order lists the points so that each node is a stretch of it. A row of nodes is (first, end, inner, outer, inner_lo, inner_hi,
    outer_lo, outer_hi): order[first] is the vantage point; the rest are its nearer and farther half as nodes `inner` and `outer`,
    with the least and largest distance from it. A leaf has inner = -1 and holds its whole stretch. Halves are cut by
    rank, so any number of equal distances still gives a balanced tree.
    """
    order, nodes = np.arange(len(points)), []
    todo = [(0, len(points), None)]
    while todo:
        first, end, parent = todo.pop()
        if parent is not None:
            nodes[parent[0]][parent[1]] = len(nodes)
        own = order[first:end]
        if end - first <= LEAF:
            nodes.append([first, end, -1, -1, 0.0, 0.0, 0.0, 0.0])
            continue
        # Of some points, the one with the widest spread of distances splits best.
        tried = own[:: max(1, len(own) // 8)][:8]
        seen = own[:: max(1, len(own) // 256)]
        spread = [np.var(_distance(points[seen] @ points[t])) for t in tried]
        best = tried[int(np.argmax(spread))]
        rest = own[own != best]
        away = _distance(points[rest] @ points[best])
        ranked = np.argsort(away, kind="stable")
        rest, away, half = rest[ranked], away[ranked], len(rest) // 2
        order[first:end] = np.concatenate(([best], rest))
        at = len(nodes)
        nodes.append([first, end, 0, 0, away[0], away[half - 1], away[half], away[-1]])
        todo.append((first + 1 + half, end, (at, 3)))
        todo.append((first + 1, first + 1 + half, (at, 2)))
    return order, np.array(nodes, np.float64)


def _distance(cosine: np.ndarray) -> np.ndarray:
    """Of unit vectors: a metric, unlike the cosine."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


class _Best:
    """The candidates of each query so far, and the distance of its k-th nearest one."""

    def __init__(self, n: int, k: int):
        self.kept = np.full((n, k), -np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.visited = 0

    def reach(self, q: np.ndarray) -> np.ndarray:
        least = self.kept[q, 0]
        return np.where(np.isinf(least), np.inf, _distance(np.maximum(least, -1.0) - SLACK))

    def offer(self, q: np.ndarray, rows: np.ndarray, cosine: np.ndarray, weight: np.ndarray) -> None:
        """cosine[i, j] is that of query q[i] and row rows[j], which stands for weight[j] candidates; NaN where it is the query itself."""
        self.visited += cosine.size
        some, at = np.nonzero(cosine >= self.kept[q, :1] - SLACK)
        self.found.append((q[some], rows[at], cosine[some, at]))
        k = self.kept.shape[1]
        # A row that stands for several candidates is repeated, k times at most.
        wide = cosine if (weight == 1).all() else np.repeat(cosine, np.minimum(weight, k), axis=1)
        both = np.concatenate((self.kept[q], np.where(np.isnan(wide), -np.inf, wide)), axis=1)
        top = np.partition(both, -k, axis=1)[:, -k:]
        top.sort(axis=1)
        self.kept[q] = top


def search_tree(points: np.ndarray, nodes: np.ndarray, queries: np.ndarray, k: int, factor: float, weight: np.ndarray, own: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(query, row) pairs that hold each query's k nearest of the points, and the number of cosines taken.

    points in the tree's order; weight: candidates that a point stands for; own: the row that is a query itself and stands
    for no other, else -1; floor: a cosine that k candidates are known to reach. All queries walk the tree together: a node handles those
    that come by it. A query enters the half that it is in first. It enters the other only if that half's nearest point could lie
    within factor times the distance of its k-th best: |q v| - |p v| <= |q p| for every p.
    """
    best = _Best(len(queries), k)
    best.kept[:] = floor[:, None]

    def walk(at: int, q: np.ndarray) -> None:
        first, end, inner, outer = (int(x) for x in nodes[at, :4])
        rows = np.arange(first, end) if inner < 0 else np.arange(first, first + 1)
        cosine = queries[q] @ points[rows].T
        vantage = _distance(cosine[:, 0])
        cosine[own[q][:, None] == rows[None, :]] = np.nan
        best.offer(q, rows, cosine, weight[rows])
        if inner < 0:
            return
        lo_in, hi_in, lo_out, hi_out = nodes[at, 4:]
        near = vantage * 2 < hi_in + lo_out
        for side, child, lo, hi in ((near, inner, lo_in, hi_in), (~near, outer, lo_out, hi_out), (near, outer, lo_out, hi_out), (~near, inner, lo_in, hi_in)):
            gap = np.maximum(0.0, np.maximum(lo - vantage[side], vantage[side] - hi) - SLACK)
            go = q[side][gap <= factor * best.reach(q[side])]
            if len(go):
                walk(child, go)

    if len(queries):
        walk(0, np.arange(len(queries)))
    if not best.found:
        return np.empty(0, int), np.empty(0, int), 0
    q, rows, cosine = (np.concatenate(x) for x in zip(*best.found))
    keep = cosine >= best.kept[q, 0] - SLACK
    return q[keep], rows[keep], best.visited


def _prepared(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast(f"array<{kind}>").alias("v"))
    return rows.where(_valid("v")).select("vec_id", F.expr(f"transform(v, x -> x + {kind}(0))").alias("v"))


def build(vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The index: one row per shard and vector length, (d, n, ids, points, starts, nodes), written to the scratch folder.

    A task cuts the rows of its partition into shards as they come, so nothing is shuffled and no id, label or value can make a shard
    large. Equal vectors of a shard are one point with their k + 1 smallest ids, as no further one can be among k nearest.
    """
    kind = np.float32 if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else np.float64

    def shard(d: int, held: list[tuple[int | None, np.ndarray]]) -> dict:
        raw = np.array([v for _, v in held], kind)
        _, first, cls = np.unique(raw.view(np.dtype((np.void, raw.itemsize * d))).ravel(), return_index=True, return_inverse=True)
        ids: list[list] = [[] for _ in first]
        for (i, _), c in zip(held, cls.ravel()):
            ids[c].append(i)
        ids = [sorted(x, key=lambda i: (i is None, i))[: k + 1] for x in ids]
        order, nodes = build_tree(_unit(raw[first]))
        flat = [i for c in order for i in ids[c]]
        starts = np.concatenate(([0], np.cumsum([len(ids[c]) for c in order])))
        return {"d": d, "n": len(held), "ids": flat, "points": raw[first][order].tobytes(), "starts": starts.astype(np.int64).tobytes(), "nodes": nodes.tobytes()}

    names = {"d": pa.int32(), "n": pa.int64(), "ids": pa.list_(pa.int64()), "points": pa.binary(), "starts": pa.binary(), "nodes": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        told = lambda d: pa.RecordBatch.from_pylist([shard(d, held.pop(d))], pa.schema(names.items()))
        for batch in batches:
            ends, values = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy(zero_copy_only=False)
            for i, a, b in zip(batch.column(0).to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                held.setdefault(b - a, []).append((i, values[a:b].astype(kind)))
                if len(held[b - a]) == max(1, min(SHARD, VALUES // (b - a))):
                    yield told(b - a)
            while sum(map(len, held.values())) > 2 * SHARD or sum(d * len(x) for d, x in held.items()) > 2 * VALUES:  # many lengths: the largest goes first
                yield told(max(held, key=lambda d: d * len(held[d])))
        for d in list(held):
            yield told(d)

    small_batches(vectors.sparkSession)
    rows = _prepared(vectors, id_col, vector_col)
    return materialise(rows.mapInArrow(run, "d int, n long, ids array<bigint>, points binary, starts binary, nodes binary"), "vantage_trees")


def search(index: DataFrame, queries: DataFrame, k: int = 5, factor: float = FACTOR, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each query's k nearest in build()'s index: query_id, rank, vec_id, score. See nearest()."""
    spark = index.sparkSession
    asked = _prepared(queries, id_col, vector_col).where("vec_id is not null").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asked = materialise(asked, "queries")
    double = "double" in dict(asked.dtypes)["v"]
    n_blocks = -(-asked.count() // QUERIES)
    block = F.pmod(F.xxhash64("query_id"), F.lit(max(1, n_blocks)))
    found = [_search_block(index, asked.where(block == b), k, factor, np.float64 if double else np.float32) for b in range(n_blocks)]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_block(index: DataFrame, asked: DataFrame, k: int, factor: float, kind: type) -> DataFrame:
    """Up to k rows (query_id, vec_id, score) of each shard for each query of a block."""
    by: dict[int, tuple[list, list]] = {}
    for r in asked.collect():  # about QUERIES rows
        ids, vs = by.setdefault(len(r.v), ([], []))
        ids.append(r.query_id)
        vs.append(r.v)
    shared = index.sparkSession.sparkContext.broadcast({d: (np.array(ids, np.int64), np.array(vs, kind)) for d, (ids, vs) in by.items()})
    names = index.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[int, np.ndarray] = {}  # what the shards of this task have shown so far
        for batch in batches:
            for row in range(len(batch)):
                d, ids, points, starts, nodes = (batch.column(names.index(c))[row].as_py() for c in ("d", "ids", "points", "starts", "nodes"))
                if d not in shared.value:
                    continue
                asked_ids, asked_vs = shared.value[d]
                starts, nodes = np.frombuffer(starts, np.int64), np.frombuffer(nodes, np.float64).reshape(-1, 8)
                points = _unit(np.frombuffer(points, kind).reshape(-1, d))
                queries = _unit(asked_vs)
                place = {i: p for p in range(len(points)) for i in ids[starts[p] : starts[p + 1]]}
                at = np.array([place.get(i, -1) for i in asked_ids.tolist()], np.int64)
                weight = np.diff(starts)
                # The point of a query's own row counts for the others that it stands for; alone, it is left out.
                others = np.array([sum(i != q for i in ids[starts[p] : starts[p + 1]]) if p >= 0 else 1 for q, p in zip(asked_ids.tolist(), at)])
                shy = (at >= 0) & (others > 0)
                q, p, _ = search_tree(points, nodes, queries, k, factor, np.maximum(1, weight - np.isin(np.arange(len(points)), at[shy])), np.where(others == 0, at, -1), floors.setdefault(d, np.full(len(queries), -np.inf)))
                score = np.einsum("ij,ij->i", queries[q], points[p])
                out: dict[int, list] = {}
                for a, b, s in zip(q.tolist(), p.tolist(), score.tolist()):
                    out.setdefault(a, []).extend((-s, i is None, i or 0, i) for i in ids[starts[b] : starts[b + 1]] if i != asked_ids[a])
                rows = []
                for a, near in out.items():
                    near = sorted(near)[:k]
                    if len(near) == k:
                        floors[d][a] = max(floors[d][a], -near[-1][0] - SLACK)
                    rows += [(int(asked_ids[a]), x[3], -x[0]) for x in near]
                if rows:
                    a, b, s = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "vec_id", "score"])

    return index.mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, factor: float = FACTOR, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows nearest to each query row by cosine in doubles: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id.

    With factor 1 the result is exact; with less, what is returned has its true score, but a nearer row may be missed. Each shard is searched
    by all queries, block of queries by block, and gives k rows a query at most, of which the k best are ranked. A row is no neighbour of a query of its own
    vec_id, nor of vectors of another length. Of query rows that share an id the smallest vector asks. Repeated rows are all candidates; rows without
    vec_id are candidates, last among ties, and ask nothing. Vectors that are null, empty, zero or hold null or non-finite values take no
    part. Queries without candidates and an empty table give no rows. Extra columns are not read, whatever their names.
    """
    return search(build(vectors, k, id_col, vector_col), vectors.where(is_query), k, factor, id_col, vector_col)
