"""Exact top-k by inner product: a cover tree over each block of vectors and one over the queries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import materialized, scratch_path

LEAF = 48
SHRINK = 0.7
#: Vectors under one tree, and queries in one broadcast.
BLOCK_ROWS = 4096
QUERY_ROWS = 2048
SCALE = 1024


class CoverTree:
    """Nodes with a centre that is one of their points, a covering radius, and children or points.

    A child covers what lies within ``SHRINK`` times its parent's radius of the child's centre, and
    centres of one parent are further apart than that. Radii are then cut to what is covered.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.centre, self.radius, self.children, self.members = [], [], [], []
        if len(points):
            self._add(np.arange(len(points)))

    def _add(self, members: np.ndarray) -> int:
        stack, root = [(members, -1)], len(self.centre)
        while stack:
            members, parent = stack.pop()
            node, centre = len(self.centre), self.points[members[0]]
            away = np.linalg.norm(self.points[members] - centre, axis=1)
            self.centre.append(centre)
            self.radius.append(float(away.max()))
            self.children.append([])
            self.members.append(None)
            if parent >= 0:
                self.children[parent].append(node)
            if len(members) <= LEAF or away.max() == 0:
                self.members[node] = members
                continue
            reach, rest, groups = away.max() * SHRINK, members, []
            while len(rest):
                near = np.linalg.norm(self.points[rest] - self.points[rest[0]], axis=1) <= reach
                groups.append(rest[near])
                rest = rest[~near]
            # Points that cover nobody else stand together in one leaf.
            lonely = [g for g in groups if len(g) <= 4]
            groups = [g for g in groups if len(g) > 4]
            together = np.concatenate(lonely) if lonely else np.empty(0, np.int64)
            for first in range(0, len(together), LEAF):
                groups.append(together[first : first + LEAF])
            stack += [(group, node) for group in groups]
        return root

    def finish(self) -> CoverTree:
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)
        self.norm = np.linalg.norm(self.centre, axis=1) if len(self.centre) else np.empty(0)
        self.children = [np.array(c, np.int64) for c in self.children]
        return self


class Best:
    """The k best (score, smaller id) of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.exact = [[None] * k for _ in range(queries)]

    def floor(self, queries: np.ndarray) -> float:
        """Worst kth score of a group of queries."""
        return float(self.scores[queries, -1].min())

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        kept = np.flatnonzero(scores >= self.scores[query, -1])
        if not len(kept):
            return
        scores, ids = scores[kept], ids[kept]
        values = [*self.exact[query], *scores.tolist()]
        scores = np.concatenate((self.scores[query], scores.astype(np.float64)))
        ids = np.concatenate((self.ids[query], ids))
        order = sorted(range(len(values)), key=lambda i: (values[i] is None, -(values[i] or 0), ids[i]))[: self.k]
        self.scores[query], self.ids[query] = scores[order], ids[order]
        self.exact[query] = [values[i] for i in order]


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products: floats where they are exact, else whole numbers of any size."""
    size = max(left.shape[1], 1)
    largest = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * size
    if largest < 2**53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    if largest < 2**63:
        return left @ right.T
    return left.astype(object) @ right.T.astype(object)


def search(queries: CoverTree, query_ints: np.ndarray, query_ids: np.ndarray, data: CoverTree, ints: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """Walk both trees together, nearest pairs first, and drop pairs that cannot reach a kth score."""
    below: dict[int, np.ndarray] = {}

    def members(node: int) -> np.ndarray:
        if node not in below:
            own = queries.members[node]
            below[node] = own if own is not None else np.concatenate([members(c) for c in queries.children[node]])
        return below[node]

    def bounds(q: int, nodes: np.ndarray) -> np.ndarray:
        """No query under ``q`` scores more with a point under each node."""
        straight = data.centre[nodes] @ queries.centre[q]
        limit = straight + queries.norm[q] * data.radius[nodes] + queries.radius[q] * (data.norm[nodes] + data.radius[nodes])
        return limit + 1e-9 * np.abs(limit) + 1e-6

    stack = [(np.inf, 0, 0)]
    while stack:
        bound, q, x = stack.pop()
        if bound < best.floor(members(q)):
            continue
        q_own, x_own = queries.members[q], data.members[x]
        if q_own is not None and x_own is not None:
            scores = exact_scores(query_ints[q_own], ints[x_own])
            for row, query in enumerate(q_own.tolist()):
                other = ids[x_own] != query_ids[query]
                best.add(query, scores[row][other], ids[x_own][other])
            continue
        if x_own is None:
            nodes = data.children[x]
            pairs = [(b, q, n) for b, n in zip(bounds(q, nodes).tolist(), nodes.tolist())]
        else:
            pairs = [(float(bounds(c, np.array([x]))[0]), c, x) for c in queries.children[q].tolist()]
        # A pair of inner nodes opens the data first, then the queries at the data's leaves.
        stack += sorted(pairs)


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """Whole numbers floor(scale * x); null where the vector is null or holds a null or non-finite component."""
    number = F.transform(vector, lambda x: x.cast("double"))
    wrong = F.exists(number, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~wrong, F.transform(number, lambda x: F.floor(x * scale).cast("long")))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _search_partition(query_ids: np.ndarray, query_ints: np.ndarray, k: int):
    size = query_ints.shape[1]

    def step(batches):
        queries = CoverTree(query_ints.astype(np.float64)).finish()
        best = Best(len(query_ids), k)

        def look(parts) -> None:
            ids = np.concatenate([p.column("id").to_numpy() for p in parts])
            ints = np.concatenate([_matrix(p.column("v"), size) for p in parts])
            search(queries, query_ints, query_ids, CoverTree(ints.astype(np.float64)).finish(), ints, ids, best)

        waiting, rows = [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                waiting.append(batch.slice(first, BLOCK_ROWS))
                rows += waiting[-1].num_rows
                if rows >= BLOCK_ROWS:
                    look(waiting)
                    waiting, rows = [], 0
        if rows:
            look(waiting)
        found = [(q, i, s) for q, ids, row in zip(query_ids.tolist(), best.ids.tolist(), best.exact) for i, s in zip(ids, row) if s is not None]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[n] for f in found], pa.int64()) for n in range(3)], ["query_id", "vec_id", "score"]
        )

    return step


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", query_rows: int = QUERY_ROWS
) -> DataFrame:
    """For each query the ``k`` vectors of highest inner product: (query_id, rank, vec_id, score).

    Vectors are compared as whole numbers floor(1024 * x), so that scores are exact; equal scores go to the smaller
    key. A query's own key is no hit. Vectors or keys that are null, and vectors with null or non-finite components, take
    no part on either side. Only vectors of the query's length are compared. Rows that repeat a key are hits of
    their own; queries that repeat a key are one query, with the smallest vector. Empty tables give no rows.

    Queries go to the tasks in blocks of bounded size, each block over one scan of the vectors; a task keeps
    its best ``k`` per query across its trees, and only these are shuffled.
    """
    spark = vectors.sparkSession
    data = vectors.select(F.col(key).cast("long").alias("id"), scaled(F.col(vector)).alias("v")).dropna()
    asked = queries.select(F.col(key).cast("long").alias("id"), scaled(F.col(vector)).alias("v")).dropna()
    asked = materialized(asked.groupBy("id").agg(F.min("v").alias("v")), "queries")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    path, blocks = scratch_path(spark, "hits"), []
    for size, rows in sorted((r["size"], r["count"]) for r in asked.groupBy(F.size("v").alias("size")).count().collect()):
        count = -(-rows // query_rows)
        blocks += [(size, count, block) for block in range(count)]
    for number, (size, count, block) in enumerate(blocks):
        part = asked.where((F.size("v") == size) & (F.pmod(F.xxhash64("id"), F.lit(count)) == block)).toArrow()
        if not part.num_rows:
            continue
        ids, ints = part.column("id").to_numpy(), _matrix(part.column("v").combine_chunks(), size)
        sent = spark.sparkContext.broadcast((ids, ints))
        step = lambda batches, sent=sent: _search_partition(*sent.value, k)(batches)
        found = data.where(F.size("v") == size).mapInArrow(step, "query_id long, vec_id long, score long")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked = ranked.select("query_id", "rank", "vec_id", "score")
        if len(blocks) == 1:
            return ranked
        ranked.write.mode("append").parquet(path)
    schema = "query_id long, rank int, vec_id long, score long"
    return spark.read.schema(schema).parquet(path) if blocks else spark.createDataFrame([], schema)
