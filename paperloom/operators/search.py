"""Cosine search over a vector table: exact, and restricted to the nearest cells."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom import constants as C
from paperloom.functions.vectors import as_lists, as_matrix, is_finite, norm, typed_table, unit_rows
from paperloom.operators.bounded import VectorBlocks, broadcast_if_small, in_rounds
from paperloom.operators.ordering import top_per_key
from paperloom.session import materialized

SCORE_DIGITS = 6
# Scores, and components of vectors, that are worked on at a time.
_BLOCK_CELLS = 1_000_000


def _keys(column: pa.Array) -> np.ndarray:
    """Keys as a sortable numpy array, strings in code-point order."""
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False)
    return np.array(column.to_pylist(), dtype=str)


class _Best:
    """The best ``k`` candidates per query seen so far, ties to the smaller key."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.floor = np.full(queries, -np.inf)
        self.query = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)
        self.key: np.ndarray | None = None

    def add(self, keys: np.ndarray, scores: np.ndarray) -> None:
        """Take in a block of scores, one row per key and one column per query."""
        # A vector with an undefined element is no candidate and must not raise the floor.
        scores = np.where(np.isfinite(scores), scores, -np.inf)
        if len(keys) > self.k:
            kth = np.partition(scores, len(keys) - self.k, axis=0)[len(keys) - self.k]
            floor = np.maximum(self.floor, kth)
        else:
            floor = self.floor
        row, query = np.nonzero((scores >= floor) & np.isfinite(scores))
        key = keys[row] if self.key is None else np.concatenate([self.key, keys[row]])
        query_all = np.concatenate([self.query, query])
        score = np.concatenate([self.score, scores[row, query]])
        order = np.lexsort((key, -score, query_all))
        sorted_query = query_all[order]
        first = np.searchsorted(sorted_query, sorted_query, side="left")
        place = np.arange(len(order)) - first
        keep = order[place < self.k]
        self.query, self.score, self.key = query_all[keep], score[keep], key[keep]
        full = order[place == self.k - 1]
        self.floor[query_all[full]] = score[full]

    def table(self, names: list, schema: T.StructType) -> pa.Table:
        """Candidates as ``query, key, score`` rows."""
        keys = [] if self.key is None else self.key.tolist()
        found = ([names[q] for q in self.query], keys, self.score + 0.0)
        return typed_table(dict(zip(schema.names, found)), schema)


def _hit_type(corpus: DataFrame, key: str, queries: DataFrame, query_key: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(query_key, queries.schema[query_key].dataType),
            T.StructField(key, corpus.schema[key].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _rank(candidates: DataFrame, key: str, query_key: str, k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col(key)]
    ranked = top_per_key(candidates, [query_key], order, k, F.col(key))
    return ranked.select(query_key, F.col("rank").cast("int").alias("rank"), key, "score")


def topk_search(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 5,
    key: str = "row_id",
    vector: str = "embedding",
    query_key: str = "query_id",
    query_vector: str = "embedding",
    block_queries: int = C.BLOCK_VECTORS,
) -> DataFrame:
    """Exact top ``k`` rows of ``corpus`` by cosine for every query: ``query, rank, key, score``.

    Scores are rounded to six digits, ties go to the smaller key. Queries are shipped to
    the tasks in blocks of a fixed size; for each block the corpus is scanned in place, and
    a partition passes on at most ``k`` rows per query. Blocks go in rounds, whose hits are
    stored where there are several (see :func:`in_rounds`). Keys and query keys are unique.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    rows = corpus.select(key, vector).filter(F.col(vector).isNotNull())
    schema = _hit_type(corpus, key, queries, query_key)
    blocks = VectorBlocks(queries, query_key, query_vector, block_queries)

    def scan(shared: Broadcast) -> DataFrame:
        return rows.mapInArrow(partial(_scan, shared, k, schema), schema)

    return in_rounds(corpus.sparkSession, blocks, scan, "hits", lambda found: _rank(found, key, query_key, k))


def _scan(shared: Broadcast, k: int, schema: T.StructType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best ``k`` rows of a partition for every query of a block."""
    names, matrix = shared.value
    if names:
        yield from _best_rows(batches, names, unit_rows(matrix), k, schema).to_batches()


def _best_rows(batches: Iterable[pa.RecordBatch], names: list, asked: np.ndarray, k: int, schema: T.StructType) -> pa.Table:
    """The best ``k`` of the rows (key, vector) for every query, in blocked products."""
    best = _Best(len(names), k)
    step = max(1, _BLOCK_CELLS // max(len(names), asked.shape[1]))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            scores = unit_rows(as_matrix(part.column(1))) @ asked.T
            best.add(_keys(part.column(0)), np.round(scores, SCORE_DIGITS))
    return best.table(names, schema)


def with_hit_fields(hits: DataFrame, corpus: DataFrame, key: str, *fields: str) -> DataFrame:
    """Attach corpus columns to hits.

    Hits are stored, and broadcast where their bytes are few enough, so that the corpus,
    texts included, is scanned in place; more hits meet it in a shuffle join.
    """
    stored = materialized(hits, "hits")
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in hits.columns), F.lit(0))
    return broadcast_if_small(stored, width, C.BLOCK_BYTES).join(corpus.select(key, *fields), key)


@dataclass(frozen=True)
class CellIndex:
    """Cell centres of an inverted-file index."""

    centres: np.ndarray

    def assign(
        self, df: DataFrame, key: str = "row_id", vector: str = "embedding", output: str = "cell"
    ) -> DataFrame:
        """Add each row's cell: the centre with the highest cosine."""
        shared = df.sparkSession.sparkContext.broadcast(unit_rows(self.centres))

        @F.arrow_udf("int")
        def nearest(vectors: pa.Array) -> pa.Array:
            cells = np.argmax(unit_rows(as_matrix(vectors)) @ shared.value.T, axis=1)
            return pa.array(cells.astype(np.int32))

        return df.filter(F.col(vector).isNotNull()).withColumn(output, nearest(F.col(vector)))

    def nearest(self, spark: SparkSession, probes: int) -> Callable[[Column], Column]:
        """The ``probes`` cells whose centres have the highest cosine with a vector, the lesser cell first where they are equal."""
        shared = spark.sparkContext.broadcast(unit_rows(self.centres))

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def cells(vectors: pa.Array) -> pa.Array:
            near = np.argsort(-(unit_rows(as_matrix(vectors)) @ shared.value.T), axis=1, kind="stable")[:, :probes]
            return as_lists(near.astype(np.int32), pa.int32())

        return cells


def build_cells(
    df: DataFrame,
    vector: str = "embedding",
    cells: int = C.IVF_CELLS,
    fraction: float = 1.0,
    seed: int = C.DEFAULT_SEED,
) -> CellIndex:
    """Train cell centres with distributed k-means on all rows, or on the ``fraction`` the caller states."""
    usable = df.select(vector).filter(is_finite(F.col(vector)))
    sample = usable if fraction == 1.0 else usable.sample(fraction, seed=seed)
    points = sample.filter(norm(F.col(vector)) > 0).select(
        array_to_vector(F.col(vector).cast("array<double>")).alias("features")
    )
    model = KMeans(k=cells, seed=seed, distanceMeasure="cosine").fit(points)
    return CellIndex(np.array(model.clusterCenters()))


def cell_search(
    indexed: DataFrame,
    index: CellIndex,
    queries: DataFrame,
    k: int = 5,
    probes: int = 8,
    key: str = "row_id",
    vector: str = "embedding",
    query_key: str = "query_id",
    query_vector: str = "embedding",
    cell: str = "cell",
    block_queries: int = C.BLOCK_VECTORS,
    block_rows: int = C.BLOCK_VECTORS,
) -> DataFrame:
    """Top ``k`` among the rows of each query's ``probes`` nearest cells.

    Queries are exploded to the cells that they probe and meet the rows by an equi-join on the cell, in one plan for
    any number of queries. Only cells that some query probes are read, which prunes partitions when the table is
    stored by cell. The rows of a cell are dealt over groups of about ``block_rows``, its queries over groups of about
    ``block_queries``, so that a hot cell is many tasks. With as many probes as cells the result is the exact one.
    """
    if k < 1 or probes < 1:
        raise ValueError("k and probes must be at least 1")
    spark = indexed.sparkSession
    schema = _hit_type(indexed, key, queries, query_key)
    asked = queries.select(query_key, query_vector).filter(F.col(query_vector).isNotNull())
    near = F.explode(index.nearest(spark, probes)(F.col(query_vector))).alias("_cell")
    probed = materialized(asked.select(F.col(query_key).alias("_query"), F.col(query_vector).alias("_asked"), near), "probes")

    # One row per centre at most, and the index holds the centres in the driver.
    asking = {row["_cell"]: row["count"] for row in probed.groupBy("_cell").count().collect()}
    rows = indexed.filter(F.col(cell).isin(sorted(asking)) & F.col(vector).isNotNull())
    rows = rows.select(F.col(key).alias("_key"), F.col(vector).alias("_vector"), F.col(cell).alias("_cell"))
    there = {row["_cell"]: row["count"] for row in rows.groupBy("_cell").count().collect()}
    dealt = [(c, -(-n // block_rows), -(-asking[c] // block_queries)) for c, n in there.items()]
    parts = F.broadcast(spark.createDataFrame(dealt, "_cell int, _row_parts long, _query_parts long"))

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))

    def one_of(name: str, parts: str) -> Column:
        return F.pmod(F.xxhash64(name), F.col(parts))

    group = ["_cell", "_row_part", "_query_part"]
    left = rows.join(parts, "_cell").withColumn("_row_part", one_of("_key", "_row_parts"))
    left = left.select("_key", "_vector", "_cell", "_row_part", every("_query_parts").alias("_query_part"))
    right = probed.join(parts, "_cell").withColumn("_query_part", one_of("_query", "_query_parts"))
    right = right.select("_query", "_asked", "_cell", "_query_part", every("_row_parts").alias("_row_part"))

    def meet(near_rows: pa.Table, near_queries: pa.Table) -> pa.Table:
        if not near_rows.num_rows or not near_queries.num_rows:
            return typed_table({name: [] for name in schema.names}, schema)
        units = unit_rows(as_matrix(near_queries.column("_asked")))
        batches = near_rows.select(["_key", "_vector"]).to_batches()
        return _best_rows(batches, near_queries.column("_query").to_pylist(), units, k, schema)

    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(meet, schema)
    return _rank(found, key, query_key, k)
