"""Similarity inside folds and against a reference set.

A fold is a bounded slice (see :mod:`paperloom.operators.folds`), so its vectors fit
one task and the cost over all folds grows with the rows. Matrices are made and used block by
block inside the task; only what a reducer makes of them leaves it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom import constants as C
from paperloom.functions.vectors import as_matrix, output_type, typed_table, unit_rows
from paperloom.operators.bounded import VectorBlocks, in_rounds

_BLOCK_CELLS = 4_000_000


def check_metric(metric: str, scaling: str | None) -> None:
    if metric not in C.SIMILARITY_METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose from {list(C.SIMILARITY_METRICS)}")
    if scaling is not None and scaling not in C.SIMILARITY_SCALINGS:
        raise ValueError(f"unknown scaling {scaling!r}; choose from {list(C.SIMILARITY_SCALINGS)}")


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    lengths = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :]
    return np.maximum(lengths - 2.0 * (a @ b.T), 0.0)


def similarity(
    a: np.ndarray, b: np.ndarray, metric: str, width: float = C.RBF_WIDTH, mean: float | None = None
) -> np.ndarray:
    """Similarity of every row of ``a`` to every row of ``b``.

    ``rbf`` divides by the mean squared distance of the whole matrix, or by ``mean``
    when ``a`` is only a block of it. If all points are equal, every value is 1.
    """
    if metric == "dot":
        return a @ b.T
    if metric == "cosine":
        return unit_rows(a) @ unit_rows(b).T
    squares = squared_distances(a, b)
    if metric == "euclidean":
        return 1.0 / (1.0 + squares)
    scale = width * (squares.mean() if mean is None else mean)
    return np.exp(-squares / scale) if scale > 0 else np.ones_like(squares)


def scale(values: np.ndarray, scaling: str | None, low: float, high: float) -> np.ndarray:
    """Scale a matrix in place; a fold's matrix is the largest thing a task holds."""
    if scaling == "additive":
        values += 1.0
        values /= 2.0
    elif scaling == "min-max" and high > low:
        values -= low
        values /= high - low
    return values


class FoldSimilarity:
    """The similarity matrix of one set of points, a block of rows at a time.

    The mean squared distance for ``rbf`` and the extremes for ``min-max`` belong to the whole matrix and take
    a pass over its blocks each. A block has a bounded number of values, so memory grows with the points
    and not with their square.
    """

    def __init__(self, vectors: np.ndarray, metric: str, scaling: str | None = None, width: float = C.RBF_WIDTH) -> None:
        # Cosine is the dot product of units, which are made once.
        self.points = unit_rows(vectors) if metric == "cosine" else vectors
        self.metric, self.scaling, self.width = "dot" if metric == "cosine" else metric, scaling, width
        self.mean: float | None = None
        self.low, self.high = 0.0, 0.0
        if metric == "rbf":
            self.mean = sum(squared_distances(part, self.points).sum() for _, part in self._parts()) / max(1, len(vectors)) ** 2
        if scaling == "min-max":
            extremes = [(raw.min(), raw.max()) for raw in map(self._raw, (part for _, part in self._parts()))]
            self.low, self.high = min(x[0] for x in extremes), max(x[1] for x in extremes)

    def _parts(self, columns: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
        step = max(1, _BLOCK_CELLS // max(1, columns or len(self.points)))
        for start in range(0, len(self.points), step):
            yield start, self.points[start : start + step]

    def _raw(self, part: np.ndarray, columns: np.ndarray | None = None) -> np.ndarray:
        return similarity(part, self.points if columns is None else columns, self.metric, self.width, self.mean)

    def blocks(self, columns: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """First row and values of every block of rows, for all columns or the given ones."""
        chosen = None if columns is None else self.points[columns]
        for start, part in self._parts(None if columns is None else len(columns)):
            yield start, scale(self._raw(part, chosen), self.scaling, self.low, self.high)


def row_profiles(keys: np.ndarray, matrix: FoldSimilarity) -> dict:
    """What each row of a fold's matrix looks like: extremes, total and nearest other row.

    Keys are in order, so that the first of equal rows has the smallest. A row alone in its fold has no nearest row.
    """
    parts: dict[str, list] = {name: [] for name in ("sim_min", "sim_max", "sim_sum", "place", "nearest_sim")}
    for start, values in matrix.blocks():
        rows = np.arange(len(values))
        parts["sim_min"].append(values.min(axis=1))
        parts["sim_max"].append(values.max(axis=1))
        parts["sim_sum"].append(values.sum(axis=1))
        others = np.round(values, 6)
        others[rows, start + rows] = -np.inf
        parts["place"].append(np.argmax(others, axis=1))
        parts["nearest_sim"].append(others[rows, parts["place"][-1]])
    found = {name: np.concatenate(blocks) for name, blocks in parts.items()}
    place = found.pop("place")
    alone = {"nearest": [None], "nearest_sim": [None]} if len(keys) == 1 else {"nearest": keys[place]}
    return {"n": np.full(len(keys), len(keys))} | found | alone


def per_fold(
    folded: DataFrame,
    reduce: Callable[[pa.Table, FoldSimilarity], dict],
    schema: T.StructType,
    key: str,
    vector: str,
    metric: str = "cosine",
    scaling: str | None = None,
    width: float = C.RBF_WIDTH,
    extra: tuple[str, ...] = (),
    groups: tuple[str, ...] = ("dataset",),
) -> DataFrame:
    """Apply ``reduce(rows, similarity)`` to every fold, rows sorted by key.

    It returns the columns of ``schema``. A fold is one task that holds the fold's vectors and one
    block of similarities.
    """
    check_metric(metric, scaling)

    def task(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(key)
        matrix = FoldSimilarity(as_matrix(rows.column(vector)), metric, scaling, width)
        return typed_table(reduce(rows, matrix), schema)

    needed = folded.select(*groups, "fold", key, vector, *extra).filter(F.col(vector).isNotNull())
    return needed.groupBy(*groups, "fold").applyInArrow(task, schema)


def fold_profiles(
    folded: DataFrame,
    metric: str = "cosine",
    scaling: str | None = None,
    key: str = "row_id",
    vector: str = "embedding",
    width: float = C.RBF_WIDTH,
) -> DataFrame:
    """Profile of every row within its fold's similarity matrix."""

    def reduce(rows: pa.Table, matrix: FoldSimilarity) -> dict:
        keys = rows.column(key).to_numpy()
        columns = {"dataset": rows.column("dataset"), "fold": rows.column("fold"), key: keys}
        return columns | row_profiles(keys, matrix)

    schema = output_type(
        folded,
        {
            "dataset": "dataset",
            "fold": "int",
            key: key,
            "n": "long",
            "sim_min": "double",
            "sim_max": "double",
            "sim_sum": "double",
            "nearest": key,
            "nearest_sim": "double",
        },
    )
    return per_fold(folded, reduce, schema, key, vector, metric, scaling, width)


def coverage(
    folded: DataFrame,
    member_of: str,
    key: str = "row_id",
    vector: str = "embedding",
) -> DataFrame:
    """Facility-location value of selected sets: the sum over all rows of a fold of the
    highest scaled similarity to a selected row.

    ``member_of`` names the set that a row is selected for; NULL means not selected. Rows are compared with the
    members of a set only.
    """

    def reduce(rows: pa.Table, matrix: FoldSimilarity) -> dict:
        sets = rows.column(member_of).combine_chunks()
        names = sets.drop_null().unique()
        picked = [
            np.flatnonzero(pc.equal(sets, name).fill_null(False).to_numpy(zero_copy_only=False))
            for name in names
        ]
        return {
            "dataset": rows.column("dataset").to_pylist()[:1] * len(names),
            "fold": rows.column("fold").to_pylist()[:1] * len(names),
            member_of: names,
            "coverage": [sum(values.max(axis=1).sum() for _, values in matrix.blocks(members)) for members in picked],
        }

    schema = output_type(
        folded,
        {"dataset": "dataset", "fold": "int", member_of: member_of, "coverage": "double"},
    )
    return per_fold(
        folded, reduce, schema, key, vector, "cosine", "additive", extra=(member_of,)
    )


def nearest_reference(
    df: DataFrame,
    references: DataFrame,
    metric: str = "cosine",
    scaling: str | None = None,
    key: str = "row_id",
    vector: str = "embedding",
    reference_key: str = "ref_id",
    width: float = C.RBF_WIDTH,
    block_references: int = C.BLOCK_VECTORS,
) -> DataFrame:
    """Similarity of a table's rows to a reference set, as a profile per row; keys are unique.

    References are shipped to the tasks in blocks of a fixed size, one after the other: for each block the
    table is scanned in place, the profiles are appended to a stored table and the block is dropped. So neither the
    plan nor the driver grows with the references. The profiles of a row, not its vector, then meet by key.
    Ties go to the smaller reference. Statistics of the whole matrix (the mean squared
    distance for ``rbf``, the extremes for ``min-max``) come from one more round over it.
    """
    check_metric(metric, scaling)
    blocks = VectorBlocks(references, reference_key, vector, block_references)
    rows = df.select(key, vector).filter(F.col(vector).isNotNull())

    def scan(emit, schema) -> DataFrame:
        """``emit`` applied to every block of rows beside every block of references."""
        return in_rounds(df.sparkSession, blocks, lambda shared: rows.mapInArrow(partial(_beside, shared, emit), schema), "profiles")

    mean = None
    if metric == "rbf":

        def distances(keys: pa.Array, block: np.ndarray, names: np.ndarray, matrix: np.ndarray) -> pa.Table:
            squares = squared_distances(block, matrix)
            return pa.table({"total": [squares.sum()], "n": [squares.size]})

        found = scan(distances, "total double, n long").agg(F.sum("total"), F.sum("n")).first()
        mean = found[0] / found[1] if found[1] else 0.0

    low, high = 0.0, 0.0
    if scaling == "min-max":

        def extremes(keys: pa.Array, block: np.ndarray, names: np.ndarray, matrix: np.ndarray) -> pa.Table:
            sims = similarity(block, matrix, metric, width, mean)
            return pa.table({"low": [sims.min()], "high": [sims.max()]})

        found = scan(extremes, "low double, high double").agg(F.min("low"), F.max("high")).first()
        low, high = found[0] or 0.0, found[1] or 0.0

    schema = T.StructType(
        [T.StructField(key, df.schema[key].dataType)]
        + [T.StructField(n, T.DoubleType()) for n in ("sim_min", "sim_max", "sim_sum", "score")]
        + [T.StructField("nearest", references.schema[reference_key].dataType)]
    )

    def profiles(keys: pa.Array, block: np.ndarray, names: np.ndarray, matrix: np.ndarray) -> pa.Table:
        sims = scale(similarity(block, matrix, metric, width, mean), scaling, low, high)
        rounded = np.round(sims, 6)
        best = np.argmax(rounded, axis=1)
        columns = {
            key: keys,
            "sim_min": sims.min(axis=1),
            "sim_max": sims.max(axis=1),
            "sim_sum": sims.sum(axis=1),
            "score": rounded[np.arange(len(best)), best] + 0.0,
            "nearest": names[best],
        }
        return typed_table(columns, schema)

    return (
        scan(profiles, schema)
        .groupBy(key)
        .agg(
            F.min("sim_min").alias("sim_min"),
            F.max("sim_max").alias("sim_max"),
            F.sum("sim_sum").alias("sim_sum"),
            F.min(F.struct((-F.col("score")).alias("score"), "nearest"))["nearest"].alias("nearest"),
        )
    )


def _beside(shared, emit, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``emit`` makes of keys, vectors and a block of references, slice by slice."""
    names, matrix = shared.value
    names = np.asarray(names)
    if not len(names):
        return
    step = max(1, _BLOCK_CELLS // len(names))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield from emit(part.column(0), as_matrix(part.column(1)), names, matrix).to_batches()
