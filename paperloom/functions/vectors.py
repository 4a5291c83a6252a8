"""Vector expressions, and the Arrow/numpy bridge used inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from paperloom import constants as C


def norm(vector: Column) -> Column:
    """Euclidean length in double precision."""
    squares = F.aggregate(
        vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def l2_normalize(vector: Column) -> Column:
    """Unit-length vector; the zero vector stays zero."""
    length = F.greatest(norm(vector), F.lit(C.NORM_FLOOR))
    return F.transform(vector, lambda x: x.cast("double") / length)


def is_valid(vector: Column, dim: int) -> Column:
    """A vector of the right size without missing or undefined elements."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")))
    return F.coalesce((F.size(vector) == dim) & ~broken, F.lit(False))


def is_finite(vector: Column) -> Column:
    """A vector without missing, undefined or infinite elements."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(broken, F.lit(True))


def as_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """List column to a float64 matrix; all lists must have the same size."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if rows == 0:
        return np.empty((0, 0))
    if column.null_count:
        raise ValueError("NULL vector: remove rejects first")
    widths = np.diff(column.offsets.to_numpy())
    if widths.min() != widths.max():
        raise ValueError(f"vectors differ in size: {widths.min()} to {widths.max()}")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(rows, -1)


def as_lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Matrix to a list column, without a Python object per element."""
    rows, width = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * width
    values = pa.array(np.ascontiguousarray(matrix).reshape(-1), type=kind)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def output_type(df: DataFrame, columns: dict[str, str]) -> T.StructType:
    """Schema of a task's output: a column of ``df`` by name, or a simple type name."""
    known = {field.name: field.dataType for field in df.schema}
    simple = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType()}
    return T.StructType(
        [T.StructField(name, known.get(kind) or simple[kind]) for name, kind in columns.items()]
    )


def typed_table(columns: dict, schema: T.StructType) -> pa.Table:
    """Arrow table with exactly the types that Spark expects of a task."""
    return pa.Table.from_pydict(
        {
            field.name: _column(columns[field.name], to_arrow_type(field.dataType))
            for field in schema
        }
    )


def _column(values, kind: pa.DataType) -> pa.Array | pa.ChunkedArray:
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        return values.cast(kind)
    return pa.array(values, type=kind)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return matrix / np.maximum(lengths, C.NORM_FLOOR)[:, None]
