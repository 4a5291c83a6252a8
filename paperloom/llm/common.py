"""Shared by the operators: text chunks inside tasks, rolling hashes, staged tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import paperloom
from paperloom.session import materialized, release, scratch_path, staging

__all__ = ["CHUNK_BYTES", "hash_powers", "held_out", "materialized", "mix", "rank_key", "release", "scratch_path", "staging", "table", "text_chunks", "utf8"]

# Tasks get the functions with the query, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(paperloom)

CHUNK_BYTES = 2 << 20
_STEP = 0x9E3779B97F4A7C15
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(key: Column) -> Column:
    """Rows kept from training: crc32 of the key as text leaves 2 by 4. A null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each begins; null is empty."""
    if array.null_count:
        array = pc.fill_null(array, "")
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_chunks(batches, column: str, limit: int = CHUNK_BYTES):
    """Slices of the batches with about ``limit`` text bytes, never less than a row."""
    for batch in batches:
        _, offsets = utf8(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xA0761D6478BD642F)
    return values ^ (values >> np.uint64(32))


def hash_powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd step modulo 2**64, and those of its inverse.

    With sums ``s`` of ``value[i] * power[i]``, ``(s[j] - s[i]) * inverse[i]`` is the same
    number wherever the values of a span stand.
    """
    up = np.full(count, _STEP, np.uint64)
    down = np.full(count, _STEP_INVERSE, np.uint64)
    up[:1] = down[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(up), np.cumprod(down)


def rank_key(*columns: Column) -> Column:
    """A reproducible 64-bit order of rows."""
    return F.xxhash64(*columns)
