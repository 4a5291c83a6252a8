"""Striped splits of a list of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.ordering import range_positions


def assign_splits(names: DataFrame, num_splits: int, name: str = "name") -> DataFrame:
    """Deal names in name order over ``num_splits`` splits; position inside a split is kept.

    With fewer names than splits the empty splits simply do not occur. Rows of one name go by their other columns;
    a name that occurs very often is spread over tasks, equal rows by where they are read.
    """
    if num_splits < 1:
        raise ValueError("at least one split is needed")
    marked = names.withColumn("_row", F.xxhash64(*names.columns)).withColumn("_read", F.monotonically_increasing_id())
    placed = range_positions(marked, [F.col(name), F.col("_row"), F.col("_read")])
    return placed.select(
        F.pmod("position", F.lit(num_splits)).cast("int").alias("split_id"),
        F.floor(F.col("position") / F.lit(num_splits)).cast("long").alias("pos"),
        *names.columns,
    )


def first_split(splits: DataFrame) -> DataFrame:
    """Only the first split, as in a local trial run."""
    return splits.filter(F.col("split_id") == 0)
