"""Positions in a global order, without moving all rows to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import materialized


def shuffle_hash(key: str, seed: int) -> Column:
    """Seeded, engine-independent shuffle order of a key; a null key counts as empty text."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"-{seed}")))


def range_positions(
    df: DataFrame, order: Sequence[Column], groups: Sequence[str] = (), output: str = "position"
) -> DataFrame:
    """Number the rows of every group from 0 in the given order, which must be total.

    Rows are split by value range over ``groups`` and ``order`` together, so a group
    of any size is spread over tasks. The split is sampled, hence it is stored
    before it is used twice: for the row counts per range (one small row each) and
    for the positions inside the ranges.
    """
    ranged = df.repartitionByRange(*[F.col(g) for g in groups], *order).withColumn(
        "_range", F.spark_partition_id()
    )
    stable = materialized(ranged)
    counts = stable.groupBy(*groups, "_range").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        *groups, "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(*groups, "_range").orderBy(*order)
    return (
        stable.join(offsets, [*groups, "_range"])
        .withColumn(output, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_range", "_offset")
    )


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, spread: Column, ways: int = 64
) -> DataFrame:
    """The first ``k`` rows of every key, with their rank from 1.

    Rows of a key meet in two rounds, first by a salt of ``spread``, so that no task
    ranks all candidates of one key.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(ways)))
    first = Window.partitionBy(*keys, "_salt").orderBy(*order)
    survivors = salted.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        survivors.drop("_salt")
        .withColumn("rank", F.row_number().over(final))
        .filter(F.col("rank") <= k)
    )
