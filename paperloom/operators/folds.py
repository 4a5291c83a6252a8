"""Shuffled folds of nearly equal size.

The shuffle order is a digest of the row key, so rows spread evenly over digest
buckets. Bucket counts give every bucket its place in the order, and a row's place
in its bucket gives its fold. Work grows with the rows alone, and the largest unit
of work is a bucket: a millionth of a dataset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.operators.ordering import shuffle_hash

# 16 ** 5 buckets a dataset.
_BUCKET_DIGITS = 5


def fold_count(total: Column, num_folds: int, rows_per_fold: int | None = None) -> Column:
    """Folds as asked, or as many as ``rows_per_fold`` takes where it is given; never more than rows."""
    asked = F.lit(num_folds) if rows_per_fold is None else F.ceil(total / F.lit(rows_per_fold))
    return F.least(total, asked.cast("long"))


def fold_at(position: Column, total: Column, folds: Column) -> Column:
    """Fold of a position when the first ``total mod folds`` folds get one extra row."""
    base = F.floor(total / folds)
    extra = total % folds
    large = extra * (base + 1)
    return (
        F.when(position < large, F.floor(position / (base + 1)))
        .otherwise(extra + F.floor((position - large) / base))
        .cast("int")
    )


def fold_rows(fold: Column, total: Column, folds: Column) -> Column:
    """Number of rows of a fold."""
    return (F.floor(total / folds) + F.when(fold < total % folds, 1).otherwise(0)).cast("long")


def assign_folds(
    df: DataFrame,
    key: str = "row_id",
    num_folds: int = C.DEFAULT_FOLDS,
    rows_per_fold: int | None = None,
    seed: int = C.DEFAULT_SEED,
    groups: Sequence[str] = ("dataset",),
) -> DataFrame:
    """Add ``fold``, ``fold_size`` and ``total`` to every row; ``key`` is unique in its group.

    There are ``num_folds`` folds, or, where ``rows_per_fold`` is given, as many as keep
    every fold within that number of rows. The table is read twice: its keys for the
    counts, and whole, moving once to its buckets. A key that occurs twice in a group, null
    included, is an error: its rows could be in two folds.
    """
    if num_folds < 1 or (rows_per_fold is not None and rows_per_fold < 1):
        raise ValueError("at least one fold and one row per fold are needed")
    digest = shuffle_hash(key, seed)
    bucket = F.substring("_digest", 1, _BUCKET_DIGITS)

    group = Window.partitionBy(*groups)
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        df.select(*groups, digest.alias("_digest"))
        .groupBy(*groups, bucket.alias("_bucket"))
        .agg(F.count("*").alias("_rows"))
        .select(
            *groups,
            "_bucket",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
            F.sum("_rows").over(group).alias("total"),
        )
        .withColumn("_folds", fold_count(F.col("total"), num_folds, rows_per_fold))
    )
    inside = Window.partitionBy(*groups, "_bucket").orderBy("_digest", key)
    # Equal keys have equal digests, so they follow each other in a bucket.
    repeated = (F.row_number().over(inside) > 1) & F.lag(key).over(inside).eqNullSafe(F.col(key))
    message = F.concat(F.lit(f"column {key} repeats values within a dataset: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    place = F.col("_start") + F.row_number().over(inside) - 1
    position = F.when(repeated, F.raise_error(message).cast("long")).otherwise(place)
    return (
        df.withColumn("_digest", digest)
        .withColumn("_bucket", bucket)
        .join(buckets, [*groups, "_bucket"])
        .withColumn("_at", position)
        .withColumn("fold", fold_at(F.col("_at"), F.col("total"), F.col("_folds")))
        .withColumn("fold_size", fold_rows(F.col("fold"), F.col("total"), F.col("_folds")))
        .select(*df.columns, "fold", "fold_size", "total")
    )
