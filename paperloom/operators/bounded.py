"""Side tables that are shipped to every task: after a check of their size, or in blocks of one."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.functions.vectors import as_matrix
from paperloom.session import materialized, scratch_path


def broadcast_if_small(df: DataFrame, weight: Column, limit: int) -> DataFrame:
    """Add a broadcast hint when the summed ``weight`` of the rows is at most ``limit``.

    Give a table that is cheap to read twice, such as a stored one. Beyond the
    limit the table comes back as it is and Spark joins by shuffle.
    """
    total = df.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("total")).first()["total"]
    return F.broadcast(df) if total <= limit else df


class VectorBlocks:
    """A vector table in blocks of keys and matrix, at least one; a round of blocks is read when it is its turn.

    The table is stored once, in a folder for each block, so that a block is read without the others. Its keys are
    unique, so that their hashes deal blocks of about the given size.
    """

    def __init__(
        self, df: DataFrame, key: str, vector: str, max_rows: int = C.BLOCK_VECTORS, max_bytes: int = C.BLOCK_BYTES
    ) -> None:
        self.key = key
        stored = materialized(df.select(key, vector).filter(F.col(vector).isNotNull()), "vectors")
        size = stored.agg(F.count("*").alias("rows"), F.max(F.size(vector)).alias("dim")).first()
        fit = max(1, min(max_rows, max_bytes // (8 * max(1, size["dim"] or 0))))
        self.count = max(1, -(-size["rows"] // fit))
        self._dealt = stored.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(self.count)))
        if self.count > 1:
            path, schema = scratch_path(df.sparkSession, "blocks"), self._dealt.schema
            self._dealt.repartition("_block").write.partitionBy("_block").parquet(path)
            self._dealt = df.sparkSession.read.schema(schema).parquet(path)

    def __iter__(self) -> Iterator[tuple[list, np.ndarray]]:
        for start in range(0, self.count, C.ROUND_BLOCKS):
            numbers = range(start, min(self.count, start + C.ROUND_BLOCKS))
            whole = self._dealt.filter(F.col("_block").isin(list(numbers))).toArrow()
            for number in numbers:
                table = whole.filter(pc.equal(whole.column("_block"), number)).sort_by(self.key)
                yield table.column(0).to_pylist(), as_matrix(table.column(1))


def vector_blocks(
    df: DataFrame,
    key: str,
    vector: str,
    max_rows: int = C.BLOCK_VECTORS,
    max_bytes: int = C.BLOCK_BYTES,
) -> Iterator[tuple[list, np.ndarray]]:
    """Keys and matrix of a vector table, block after block, at least one block."""
    yield from VectorBlocks(df, key, vector, max_rows, max_bytes)


def in_rounds(
    spark: SparkSession,
    blocks: VectorBlocks,
    run: Callable[[Broadcast], DataFrame],
    label: str,
    finish: Callable[[DataFrame], DataFrame] = lambda found: found,
) -> DataFrame:
    """What ``run`` makes of every block; ``finish`` is applied to the union of a round of blocks.

    A round has a fixed number of blocks. Where one round is not enough, the result of each is appended to a stored table and its
    broadcasts are destroyed before the next, so that plan size and memory of driver and executors do not
    depend on the number of blocks.
    """

    def one_round(part: Iterator) -> tuple[list[Broadcast], DataFrame]:
        shared = [spark.sparkContext.broadcast(block) for block in part]
        return shared, finish(reduce(DataFrame.unionByName, map(run, shared)))

    blocks_left = iter(blocks)
    rounds = -(-blocks.count // C.ROUND_BLOCKS)
    if rounds == 1:
        return one_round(blocks_left)[1]
    path = scratch_path(spark, label)
    for _ in range(rounds):
        shared, result = one_round(islice(blocks_left, C.ROUND_BLOCKS))
        result.write.mode("append").parquet(path)
        for each in shared:
            each.destroy()
    return spark.read.schema(result.schema).parquet(path)
