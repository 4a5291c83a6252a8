"""Reproducible shards: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import materialized

ROUNDS = 6
#: A row needs more walks than are made with a chance of 2 to minus this; the query would then stop with an error.
WALK_BITS = 128


def feistel(value: Column, side: int, seed: int) -> Column:
    """A permutation of 0 .. side*side-1: rounds on the two digits of ``value`` to base ``side``."""
    left, right = F.floor(value / side).cast("long"), F.pmod(value, F.lit(side))
    pair = F.struct(left.alias("l"), right.alias("r"))
    for number in range(ROUNDS):
        # A one-element transform computes the halves of each round once.
        pair = F.transform(F.array(pair), _round(side, seed * ROUNDS + number))[0]
    return F.transform(F.array(pair), lambda p: p["l"] * side + p["r"])[0]


def _round(side: int, key: int):
    def step(pair: Column) -> Column:
        scrambled = F.pmod(F.xxhash64(pair["r"], F.lit(key)), F.lit(side))
        return F.struct(pair["r"].alias("l"), F.pmod(pair["l"] + scrambled, F.lit(side)).alias("r"))

    return step


def permuted(number: Column, rows: int, seed: int) -> Column:
    """The place of a row number after the shuffle of 0 .. rows-1.

    The domain is the smallest square that holds all rows; a place beyond the last row is
    permuted again until it is a row. A walk never takes more steps than the domain has places beyond the rows, and
    goes on with the share of those in the domain as its chance.
    """
    side = max(math.isqrt(max(rows - 1, 0)) + 1, 1)
    beyond = side * side - rows
    if beyond <= 0 or rows <= 0:
        return feistel(number, side, seed)
    steps = min(beyond, math.ceil(WALK_BITS / math.log2(side * side / beyond)))
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        feistel(number, side, seed),
        lambda place, _: F.when(place < rows, place).otherwise(feistel(place, side, seed)),
    )
    return F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("a cycle walk did not end")).cast("long"))


def row_numbers(rows: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """Numbers from 0 in the order of a hash of ``keys``, which also names the row's range.

    ``rows`` has one row per distinct key with its ``copies``. Ranges are the leading bits
    of the hash: their number changes the size of a task and never the result.
    """
    order = F.xxhash64(*keys)
    ranged = rows.withColumn("_hash", order).withColumn("_range", F.shiftrightunsigned("_hash", 64 - bits))
    totals = ranged.groupBy("_range").agg(F.sum("copies").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_range").orderBy("_hash", *keys).rowsBetween(Window.unboundedPreceding, -1)
    numbered = ranged.withColumn("_first", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    return (
        numbered.join(totals, "_range")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("row_number", F.col("_base") + F.col("_first") + F.col("_copy"))
        .drop("_hash", "_range", "_rows", "_base", "_first", "_copy", "copies")
    )


def shard_rows(docs: DataFrame, shards: int, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard and slot of every row, under the law ``rows``: counts differ by one at most.

    Rows are numbered in the order of a hash of key and text, the numbers are shuffled by
    the permutation, and place p is slot ``p / shards`` of shard ``p % shards``. So a row's
    place can be computed from its number, the row count and the seed alone. The text does not
    move; rows that are equal in key and text are one row with a count until they are numbered.

    A null text has size 16 and the crc of the empty text; null keys are rows like others;
    equal rows get different slots. An empty table gives no rows; other columns are ignored.
    """
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("_key"), size.alias("size"), F.crc32(content).alias("text_crc32"), F.xxhash64(text).alias("_text"))
    rows = materialized(rows.groupBy("_key", "size", "text_crc32", "_text").agg(F.count("*").alias("copies")), "rows")
    total = rows.agg(F.sum("copies")).first()[0] or 0
    bits = min(24, max(10, math.ceil(math.log2(max(total, 1) / 50_000 + 1))))
    place = permuted(F.col("row_number"), total, seed)
    placed = row_numbers(rows, ["_key", "_text", "text_crc32", "size"], bits).withColumn("_place", place)
    return placed.select(
        F.col("_key").alias(key),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod("_place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("_place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
