"""Connected groups of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import materialized, release


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Hang neighbours on the least of a node's neighbourhood: those above the node, or those up to it."""
    sides = links if not larger else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    joined = sides.join(least, "a")
    if larger:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    hung = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.unionByName(least.where("a <> least").select("a", F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); the component is its least id.

    Links of a node with itself or with null are left out. Each round makes the stars flatter
    until they no longer change; minima are combined before the shuffle, so that a node with any number of links is
    no single task's work. Rounds are written to the shared folder.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialized(links, "links")
    seen = None
    while True:
        before, links = links, materialized(_stars(_stars(links, True).distinct(), False).distinct(), "stars")
        release(before)
        sign = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == seen:
            break
        seen = sign
    tops = links.select(F.col("b").alias("id")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(tops.select("id", F.col("id").alias("component")))
