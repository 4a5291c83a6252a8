"""Sharding beside a plain Feistel network over the same row numbers, and the pipeline on awkward tables."""

import math
import struct

import pytest
import xxhash

import corpus_pipeline
from paperloom.llm import sharding

ROWS = [(i, f"text {i % 40}" if i % 9 else None) for i in range(300)] + [(7, "text 7")] * 3 + [(None, "no id"), (None, "no id")]


def plain_place(number, rows, seed):
    side = math.isqrt(rows - 1) + 1
    while True:
        left, right = divmod(number, side)
        for step in range(sharding.ROUNDS):
            first = xxhash.xxh64_intdigest(struct.pack("<q", right), seed=42)
            mixed = struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(struct.pack("<i", seed * sharding.ROUNDS + step), seed=first)))[0]
            left, right = right, (left + mixed % side) % side
        number = left * side + right
        if number < rows:
            return number


@pytest.mark.parametrize("shards,seed", [(40, 0), (7, 3)])
def test_shards_equal_a_plain_feistel_network(spark, shards, seed):
    found = sharding.shard_rows(spark.createDataFrame(ROWS, "doc_id long, text string"), shards, seed).collect()
    assert sorted(r["row_number"] for r in found) == list(range(len(ROWS)))
    for r in found:
        place = plain_place(r["row_number"], len(ROWS), seed)
        assert (r["shard"], r["slot"]) == (place % shards, place // shards)


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 17, 82, 1025])
def test_walks_always_end(spark, rows):
    places = [r[0] for r in spark.range(rows).select(sharding.permuted(sharding.F.col("id"), rows, 9)).collect()]
    assert places == [plain_place(i, rows, 9) for i in range(rows)]


def test_pipeline_stages_on_empty_and_awkward_tables(spark, tmp_path):
    prose = "the quick brown fox jumps over the lazy dog and runs into the dark green forest again "
    rows = [(1, prose * 3, "en"), (1, prose * 3, "en"), (None, prose * 2, "en"), (2, None, "en"), (3, "", None), (4, " \n", "xx"), (5, "12 34", None), (6, prose * 400, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'s' AS source", "CAST(length(text) AS long) AS n_chars")
    spark.createDataFrame([("i1", "something else entirely that no document holds at all, ever")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table in (docs, docs.limit(0)):
        kept = table
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            kept = stage(spark, kept, str(tmp_path))
            if number < len(corpus_pipeline.STAGES) - 1:
                assert set(kept.columns) == set(docs.columns)
            path = f"{tmp_path}/{'full' if table is docs else 'none'}{number}"
            kept.write.parquet(path)
            kept = spark.read.parquet(path)
        ids = [r["doc_id"] for r in kept.collect()]
        assert ids == [] if table is not docs else set(ids) <= {1, None, 6} and 1 in ids
