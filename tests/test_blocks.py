"""Work that is done in blocks gives what one piece would: folds, query rounds, cells, packed chunks."""

import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.operators import chunking, search
from paperloom.operators import embedding as emb
from paperloom.operators import selection as se
from paperloom.operators import similarity as si
from paperloom.session import materialized


def vectors_of(spark, matrix, name="row_id"):
    rows = [("d", i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"dataset string, {name} long, embedding array<float>")


def points(n, dim=5, seed=0):
    return np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32).astype(np.float64)


def plain_greedy(matrix, budget):
    """All gains of all rows in every step, in whole units."""
    unit = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    values = np.rint((unit @ unit.T + 1) / 2 * 10**7).astype(np.int64)
    cover, left, picks, gains = np.zeros(len(matrix), np.int64), list(range(len(matrix))), [], []
    for _ in range(budget):
        fresh = np.maximum(values[left] - cover, 0).sum(axis=1)
        best = int(np.argmax(fresh))
        picks.append(left[best])
        gains.append(fresh[best] / 10**7)
        cover = np.maximum(cover, values[left.pop(best)])
    return picks, gains


@pytest.mark.parametrize("kept,block", [(0, 1), (0, 700), (300, 50), (10**7, 10**6)])
def test_greedy_without_the_square_matrix(monkeypatch, kept, block):
    monkeypatch.setattr(se, "_KEPT_CELLS", kept)
    monkeypatch.setattr(se, "_BLOCK_CELLS", block)
    matrix = np.vstack([points(70), points(10), np.zeros((2, 5))])
    fold = se._Fold(matrix)
    assert se.exact_greedy(fold, 60) == plain_greedy(matrix, 60)
    assert len(fold._kept) <= kept // len(matrix)


def test_first_bounds_are_never_too_low():
    for seed in range(20):
        fold = se._Fold(points(200, 3, seed))
        assert (fold.bounds() >= fold.gains(np.arange(200))).all()


def test_memory_of_a_fold_grows_with_its_rows(monkeypatch):
    monkeypatch.setattr(se, "_KEPT_CELLS", 8_000)
    monkeypatch.setattr(se, "_BLOCK_CELLS", 8_000)
    asked = []
    fold = se._Fold(points(4_000, 4))
    look = fold._similar
    monkeypatch.setattr(fold, "_similar", lambda rows: asked.append(len(rows)) or look(rows))
    picks, gains = se.exact_greedy(fold, 3)
    assert gains == sorted(gains, reverse=True) and len(set(picks)) == 3
    assert max(asked) <= 2 and len(fold._kept) <= 2
    # The second step looks at about every row, whose bound is from before the first pick; later ones at few.
    assert sum(asked) < 3 * 4_000


def test_folds_that_are_too_large_are_refused(spark):
    df = vectors_of(spark, points(30))
    with pytest.raises(Exception, match="max_fold_rows"):
        se.facility_location(df, [2], num_folds=2, max_fold_rows=14).collect()
    assert se.facility_location(df, [2], rows_per_fold=14, max_fold_rows=14).count() > 0


def test_repeated_and_null_keys(spark):
    df = vectors_of(spark, points(6))
    nulls = df.withColumn("row_id", F.when(F.col("row_id") > 0, F.col("row_id")))
    assert se.facility_location(nulls, [6], num_folds=2).count() == 6
    twice = df.withColumn("row_id", F.when(F.col("row_id") > 1, F.col("row_id")))
    with pytest.raises(Exception, match="repeats values"):
        se.facility_location(twice, [6], num_folds=2).collect()


def test_datasets_without_vectors_are_named(spark):
    rows = [("full", 1, [1.0, 0.0]), ("full", 2, None), ("empty", 1, None), ("empty", 2, [float("nan"), 0.0])]
    df = spark.createDataFrame(rows, "dataset string, row_id long, embedding array<float>")
    assert [tuple(r) for r in se.skipped_datasets(df).collect()] == [("empty", 2)]
    assert {r.dataset for r in se.facility_location(df, [1.0], num_folds=1).collect()} == {"full"}


def test_sampled_greedy_equals_a_plain_version():
    matrix, codes = points(60, 4, 3), np.random.default_rng(5).integers(0, C.SAMPLE_PRIME, 60)
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    values = np.rint((unit @ unit.T + 1) / 2 * 10**7).astype(np.int64)
    for epsilon, budget in ((0.1, 10), (0.9, 30), (160.0, 5), (0.0001, 12)):
        picks, gains = se.stochastic_greedy(se._Fold(matrix), codes, budget, epsilon, (42, 3, 0))
        cover, left, wanted = np.zeros(60, np.int64), list(range(60)), max(1, math.ceil(60 / budget * math.log(1 / epsilon)))
        for step in range(budget):
            factor, shift = se._line(42, 3, 0, step)
            drawn = sorted(left, key=lambda r: ((int(codes[r]) * factor + shift) % C.SAMPLE_PRIME, r))[:wanted]
            fresh = {r: int(np.maximum(values[r] - cover, 0).sum()) for r in drawn}
            best = min(drawn, key=lambda r: (-fresh[r], r))
            assert (picks[step], gains[step]) == (best, fresh[best] / 10**7)
            cover = np.maximum(cover, values[best])
            left.remove(best)


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean", "rbf"])
@pytest.mark.parametrize("scaling", [None, "min-max", "additive"])
def test_profiles_of_folds_in_blocks(spark, monkeypatch, metric, scaling):
    matrix = points(33)
    matrix[7] = matrix[3]
    whole = si.row_profiles(np.arange(33), si.FoldSimilarity(matrix, metric, scaling))
    monkeypatch.setattr(si, "_BLOCK_CELLS", 100)
    parts = si.FoldSimilarity(matrix, metric, scaling)
    assert [len(v) for _, v in parts.blocks()] == [3] * 11
    found = si.row_profiles(np.arange(33), parts)
    assert found["nearest"].tolist() == whole["nearest"].tolist()
    for name in ("sim_min", "sim_max", "sim_sum", "nearest_sim"):
        assert found[name] == pytest.approx(whole[name], abs=1e-9)


def test_two_hundred_blocks_of_queries(spark, monkeypatch):
    """Rounds are stored, their broadcasts dropped: the plan is one scan of the hits."""
    monkeypatch.setattr(C, "ROUND_BLOCKS", 50)
    corpus, queries = points(40, 3, 1), points(200, 3, 2)
    rows, asked = materialized(vectors_of(spark, corpus).coalesce(1)), vectors_of(spark, queries, "query_id")
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        hits = search.topk_search(rows, asked, 2, block_queries=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and "Union" not in plan
    few = search.topk_search(rows, asked, 2)
    assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, few.collect()))


def test_rounds_of_references(spark, monkeypatch):
    df, refs = vectors_of(spark, points(12)), vectors_of(spark, points(9, 5, 4), "ref_id")
    for metric, scaling in (("cosine", None), ("rbf", "min-max")):
        whole = si.nearest_reference(df, refs, metric, scaling).orderBy("row_id").collect()
        with monkeypatch.context() as few:
            few.setattr(C, "ROUND_BLOCKS", 2)
            parts = si.nearest_reference(df, refs, metric, scaling, block_references=2).orderBy("row_id")
            assert "Union" not in parts._jdf.queryExecution().optimizedPlan().toString()
            parts = parts.collect()
        assert [r.nearest for r in whole] == [r.nearest for r in parts]
        for name in ("sim_min", "sim_max", "sim_sum"):
            assert [r[name] for r in whole] == pytest.approx([r[name] for r in parts])


def test_hot_cells_are_many_groups(spark):
    """Nearly all rows and queries in one cell: groups of a few rows and queries give the same hits in one plan."""
    rng = np.random.default_rng(3)
    corpus = np.vstack([[1, 0, 0] + rng.normal(size=(90, 3)) * 0.1, [-1, 0, 0] + rng.normal(size=(5, 3)) * 0.1])
    queries = [1, 0, 0] + rng.normal(size=(20, 3)) * 0.1
    index = search.CellIndex(np.array([[1.0, 0, 0], [-1.0, 0, 0], [0, 0, 1.0]]))
    rows, asked = index.assign(vectors_of(spark, corpus)), vectors_of(spark, queries, "query_id")
    whole = search.cell_search(rows, index, asked, 4, probes=2)
    parts = search.cell_search(rows, index, asked, 4, probes=2, block_queries=3, block_rows=7)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, search.topk_search(rows, asked, 4).collect()))
    plan = parts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CoGroup") == 1 and "Union" not in plan
    assert search.cell_search(rows, index, asked.filter("false"), 4).count() == 0
    assert search.cell_search(rows.filter("false"), index, asked, 4).count() == 0
    for bad in ({"k": 0}, {"probes": 0}):
        with pytest.raises(ValueError):
            search.cell_search(rows, index, asked, **bad)


def plain_chunks(levels, sizes, limit, merge):
    """Item by item."""
    chunks, path, room, budget = [], [], 0, max(1, limit)
    for item, (level, size) in enumerate(zip(levels, sizes)):
        if level > 0:
            path = [h for h in path if levels[h] < level] + [item]
            budget, room = max(1, limit - sum(sizes[h] for h in path)), 0
        if level == 0:
            for start in range(0, size, budget):
                span = {"item": item, "start": start, "size": min(budget, size - start)}
                if not (merge and span["size"] <= room):
                    chunks.append({"spans": [], "headings": path})
                    room = budget
                chunks[-1]["spans"].append(span)
                room -= span["size"]
    return chunks


DOCUMENT = st.tuples(st.lists(st.tuples(st.integers(-1, 4), st.integers(0, 12)), max_size=14), st.integers(1, 15), st.booleans())


@settings(max_examples=200, deadline=None)
@given(st.lists(DOCUMENT, max_size=6))
def test_packing_equals_item_by_item(documents):
    levels = pa.array([[x[0] for x in items] for items, _, _ in documents], pa.list_(pa.int32()))
    sizes = pa.array([[x[1] for x in items] for items, _, _ in documents], pa.list_(pa.int32()))
    limits, merge = np.array([x[1] for x in documents], np.int64), np.array([x[2] for x in documents], bool)
    expected = [plain_chunks([x[0] for x in items], [x[1] for x in items], limit, m) for items, limit, m in documents]
    found = chunking.pack(levels, sizes, limits, merge)
    assert found.type == pa.list_(chunking._CHUNK) and found.to_pylist() == expected
    assert chunking.pack(levels[1:], sizes[1:], limits[1:], merge[1:]).to_pylist() == expected[1:]


def test_packing_of_a_long_document():
    rng = np.random.default_rng(8)
    level = rng.choice([0] * 50 + [1, 2, 3, -1], 5_000).tolist()
    size = [s % 20 if lv > 0 else s for lv, s in zip(level, rng.integers(0, 400, 5_000).tolist())]
    found = chunking.pack(pa.array([level], pa.list_(pa.int32())), pa.array([size], pa.list_(pa.int32())), np.array([100]), np.array([True]))
    assert found.to_pylist() == [plain_chunks(level, size, 100, True)]


def test_exact_greedy_compares_few_rows_with_all(monkeypatch):
    monkeypatch.setattr(se, "_KEPT_CELLS", 8_000)
    matrix = points(800, 6, 2)
    matrix[400:420] = matrix[:20]
    fold, asked = se._Fold(matrix), []
    look = fold._similar
    monkeypatch.setattr(fold, "_similar", lambda rows: asked.extend(rows) or look(rows))
    picks, gains = se.exact_greedy(fold, 200)
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    values = np.rint((unit @ unit.T + 1) / 2 * 10**7).astype(np.int64)
    cover, left = np.zeros(800, np.int64), np.ones(800, bool)
    for pick, gain in zip(picks, gains):
        fresh = np.where(left, np.maximum(values - cover, 0).sum(axis=1), -1)
        assert (pick, gain) == (int(np.argmax(fresh)), fresh.max() / 10**7)
        cover, left[pick] = np.maximum(cover, values[pick]), False
    # Steps used to look at some twenty rows each, against the whole fold.
    assert len(asked) <= 200
    assert (fold.cover == cover).all() and fold._sparse


def test_sampled_sizes_of_a_fold_are_tasks_of_their_own(spark):
    df = vectors_of(spark, points(40))
    sampled = se.facility_location(df, [0.1, 0.5], num_folds=2, epsilon=0.1)
    assert sampled.groupBy("size_no", "fold").count().count() == 4
    grouped = [x for x in sampled._jdf.queryExecution().analyzed().toString().splitlines() if "FlatMapGroupsInArrow" in x]
    assert grouped and all("_size#" in x for x in grouped)


def test_sums_of_a_batch_take_memory_by_slice(monkeypatch):
    rng = np.random.default_rng(4)
    lists = [rng.integers(0, 512, n).astype(np.int16) for n in (0, 3_000, 5, 700, 0, 2_000) for _ in range(40)]
    codes = pa.array([x.tolist() for x in lists], pa.list_(pa.int16()))
    plain = np.array([np.bincount(x // 2, weights=1 - 2.0 * (x % 2), minlength=256) for x in lists])
    plain /= np.maximum(np.linalg.norm(plain, axis=1, keepdims=True), C.NORM_FLOOR)
    monkeypatch.setattr(emb, "_SLICE_WORDS", 4_000)
    tracemalloc.start()
    found = emb.signed_sums(codes, 256)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(found, plain, atol=1e-6)
    assert np.allclose(emb.signed_sums(codes.slice(41, 60), 256), plain[41:101], atol=1e-6)
    # The words took 8 bytes each, and several arrays of 8 bytes a word beside that.
    assert peak < 8 * sum(map(len, lists))
