import hashlib
import itertools
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.functions.sizes import SubsetSize, check_sizes, parse_sizes, to_size
from paperloom.functions.vectors import is_valid, l2_normalize
from paperloom.operators import selection as se
from paperloom.operators import similarity as si
from paperloom.operators.bounded import broadcast_if_small, vector_blocks
from paperloom.operators.folds import assign_folds
from paperloom.operators.ordering import range_positions, top_per_key
from paperloom.operators.splits import assign_splits, first_split

VECTORS = "dataset string, row_id long, embedding array<float>"


def vector_table(spark, matrix, dataset="d"):
    rows = [(dataset, i, [float(x) for x in v] if v is not None else None) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, VECTORS)


def random_vectors(n, dim=6, seed=0):
    return np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)


def test_normalize_and_validity(spark):
    df = vector_table(spark, [[3, 4], [0, 0], None, [1, float("nan")], [1, 2, 3]]).coalesce(1)
    unit = [r[0] for r in df.select(l2_normalize(F.col("embedding"))).collect()]
    assert unit[0] == pytest.approx([0.6, 0.8]) and unit[1] == [0.0, 0.0] and unit[2] is None
    assert [r[0] for r in df.select(is_valid(F.col("embedding"), 2)).collect()] == [True, True, False, False, False]


def test_sizes():
    assert [s.name for s in parse_sizes("0.1, 0.14,1.0,1,1000")] == [
        "percent_0.1",
        "percent_0.14",
        "percent_1.0",
        "samples_1",
        "samples_1000",
    ]
    for bad in (0.0, 1.5, 50.0, -1, 0, True, "x"):
        with pytest.raises(ValueError):
            to_size(bad)
    for bad in ([], (0.1,), [0.1, 0.1]):
        with pytest.raises(ValueError):
            check_sizes(bad)
    with pytest.raises(ValueError):
        SubsetSize()


def test_size_arithmetic(spark):
    totals = spark.createDataFrame([("a", 7), ("b", 0)], "dataset string, n long")
    got = {(r.dataset, r.size_spec): r.n_subset for r in se.subset_sizes(totals, [0.1, 0.5, 1.0, 3, 1000]).collect()}
    assert [got["a", s] for s in ("percent_0.1", "percent_0.5", "percent_1.0", "samples_3", "samples_1000")] == [1, 3, 7, 3, 7]
    folds = spark.createDataFrame([(0, 4, 7), (1, 3, 7)], "fold int, fold_size long, total long")
    budgets = {(r.fold, r.size_spec): r.budget for r in se.fold_budgets(folds, [0.3, 3, 1000]).collect()}
    assert budgets == {
        (0, "percent_0.3"): 2,
        (0, "samples_3"): 2,
        (0, "samples_1000"): 4,
        (1, "percent_0.3"): 1,
        (1, "samples_3"): 2,
        (1, "samples_1000"): 3,
    }
    advice = se.size_advice(spark.createDataFrame([(99_999,), (100_000,)], "n long"), 2.0)
    assert [tuple(r) for r in advice.orderBy("n").collect()] == [(99_999, True, True), (100_000, False, False)]


@pytest.mark.parametrize("n,k,most", [(0, 3, None), (1, 3, None), (7, 3, None), (10, 25, None), (6000, 1, None), (100, 4, 7), (10, 25, 10), (0, 3, 7), (1000, 50, 4096)])
def test_folds_are_even_and_hold_every_row(spark, n, k, most):
    df = spark.range(n).select(F.lit("d").alias("dataset"), F.col("id").alias("row_id"), F.rand(1).alias("x"))
    rows = assign_folds(df, num_folds=k, rows_per_fold=most).collect()
    assert sorted(r.row_id for r in rows) == list(range(n))
    counts = {}
    for r in rows:
        counts[r.fold] = counts.get(r.fold, 0) + 1
    expected = min(n, k if most is None else math.ceil(n / most))
    assert sorted(counts) == list(range(expected))
    assert all(counts[r.fold] == r.fold_size and r.total == n for r in rows)
    if counts:
        assert max(counts.values()) - min(counts.values()) <= 1 and max(counts.values()) <= (most or n)


def test_folds_of_several_datasets_follow_the_digest_order(spark):
    df = spark.range(300).select(
        F.when(F.col("id") < 200, "a").otherwise("b").alias("dataset"), F.col("id").alias("row_id")
    )
    usual = sorted(assign_folds(df, num_folds=6).collect())
    expected = {}
    for name, keys in (("a", range(200)), ("b", range(200, 300))):
        order = sorted(keys, key=lambda i: hashlib.md5(f"{i}-42".encode()).hexdigest())
        for fold, part in enumerate(np.array_split(order, 6)):
            expected |= {(name, int(i)): fold for i in part}
    assert {(r.dataset, r.row_id): r.fold for r in usual} == expected
    other_seed = sorted(assign_folds(df, num_folds=6, seed=7).collect())
    assert other_seed != usual
    plan = assign_folds(df, num_folds=6)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_fold_does_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.lit("d").alias("dataset"), F.col("id").alias("row_id"))
    assert sorted(assign_folds(df.repartition(1)).collect()) == sorted(assign_folds(df.repartition(13)).collect())


def test_positions_and_top(spark):
    values = [(g, (i * 7919) % 101, i) for g in "ab" for i in range(400)]
    df = spark.createDataFrame(values, "g string, v int, i int").repartition(7)
    placed = range_positions(df, [F.col("v").desc(), F.col("i")], ["g"]).collect()
    for g in "ab":
        order = [(r.v, r.i) for r in sorted((r for r in placed if r.g == g), key=lambda r: r.position)]
        assert order == sorted(order, key=lambda x: (-x[0], x[1]))
        assert sorted(r.position for r in placed if r.g == g) == list(range(400))
    top = top_per_key(df, ["g"], [F.col("v").desc(), F.col("i")], 5, F.col("i"), ways=8).collect()
    best = sorted(((v, i) for g, v, i in values if g == "a"), key=lambda x: (-x[0], x[1]))[:5]
    assert [(r.v, r.i) for r in sorted(top, key=lambda r: r["rank"]) if r.g == "a"] == best


@pytest.mark.parametrize("n", [0, 1, 5, 7])
def test_splits(spark, n):
    names = [f"f{i}.pdf" for i in range(n)]
    df = spark.createDataFrame([(x,) for x in names[::-1]], "name string")
    splits = assign_splits(df, 3)
    got = {}
    for r in sorted(splits.collect(), key=lambda r: (r.split_id, r.pos)):
        got.setdefault(r.split_id, []).append(r.name)
    assert got == {i: names[i::3] for i in range(3) if names[i::3]}
    assert [r.name for r in first_split(splits).orderBy("pos").collect()] == names[0::3]
    with pytest.raises(ValueError):
        assign_splits(df, 0)


def expected_similarity(a, b, metric):
    a, b = a.astype(float), b.astype(float)
    if metric == "cosine":
        a, b = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12) for m in (a, b))
    if metric in ("cosine", "dot"):
        return a @ b.T
    squares = ((a[:, None] - b[None]) ** 2).sum(-1)
    return 1 / (1 + squares) if metric == "euclidean" else np.exp(-squares / (0.1 * squares.mean()))


def scaled(s, scaling):
    if scaling == "additive":
        return (s + 1) / 2
    return (s - s.min()) / (s.max() - s.min()) if scaling == "min-max" else s


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean", "rbf"])
@pytest.mark.parametrize("scaling", [None, "min-max", "additive"])
def test_fold_profiles(spark, metric, scaling):
    matrix = random_vectors(20)
    matrix[3] = 0
    matrix[5] = matrix[4]
    folded = vector_table(spark, matrix).withColumn("fold", F.lit(0))
    rows = {r.row_id: r for r in si.fold_profiles(folded, metric, scaling).collect()}
    expected = scaled(expected_similarity(matrix, matrix, metric), scaling)
    for i, r in rows.items():
        assert (r.n, r.sim_sum) == (20, pytest.approx(expected[i].sum(), abs=1e-5))
        assert (r.sim_min, r.sim_max) == pytest.approx((expected[i].min(), expected[i].max()), abs=1e-5)
    if metric != "dot":
        assert rows[5].nearest == 4 and rows[4].nearest == 5


@pytest.mark.parametrize("metric,scaling", [("cosine", None), ("rbf", None), ("euclidean", "min-max"), ("rbf", "min-max")])
def test_reference_set(spark, small_batches, metric, scaling):
    matrix, refs = random_vectors(25), random_vectors(4, seed=9)
    references = spark.createDataFrame([(f"r{i}", v.tolist()) for i, v in enumerate(refs)], "ref_id string, embedding array<float>")
    rows = si.nearest_reference(vector_table(spark, matrix), references, metric, scaling).collect()
    expected = scaled(expected_similarity(matrix, refs, metric), scaling)
    for r in rows:
        assert r.sim_sum == pytest.approx(expected[r.row_id].sum(), abs=1e-5)
        assert r.nearest == f"r{expected[r.row_id].argmax()}"


def test_equal_points_and_single_row_folds(spark):
    same = vector_table(spark, [[1, 2]] * 3).withColumn("fold", F.lit(0))
    assert {r.sim_min for r in si.fold_profiles(same, "rbf").collect()} == {1.0}
    assert {r.sim_min for r in si.fold_profiles(same, "euclidean", "min-max").collect()} == {1.0}
    lone = si.fold_profiles(vector_table(spark, [[1, 2]]).withColumn("fold", F.lit(0))).first()
    assert (lone.n, lone.nearest, lone.nearest_sim) == (1, None, None)


def test_bad_metric_and_uneven_vectors(spark):
    folded = vector_table(spark, [[1, 2], [1, 2, 3]]).withColumn("fold", F.lit(0))
    with pytest.raises(ValueError, match="unknown metric"):
        si.fold_profiles(folded, "hamming")
    with pytest.raises(ValueError, match="unknown scaling"):
        si.fold_profiles(folded, "dot", "zscore")
    with pytest.raises(Exception, match="differ in size"):
        si.fold_profiles(folded).collect()


def test_bounded_tables(spark):
    df = vector_table(spark, random_vectors(10))
    for limits in ({"max_rows": 3}, {"max_bytes": 100}, {}):
        blocks = list(vector_blocks(df, "row_id", "embedding", **limits))
        assert sorted(k for keys, _ in blocks for k in keys) == list(range(10))
        assert (len(blocks) > 1) == bool(limits)
        assert all(len(keys) == len(matrix) for keys, matrix in blocks)
    (keys, matrix), = vector_blocks(df.filter("false"), "row_id", "embedding")
    assert keys == [] and len(matrix) == 0
    plan = lambda d: d._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(broadcast_if_small(df, F.lit(1), 10))
    assert "broadcast" not in plan(broadcast_if_small(df, F.lit(1), 9))


def test_reference_blocks_give_one_profile(spark):
    df, refs = vector_table(spark, random_vectors(12)), vector_table(spark, random_vectors(9))
    refs = refs.withColumnRenamed("row_id", "ref_id")
    for metric, scaling in (("cosine", None), ("rbf", None), ("dot", "min-max")):
        whole = si.nearest_reference(df, refs, metric, scaling).orderBy("row_id").collect()
        parts = si.nearest_reference(df, refs, metric, scaling, block_references=2).orderBy("row_id").collect()
        assert [r.nearest for r in whole] == [r.nearest for r in parts]
        for name in ("sim_min", "sim_max", "sim_sum"):
            assert [r[name] for r in whole] == pytest.approx([r[name] for r in parts])


def value_of(matrix, chosen):
    s = scaled(expected_similarity(matrix, matrix, "cosine"), "additive")
    return s[:, list(chosen)].max(axis=1).sum() if chosen else 0.0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000), st.integers(3, 8), st.integers(1, 3))
def test_greedy_is_near_the_optimum(spark, seed, n, k):
    matrix = random_vectors(n, 3, seed)
    picks = se.facility_location(vector_table(spark, matrix), [k], num_folds=1).orderBy("pick_no").collect()
    chosen, gains = [r.row_id for r in picks], [r.gain for r in picks]
    assert len(set(chosen)) == len(chosen) == min(k, n)
    assert gains == sorted(gains, reverse=True)
    assert sum(gains) == pytest.approx(value_of(matrix, chosen), abs=1e-4)
    optimum = max(value_of(matrix, c) for c in itertools.combinations(range(n), min(k, n)))
    assert sum(gains) >= (1 - 1 / math.e) * optimum - 1e-6


def test_lazy_greedy_equals_plain_greedy():
    matrix = np.round(scaled(expected_similarity(*[random_vectors(60, 4, 5)] * 2, "cosine"), "additive"), 7)
    picks, gains = se.exact_greedy(matrix, 60)
    cover, left = np.zeros(60), list(range(60))
    for pick, gain in zip(picks, gains):
        fresh = np.round(np.maximum(matrix[left] - cover, 0).sum(axis=1), 7)
        best = left[int(np.argmax(fresh))]
        assert (best, fresh.max()) == (pick, gain)
        cover = np.maximum(cover, matrix[best])
        left.remove(best)


def test_copies_are_picked_with_zero_gain_until_the_budget_is_full(spark):
    picks = se.facility_location(vector_table(spark, [[1, 0]] * 4 + [[0, 1]]), [5], num_folds=1)
    rows = picks.orderBy("pick_no").collect()
    assert [r.row_id for r in rows] == [0, 4, 1, 2, 3]
    assert [r.gain for r in rows][2:] == [0.0, 0.0, 0.0]


def test_several_sizes_merge_and_join(spark):
    matrix = random_vectors(100, 5, 3)
    df = vector_table(spark, matrix).withColumn("extra", F.col("row_id") * 2)
    sizes = [0.1, 25, 1.0]
    picks = se.facility_location(df, sizes, num_folds=7)
    all_picks = picks.collect()
    for size in (0, 1):
        for fold in range(7):
            smaller = {(r.pick_no, r.row_id) for r in all_picks if (r.size_no, r.fold) == (size, fold)}
            assert smaller <= {(r.pick_no, r.row_id) for r in all_picks if (r.size_no, r.fold) == (2, fold)}
    merged = se.merge_folds(picks, sizes)
    rows = se.subset_rows(df, merged, vector="embedding").collect()
    by_size = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        assert r.extra == 2 * r.row_id
        by_size.setdefault(r.size_spec, []).append(r)
    assert {k: len(v) for k, v in by_size.items()} == {"percent_0.1": 10, "samples_25": 25, "percent_1.0": 100}
    for found in by_size.values():
        assert [r["rank"] for r in found] == list(range(len(found)))
        assert [r.gain for r in found] == sorted((r.gain for r in found), reverse=True)


def test_coverage_is_the_sum_of_gains(spark):
    df = vector_table(spark, random_vectors(40, 5, 8))
    picks = se.facility_location(df, [6], num_folds=2)
    folded = assign_folds(df, num_folds=2)
    marked = folded.join(picks.select("row_id", F.lit("s").alias("member")), "row_id", "left")
    values = {r.fold: r.coverage for r in si.coverage(marked, "member").collect()}
    gains = {r.fold: r.g for r in picks.groupBy("fold").agg(F.sum("gain").alias("g")).collect()}
    assert values == pytest.approx(gains, abs=1e-4)


def test_stochastic_greedy(spark):
    df = vector_table(spark, random_vectors(60, 5, 2))
    run = lambda eps: sorted(se.facility_location(df, [0.2, 5], num_folds=3, epsilon=eps).collect())
    rows = run(0.1)
    assert rows == run(0.1)
    for fold in range(3):
        own = [r.row_id for r in rows if (r.fold, r.size_no) == (fold, 0)]
        assert len(own) == len(set(own)) == 4
    assert len(run(160.0)) == len(rows)
    assert se.sample_size(100, 10, 0.1) == 24 and se.sample_size(100, 10, 160.0) == 1
    for bad in (0, 161):
        with pytest.raises(ValueError):
            se.facility_location(df, [5], epsilon=bad)


def test_missing_vectors_are_left_out(spark):
    picks = se.facility_location(vector_table(spark, [[1, 0], None, [0, 1]]), [1.0], num_folds=1)
    assert sorted(r.row_id for r in picks.collect()) == [0, 2]


def test_repeated_keys_are_refused(spark):
    df = vector_table(spark, random_vectors(20)).withColumn("row_id", F.col("row_id") % 10)
    with pytest.raises(Exception, match="repeats values"):
        se.facility_location(df, [0.5], num_folds=4).collect()
