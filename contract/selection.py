"""Folds, sizes and diverse subsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import query, table
from contract.similarity import FOLDS, folded
from contract.sql import folds, greedy, sampled_greedy
from paperloom.operators import selection as se
from paperloom.functions.sizes import parse_sizes
from paperloom.operators.folds import assign_folds
from paperloom.operators.ordering import range_positions
from paperloom.operators.similarity import coverage
from paperloom.session import scratch_path
from paperloom.sources.datasets import concat_datasets
from paperloom.sources.stores import read_selection, write_selection

SIZES = [0.1, 0.25, 20]
RESOLVED_SIZES = [0.1, 0.25, 1.0, 1, 1000]


def _totals(spark: SparkSession, folder: str) -> DataFrame:
    names = ("documents", "pages", "embeddings", "conversations", "events")
    rows = [table(spark, folder, n).select(F.lit(n).alias("dataset")) for n in names]
    return concat_datasets(rows).groupBy("dataset").agg(F.count("*").alias("n"))


_TOTALS = """
totals AS (
  SELECT 'documents' AS dataset, count(*) AS n FROM documents
  UNION ALL SELECT 'pages', count(*) FROM pages
  UNION ALL SELECT 'embeddings', count(*) FROM embeddings
  UNION ALL SELECT 'conversations', count(*) FROM conversations
  UNION ALL SELECT 'events', count(*) FROM events)"""


@query(
    "subset_sizes",
    f"""WITH {_TOTALS}, shares(size_spec, share) AS (
      VALUES ('percent_0.1', 0.1::DOUBLE), ('percent_0.25', 0.25::DOUBLE), ('percent_1.0', 1.0::DOUBLE)),
    counts(size_spec, k) AS (VALUES ('samples_1', 1), ('samples_1000', 1000))
    SELECT dataset, n, size_spec, greatest(1, floor(share * n))::BIGINT AS n_subset FROM totals, shares
    UNION ALL SELECT dataset, n, size_spec, least(k, n)::BIGINT FROM totals, counts""",
)
def subset_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return se.subset_sizes(_totals(spark, folder), RESOLVED_SIZES)


@query(
    "size_list",
    f"""WITH {_TOTALS}
    SELECT dataset, n, 'percent_0.5' AS size_spec, greatest(1, floor(0.5::DOUBLE * n))::BIGINT AS n_subset FROM totals
    UNION ALL SELECT dataset, n, 'samples_25', least(25, n)::BIGINT FROM totals""",
)
def size_list(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes as a command line gives them."""
    return se.subset_sizes(_totals(spark, folder), parse_sizes(" 0.5 ,25"))


@query(
    "skipped_datasets",
    """SELECT dataset, count(*) AS rows FROM (
         SELECT label::VARCHAR AS dataset, dense_rank() OVER (ORDER BY label) % 2 AS odd FROM embeddings)
       WHERE odd = 0 GROUP BY dataset""",
)
def skipped_datasets(spark: SparkSession, folder: str) -> DataFrame:
    """Every second label has lost its vectors."""
    vectors = table(spark, folder, "embeddings")
    labels = vectors.select("label").distinct()
    numbered = range_positions(labels, [F.col("label")])
    marked = vectors.join(numbered, "label").withColumn("dataset", F.col("label").cast("string"))
    return se.skipped_datasets(marked.withColumn("embedding", F.when(F.col("position") % 2 == 0, F.col("embedding"))))


@query(
    "size_advice",
    f"WITH {_TOTALS} SELECT dataset, n, n < 100000 AS warn_size, n < 100000 AS warn_epsilon FROM totals",
)
def size_advice(spark: SparkSession, folder: str) -> DataFrame:
    return se.size_advice(_totals(spark, folder), 160.0)


@query("fold_assignment", f"WITH {folds(7)} SELECT vec_id, fold, fold_size, total FROM vectors")
def fold_assignment(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").withColumn("dataset", F.lit("embeddings"))
    return assign_folds(vectors, "vec_id", 7).select("vec_id", "fold", "fold_size", "total")


@query(
    "fold_budgets",
    f"""WITH {folds(7)}, per_fold AS (SELECT DISTINCT fold, fold_size, total FROM vectors)
    SELECT fold, 'percent_0.1' AS size_spec, greatest(1, ceil(0.1::DOUBLE * fold_size))::BIGINT AS budget FROM per_fold
    UNION ALL SELECT fold, 'percent_0.25', greatest(1, ceil(0.25::DOUBLE * fold_size))::BIGINT FROM per_fold
    UNION ALL SELECT fold, 'samples_20',
      greatest(1, ceil(20::DOUBLE * (fold_size::DOUBLE / total::DOUBLE)))::BIGINT FROM per_fold""",
)
def fold_budgets(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", F.lit("embeddings").alias("dataset"))
    per_fold = (
        assign_folds(vectors, "vec_id", 7)
        .groupBy("dataset", "fold")
        .agg(F.first("fold_size").alias("fold_size"), F.first("total").alias("total"))
    )
    return se.fold_budgets(per_fold, SIZES).select("fold", "size_spec", "budget")


_PICKS = f"""
    WITH RECURSIVE {folds(FOLDS)}, sims AS (
      SELECT a.dataset, a.fold, a.vec_id AS i, b.vec_id AS j, round((list_dot_product(a.v, b.v) + 1) / 2, 7) AS s
      FROM units a JOIN units b ON a.dataset = b.dataset AND a.fold = b.fold),
    {greedy("vec_id", SIZES)}"""


def _picks(spark: SparkSession, folder: str, **options) -> DataFrame:
    vectors = table(spark, folder, "embeddings").withColumn("dataset", F.lit("embeddings"))
    return se.facility_location(vectors, SIZES, "vec_id", num_folds=FOLDS, **options)


@query(
    "facility_location",
    f"{_PICKS} SELECT fold, pick_no::INT AS pick_no, j AS vec_id, gain FROM greedy WHERE pick_no >= 0",
)
def facility_location(spark: SparkSession, folder: str) -> DataFrame:
    picks = _picks(spark, folder).filter(F.col("size_no") == 1)
    return picks.select("fold", "pick_no", "vec_id", "gain")


@query(
    "facility_location_sizes",
    f"{_PICKS} SELECT fold, size_no::INT AS size_no, pick_no::INT AS pick_no, vec_id, gain FROM picks",
)
def facility_location_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return _picks(spark, folder).select("fold", "size_no", "pick_no", "vec_id", "gain")


@query(
    "facility_location_stochastic",
    f"{_PICKS}, {sampled_greedy(SIZES, 0.1)} SELECT fold, size_no::INT AS size_no, pick_no::INT AS pick_no, j AS vec_id, gain"
    " FROM sampled WHERE pick_no >= 0",
)
def facility_location_stochastic(spark: SparkSession, folder: str) -> DataFrame:
    return _picks(spark, folder, epsilon=0.1).select("fold", "size_no", "pick_no", "vec_id", "gain")


def _selection(spark: SparkSession, folder: str) -> DataFrame:
    return se.merge_folds(_picks(spark, folder), SIZES, "vec_id")


@query(
    "subset_rows",
    f"""{_PICKS} SELECT size_spec, rank, vec_id, label, gain FROM merged JOIN embeddings USING (vec_id)
    WHERE rank < keep""",
)
def subset_rows(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").withColumn("dataset", F.lit("embeddings"))
    chosen = se.subset_rows(vectors, _selection(spark, folder), "vec_id", vector="embedding")
    return chosen.select("size_spec", "rank", "vec_id", "label", "gain")


@query("selection_metadata", f"{_PICKS} SELECT size_spec, rank, vec_id, gain FROM merged WHERE rank < keep")
def selection_metadata(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "selection")
    write_selection(_selection(spark, folder), path)
    return read_selection(spark, path).select("size_spec", "rank", "vec_id", "gain")


@query(
    "coverage_of_selection",
    f"""{_PICKS}, best AS (
      SELECT a.fold, a.vec_id, max((list_dot_product(a.v, b.v) + 1) / 2) AS s
      FROM units a JOIN units b USING (dataset, fold) JOIN picks p ON p.vec_id = b.vec_id AND p.size_no = 1
      GROUP BY ALL)
    SELECT fold, round(sum(s), 6) AS coverage FROM best GROUP BY fold""",
)
def coverage_of_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Value of the chosen rows of every fold, from the vectors alone."""
    chosen = _picks(spark, folder).filter(F.col("size_no") == 1).select(
        "dataset", "vec_id", F.lit("chosen").alias("member")
    )
    marked = folded(spark, folder).join(chosen, ["dataset", "vec_id"], "left")
    return coverage(marked, "member", "vec_id").select("fold", F.round("coverage", 6).alias("coverage"))
