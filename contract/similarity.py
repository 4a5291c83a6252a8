"""Similarity inside folds and to a reference set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import query, table
from contract.sql import CENTROIDS, folds
from paperloom.operators.folds import assign_folds
from paperloom.operators.similarity import coverage, fold_profiles, nearest_reference

FOLDS = 5


def folded(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").withColumn("dataset", F.lit("embeddings"))
    return assign_folds(vectors, "vec_id", FOLDS)


_METRICS = {
    "cosine": "list_dot_product(a.v, b.v)",
    "dot": "list_dot_product(a.w, b.w)",
    "euclidean": "1 / (1 + list_dot_product(list_transform(list_zip(a.w, b.w), lambda p: p[1] - p[2]), "
    "list_transform(list_zip(a.w, b.w), lambda p: p[1] - p[2])))",
    "rbf": "list_dot_product(list_transform(list_zip(a.w, b.w), lambda p: p[1] - p[2]), "
    "list_transform(list_zip(a.w, b.w), lambda p: p[1] - p[2]))",
}
_SCALES = {
    None: "s",
    "additive": "(s + 1) / 2",
    "min-max": "(s - min(s) OVER (PARTITION BY fold)) / (max(s) OVER (PARTITION BY fold) - min(s) OVER (PARTITION BY fold))",
}


def _profile_sql(metric: str, scaling: str | None = None) -> str:
    raw = "exp(-s / (0.1 * avg(s) OVER (PARTITION BY fold)))" if metric == "rbf" else "s"
    return f"""
    WITH {folds(FOLDS)}, both_forms AS (
      SELECT u.vec_id, u.fold, u.v, x.v AS w FROM units u JOIN vectors x USING (vec_id)),
    first_values AS (
      SELECT a.fold, a.vec_id AS i, b.vec_id AS j, {_METRICS[metric]} AS s
      FROM both_forms a JOIN both_forms b USING (fold)),
    second_values AS (SELECT fold, i, j, {raw} AS s FROM first_values),
    sims AS (SELECT fold, i, j, {_SCALES[scaling]} AS s FROM second_values),
    others AS (
      SELECT i, j AS nearest, round(s, 6) + 0.0 AS nearest_sim FROM sims WHERE i <> j
      QUALIFY row_number() OVER (PARTITION BY i ORDER BY round(s, 6) DESC, j) = 1)
    SELECT fold, i AS vec_id, count(*) AS n, round(min(s), 6) + 0.0 AS sim_min, round(max(s), 6) + 0.0 AS sim_max,
           round(sum(s), 6) + 0.0 AS sim_sum, any_value(nearest) AS nearest, any_value(nearest_sim) AS nearest_sim
    FROM sims JOIN others USING (i) GROUP BY fold, i"""


def _rounded(df: DataFrame) -> DataFrame:
    for name in ("sim_min", "sim_max", "sim_sum"):
        df = df.withColumn(name, F.round(name, 6))
    return df.drop("dataset")


def _register(name: str, metric: str, scaling: str | None = None) -> None:
    @query(name, _profile_sql(metric, scaling))
    def profile(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(fold_profiles(folded(spark, folder), metric, scaling, "vec_id"))


_register("pairwise_cosine", "cosine")
_register("pairwise_dot", "dot")
_register("pairwise_euclidean", "euclidean")
_register("pairwise_rbf", "rbf")
_register("scale_minmax", "dot", "min-max")
_register("scale_additive", "dot", "additive")


def centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Mean vector of every label."""
    means = (
        table(spark, folder, "embeddings")
        .select("label", F.posexplode("embedding").alias("at", "x"))
        .groupBy("label", "at")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("at", "x")))
    return means.groupBy("label").agg(F.transform(ordered, lambda p: p["x"]).alias("embedding"))


def _two_set_sql(metric: str, scaling: str | None = None) -> str:
    if metric == "cosine":
        value = "list_dot_product(v, c) / (greatest(sqrt(list_dot_product(v, v)), 1e-12) * greatest(sqrt(list_dot_product(c, c)), 1e-12))"
    else:
        value = "list_dot_product(list_transform(list_zip(v, c), lambda p: p[1] - p[2]), list_transform(list_zip(v, c), lambda p: p[1] - p[2]))"
    raw = "exp(-s / (0.1 * avg(s) OVER ()))" if metric == "rbf" else "s"
    scaled = "(s - min(s) OVER ()) / (max(s) OVER () - min(s) OVER ())" if scaling == "min-max" else "s"
    return f"""
    WITH {CENTROIDS}, a AS (
      SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    first_values AS (SELECT vec_id, label, {value} AS s FROM a, (SELECT label, v AS c FROM centroids)),
    second_values AS (SELECT vec_id, label, {raw} AS s FROM first_values),
    sims AS (SELECT vec_id, label, {scaled} AS s FROM second_values),
    nearest AS (
      SELECT vec_id, label AS nearest FROM sims
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 6) DESC, label) = 1)
    SELECT vec_id, round(min(s), 6) + 0.0 AS sim_min, round(max(s), 6) + 0.0 AS sim_max,
           round(sum(s), 6) + 0.0 AS sim_sum, any_value(nearest) AS nearest
    FROM sims JOIN nearest USING (vec_id) GROUP BY vec_id"""


def _register_two_sets(name: str, metric: str, scaling: str | None = None) -> None:
    @query(name, _two_set_sql(metric, scaling))
    def nearest(spark: SparkSession, folder: str) -> DataFrame:
        vectors = table(spark, folder, "embeddings")
        references = centroids(spark, folder)
        return _rounded(
            nearest_reference(vectors, references, metric, scaling, "vec_id", reference_key="label")
        )


_register_two_sets("pairwise_two_sets", "cosine")
_register_two_sets("pairwise_two_sets_rbf", "rbf")
_register_two_sets("pairwise_two_sets_minmax", "cosine", "min-max")


@query(
    "coverage_value",
    f"""
    WITH {folds(FOLDS)}, best AS (
      SELECT a.fold, a.vec_id, b.label, max((list_dot_product(a.v, b.v) + 1) / 2) AS s
      FROM units a JOIN units b USING (fold) GROUP BY ALL)
    SELECT fold, label, round(sum(s), 6) AS coverage FROM best GROUP BY ALL""",
)
def coverage_value(spark: SparkSession, folder: str) -> DataFrame:
    """Value of choosing all rows of a label, for every label and fold."""
    values = coverage(folded(spark, folder), "label", "vec_id")
    return values.select("fold", "label", F.round("coverage", 6).alias("coverage"))
