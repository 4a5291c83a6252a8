"""Vector search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import query, spread_table, table
from contract.similarity import centroids
from contract.sql import CENTROIDS, DEFAULT_SETTING, ITEMS, NAMED_PAGES, PACKED, hashed, pieces
from paperloom.constants import HASH_DIM
from paperloom.functions.text import hit_preview, hit_source
from paperloom.functions.vectors import as_matrix
from paperloom.operators.embedding import embed
from paperloom.operators.search import CellIndex, build_cells, cell_search, topk_search
from paperloom.plans.retrieval import chunk_key, page_vectors, semantic_search
from paperloom.session import scratch_path
from paperloom.sources.stores import collection_rows, read_collection, write_collection

_TOPK = f"""
    WITH {CENTROIDS}, corpus AS (
      SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    scored AS (
      SELECT c.label, vec_id, round(list_dot_product(c.v, e.v) / (greatest(sqrt(list_dot_product(c.v, c.v)), 1e-12)
             * greatest(sqrt(list_dot_product(e.v, e.v)), 1e-12)), 6) + 0.0 AS score
      FROM centroids c, corpus e)
    SELECT label, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
    FROM scored QUALIFY rank <= 5"""


@query("vector_topk", _TOPK)
def vector_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five rows nearest to the mean vector of every label."""
    return topk_search(
        table(spark, folder, "embeddings"), centroids(spark, folder), 5, "vec_id", query_key="label"
    )


@query("vector_topk_blocks", _TOPK)
def vector_topk_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the queries shipped in several blocks."""
    return topk_search(
        table(spark, folder, "embeddings"),
        centroids(spark, folder),
        5,
        "vec_id",
        query_key="label",
        block_queries=3,
    )


@query(
    "vector_topk_batch",
    f"""
    WITH {hashed('documents', 'doc_id', 'text', 'd')}, {hashed('benchmark', 'item_id', 'text', 'q')},
    scored AS (
      SELECT item_id, doc_id, sum(d.x * q.x) AS s FROM d_vec d JOIN q_vec q USING (b) GROUP BY ALL),
    rounded AS (
      SELECT item_id, doc_id, round(s / (a.len * b.len), 6) + 0.0 AS score
      FROM scored JOIN d_len a USING (doc_id) JOIN q_len b USING (item_id))
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
    FROM rounded QUALIFY rank <= 1""",
)
def vector_topk_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The best document for every benchmark text."""
    docs = embed(spread_table(spark, folder, "documents", "doc_id").select("doc_id", "text"))
    asked = embed(table(spark, folder, "benchmark"))
    return topk_search(docs, asked, 1, "doc_id", query_key="item_id")


def _cosine(a: str, b: str) -> str:
    return (
        f"(list_dot_product({a}, {b}) / (greatest(sqrt(list_dot_product({a}, {a})), 1e-12)"
        f" * greatest(sqrt(list_dot_product({b}, {b})), 1e-12)))"
    )


@query(
    "ivf_topk",
    f"""
    WITH {CENTROIDS}, corpus AS (
      SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    homes AS (
      SELECT vec_id, e.v, label AS cell FROM centroids c, corpus e
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY {_cosine('c.v', 'e.v')} DESC, label) = 1),
    probed AS (
      SELECT c.label, c.v, d.label AS cell FROM centroids c, centroids d
      QUALIFY row_number() OVER (PARTITION BY c.label ORDER BY {_cosine('c.v', 'd.v')} DESC, d.label) <= 4),
    scored AS (
      SELECT label, vec_id, round({_cosine('p.v', 'h.v')}, 6) + 0.0 AS score FROM probed p JOIN homes h USING (cell))
    SELECT label, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
    FROM scored QUALIFY rank <= 5""",
)
def ivf_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Four probes; the cell centres are the label means, given and not trained."""
    means = centroids(spark, folder).orderBy("label").toArrow()
    return _cells(spark, folder, CellIndex(as_matrix(means.column("embedding"))), probes=4)


@query("ivf_topk_all_cells", _TOPK)
def ivf_topk_all_cells(spark: SparkSession, folder: str) -> DataFrame:
    """With every cell probed the result is the exact one."""
    return _cells(spark, folder, build_cells(table(spark, folder, "embeddings"), cells=16), probes=16)


def _cells(spark: SparkSession, folder: str, index: CellIndex, probes: int) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    path = scratch_path(spark, "cells")
    stored = index.assign(vectors, "vec_id").hint("rebalance", "cell")
    stored.write.partitionBy("cell").parquet(path)
    return cell_search(
        spark.read.parquet(path), index, centroids(spark, folder), 5, probes, "vec_id", query_key="label"
    )


_HITS = f"""
    WITH RECURSIVE {ITEMS}, {NAMED_PAGES}, {pieces(DEFAULT_SETTING)}, {PACKED}, keyed AS (
      SELECT page_id || '#' || chunk_index AS key, page_id, chunk_index, text FROM chunks),
    {hashed('keyed', 'key', 'text', 'd')}, {hashed('benchmark', 'item_id', 'text', 'q')},
    scored AS (
      SELECT item_id, key, sum(d.x * q.x) AS s FROM d_vec d JOIN q_vec q USING (b) GROUP BY ALL),
    rounded AS (
      SELECT item_id, key, round(s / (a.len * b.len), 6) + 0.0 AS score
      FROM scored JOIN d_len a USING (key) JOIN q_len b USING (item_id)),
    hits AS (
      SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, key)::INT AS rank, key, score
      FROM rounded QUALIFY rank <= 3)"""


def hits(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark texts searched in a stored collection of page chunks."""
    path = scratch_path(spark, "collection")
    rows = collection_rows(page_vectors(spread_table(spark, folder, "pages", "page_id")), chunk_key())
    write_collection(rows, path, HASH_DIM)
    found = read_collection(spark, path)
    return semantic_search(found, table(spark, folder, "benchmark"), k=3, query_key="item_id")


@query(
    "semantic_search",
    f"""{_HITS}
    SELECT item_id, rank, name || '_chunk_' || chunk_index AS chunk_id, k.text, url AS source, chunk_index,
           score AS similarity_score
    FROM hits JOIN keyed k USING (key) JOIN named USING (page_id)""",
)
def semantic_search_query(spark: SparkSession, folder: str) -> DataFrame:
    return hits(spark, folder).drop("id")


@query(
    "hit_preview",
    f"""{_HITS}
    SELECT item_id, rank, substr(regexp_extract(url, '[^/]*$'), 1, 60) || '...' AS source,
           replace(substr(k.text, 1, 1000), chr(10), ' ') || '...' AS preview
    FROM hits JOIN keyed k USING (key) JOIN named USING (page_id)""",
)
def hit_preview_query(spark: SparkSession, folder: str) -> DataFrame:
    return hits(spark, folder).select(
        "item_id",
        "rank",
        hit_source(F.col("source")).alias("source"),
        hit_preview(F.col("text")).alias("preview"),
    )
