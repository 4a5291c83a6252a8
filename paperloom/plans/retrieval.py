"""Pages to a searchable collection, and text queries against it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.config import ChunkConfig, ConvertConfig
from paperloom.functions.text import safe_filename
from paperloom.operators.chunking import chunk_documents, chunk_records
from paperloom.operators.convert import attach_pictures, convert_pages, converted, export_documents
from paperloom.operators.embedding import Encoder, embed
from paperloom.operators.search import topk_search, with_hit_fields
from paperloom.operators.splits import assign_splits


def chunk_key():
    """Unique key of a chunk: chunk ids follow file names, which documents may share."""
    return F.concat_ws("#", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string"))


def convert_corpus(pages: DataFrame, config: ConvertConfig = ConvertConfig()) -> DataFrame:
    """Documents of raw pages; ``config.on_error`` says what becomes of pages that give none."""
    return converted(convert_pages(pages, on_error=config.on_error))


def export_corpus(
    pages: DataFrame, config: ConvertConfig = ConvertConfig(), pictures: DataFrame | None = None
) -> DataFrame:
    """``(doc_id, stem, json, md)`` of raw pages with pictures as ``config.image_mode`` says; ``pictures`` has ``uri, content``."""
    docs = convert_corpus(pages, config)
    if config.image_mode == "embedded" and pictures is not None:
        docs = attach_pictures(docs, pictures)
    return export_documents(docs, config.image_mode)


def listed_splits(names: DataFrame, config: ConvertConfig = ConvertConfig(), name: str = "name") -> DataFrame:
    """Document names dealt over ``config.num_splits`` splits."""
    return assign_splits(names, config.num_splits, name)


def page_chunks(
    pages: DataFrame, config: ChunkConfig = ChunkConfig(), convert: ConvertConfig = ConvertConfig()
) -> DataFrame:
    """Chunk records of raw pages."""
    docs = convert_corpus(pages, convert)
    return chunk_records(chunk_documents(docs, config.max_tokens, config.merge_peers))


def page_vectors(
    pages: DataFrame, encoder: Encoder | None = None, config: ChunkConfig = ChunkConfig()
) -> DataFrame:
    """Chunk records with ``key`` and ``embedding``; one narrow stage over the page scan."""
    return embed(page_chunks(pages, config), "text", encoder).withColumn("key", chunk_key())


def semantic_search(
    collection: DataFrame,
    queries: DataFrame,
    encoder: Encoder | None = None,
    k: int | None = None,
    query_key: str = "query_id",
    query_text: str = "text",
    config: ChunkConfig = ChunkConfig(),
) -> DataFrame:
    """Hits of text queries in a stored collection, ``k`` or else ``config.top_k`` for each.

    The search reads ids and vectors only; texts are read for the hits' sake in a
    second scan. Columns: the query, ``rank, id, chunk_id, text, source, chunk_index,
    similarity_score``.
    """
    asked = embed(queries.select(query_key, query_text), query_text, encoder)
    hits = topk_search(collection, asked, config.top_k if k is None else k, key="id", query_key=query_key)
    chunk_id = F.concat(
        safe_filename(F.col("source")), F.lit("_chunk_"), F.col("chunk_index").cast("string")
    )
    return with_hit_fields(hits, collection, "id", "text", "source", "chunk_index").select(
        query_key,
        "rank",
        "id",
        chunk_id.alias("chunk_id"),
        "text",
        "source",
        "chunk_index",
        F.col("score").alias("similarity_score"),
    )
