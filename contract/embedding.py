"""Vectors from texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import query, spread_table, table
from contract.conversion import documents
from contract.sql import DEFAULT_SETTING, ITEMS, PACKED, hashed, pieces, sparse_text, words
from paperloom.functions.vectors import l2_normalize
from paperloom.operators.chunking import chunk_documents
from paperloom.operators.embedding import (
    ENCODERS,
    batch_encoder,
    content_key,
    current_vectors,
    dimension_counts,
    embed,
    embed_missing,
    get_encoder,
    hashing_encoder,
)
from paperloom.session import scratch_path
from paperloom.sources.stores import append_vectors, read_vectors

_DOCUMENT_VECTORS = f"WITH {hashed('documents', 'doc_id', 'text', 'd')} {sparse_text('documents', 'doc_id', 'd')}"


def vector_text(vector: Column) -> Column:
    """Non-zero elements as ``index:millionths`` pairs."""
    pairs = F.transform(
        vector,
        lambda x, i: F.when(
            x != 0,
            F.concat_ws(":", i.cast("string"), F.round(x.cast("double") * 1e6).cast("long").cast("string")),
        ),
    )
    return F.array_join(F.filter(pairs, lambda p: p.isNotNull()), ",")


@query("hash_embed", _DOCUMENT_VECTORS)
def hash_embed(spark: SparkSession, folder: str) -> DataFrame:
    vectors = embed(spread_table(spark, folder, "documents", "doc_id").select("doc_id", "text"))
    return vectors.select("doc_id", vector_text(F.col("embedding")).alias("vector"))


@query(
    "chunk_embeddings",
    f"""WITH RECURSIVE {ITEMS}, {pieces(DEFAULT_SETTING)}, {PACKED}, keyed AS (
      SELECT page_id || '#' || chunk_index AS key, text FROM chunks),
    {hashed('keyed', 'key', 'text', 'c')} {sparse_text('keyed', 'key', 'c')}""",
)
def chunk_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    chunks = embed(chunk_documents(documents(spark, folder)))
    return chunks.select(
        F.concat_ws("#", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string")).alias("key"),
        vector_text(F.col("embedding")).alias("vector"),
    )


@query(
    "embed_truncated",
    f"""WITH cut AS (SELECT doc_id, array_to_string({words("text")}[1:16], ' ') AS text FROM documents),
    {hashed("cut", "doc_id", "text", "d")} {sparse_text("cut", "doc_id", "d")}""",
)
def embed_truncated(spark: SparkSession, folder: str) -> DataFrame:
    """An encoder that takes 16 words at most."""
    docs = spread_table(spark, folder, "documents", "doc_id").select("doc_id", "text")
    return embed(docs, encoder=hashing_encoder(max_tokens=16)).select("doc_id", vector_text(F.col("embedding")).alias("vector"))


def _letter_model():
    """A model of one's own: how long a text is, and how many letters e it has."""
    import numpy as np

    return lambda texts: np.array([[len(t), t.count("e")] for t in texts.reshape(-1)], dtype=np.float32)


@query(
    "embed_user_model",
    "SELECT doc_id, length(text)::INT AS chars, (length(text) - length(replace(text, 'e', '')))::INT AS letters FROM documents",
)
def embed_user_model(spark: SparkSession, folder: str) -> DataFrame:
    """A user's model that takes small batches, chosen by name."""
    known = ENCODERS | {"letters": lambda: batch_encoder(_letter_model, batch_size=7)}
    docs = spread_table(spark, folder, "documents", "doc_id").select("doc_id", "text")
    vectors = embed(docs, encoder=get_encoder("letters", known))
    return vectors.select("doc_id", *[F.col("embedding")[i].cast("int").alias(n) for i, n in enumerate(("chars", "letters"))])


@query("embed_incremental", _DOCUMENT_VECTORS)
def embed_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents are embedded first, then whatever the store lacks."""
    docs = spread_table(spark, folder, "documents", "doc_id")
    labels = table(spark, folder, "labels")
    path = scratch_path(spark, "vectors")
    first = content_key(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), "doc_id", "text", "hash")
    append_vectors(embed_missing(first, None), path)
    everything = content_key(docs, "doc_id", "text", "hash")
    append_vectors(embed_missing(everything, read_vectors(spark, path)), path)
    stored = current_vectors(everything, read_vectors(spark, path))
    return stored.select(F.col("row_id").alias("doc_id"), vector_text(F.col("embedding")).alias("vector"))


@query(
    "embedding_store",
    """SELECT vec_id AS row_id, len(embedding)::INT AS dim,
              array_to_string(list_transform(embedding, lambda x: round(x::DOUBLE * 1e6)::BIGINT), ',') AS vector
       FROM embeddings""",
)
def embedding_store(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "embeddings")
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        F.md5(F.to_json(F.struct("embedding"))).alias("content_hash"),
        F.lit("given").alias("encoder"),
        "embedding",
    )
    append_vectors(vectors, path)
    return read_vectors(spark, path).select(
        "row_id",
        F.size("embedding").alias("dim"),
        F.array_join(
            F.transform("embedding", lambda x: F.round(x.cast("double") * 1e6).cast("long")), ","
        ).alias("vector"),
    )


@query(
    "embedding_dim_check",
    "SELECT len(embedding)::INT AS dim, count(*) AS n_rows FROM embeddings GROUP BY 1",
)
def embedding_dim_check(spark: SparkSession, folder: str) -> DataFrame:
    return dimension_counts(table(spark, folder, "embeddings"))


@query(
    "l2_normalize",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)
       SELECT vec_id, array_to_string(list_transform(v, lambda x:
                round(x / greatest(sqrt(list_dot_product(v, v)), 1e-12) * 1e6)::BIGINT), ',') AS vector
       FROM v""",
)
def l2_normalize_query(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.array_join(
            F.transform(l2_normalize(F.col("embedding")), lambda x: F.round(x * 1e6).cast("long")), ","
        ).alias("vector"),
    )
