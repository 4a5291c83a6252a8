"""New pages to vectors as they arrive.

Converting, chunking and embedding work inside the row, so they run unchanged on a
stream of pages and need no state. Files already processed are remembered by the
stream's checkpoint; a page delivered again with the same text is dropped by the
anti join against the store.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from paperloom.operators.embedding import Encoder, content_key, embed_missing
from paperloom.plans.retrieval import chunk_key, page_chunks
from paperloom.sources.stores import append_vectors, read_vectors

PAGE_SCHEMA = "page_id long, url string, html string"


def stream_pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(PAGE_SCHEMA).parquet(folder)


def ingest_batch(pages: DataFrame, store: str, encoder_name: str, encoder: Encoder | None = None) -> None:
    """Append the vectors of a batch's chunks that the store does not hold."""
    spark = pages.sparkSession
    chunks = page_chunks(pages).withColumn("key", chunk_key())
    held = read_vectors(spark, store) if _exists(spark, store) else None
    append_vectors(embed_missing(content_key(chunks, "key", "text", encoder_name), held, encoder), store)


def start_ingest(
    pages: DataFrame, store: str, checkpoint: str, encoder_name: str = "hash", encoder: Encoder | None = None
) -> StreamingQuery:
    """Process what is there and stop; start again to take in later arrivals."""
    return (
        pages.writeStream.foreachBatch(
            lambda batch, _: ingest_batch(batch, store, encoder_name, encoder)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True
