"""Converted documents on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ITEM = "label:string,level:int,text:string"


def write_documents(exported: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON and Markdown of every document as one table; equal stems do not overwrite."""
    exported.write.mode(mode).parquet(path)


def write_document_files(
    exported: DataFrame, path: str, column: str, mode: str = "errorifexists"
) -> None:
    """One folder ``stem=.../`` per document name holding the text of ``column``."""
    exported.select("stem", F.col(column).alias("value")).write.mode(mode).partitionBy("stem").text(path)


def read_documents(
    spark: SparkSession, path: str, multi_line: bool = False, id_type: str = "long", images: bool = False
) -> DataFrame:
    """Documents from JSON, one per line, or one per file with ``multi_line``.

    ``id_type`` is the type of ``doc_id``, such as ``string``. A document that is not of this form, its id included,
    is an error and not a row of nulls. With ``images`` items have the embedded ``image`` too.
    """
    item = f"{_ITEM},image:string" if images else _ITEM
    reader = spark.read.schema(f"doc_id {id_type}, source string, name string, items array<struct<{item}>>").option("multiLine", multi_line)
    return reader.option("mode", "FAILFAST").json(path)


def write_document_json(exported: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The JSON of every document, one per line."""
    exported.select(F.col("json").alias("value")).write.mode(mode).text(path)


def write_chunks(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Chunk records as JSON lines."""
    records.write.mode(mode).json(path)
