"""Raw pages to documents, and documents to Markdown and JSON.

A *document* is one row with the columns ``doc_id``, ``source``, ``name`` and
``items``. All of it is computed inside the row: converting a table of pages is
one narrow stage over its scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.evaluate import once
from paperloom.functions.html import ITEM_TYPE, html_items
from paperloom.functions.images import data_address, picture_markdown
from paperloom.functions.text import safe_filename

CONVERTED, EMPTY, MISSING = "converted", "no items", "no content"


def convert_pages(
    pages: DataFrame,
    doc_id: str = "page_id",
    source: str = "url",
    html: str = "html",
    on_error: str = "skip",
) -> DataFrame:
    """Convert every page; a ``status`` column tells how it went.

    ``on_error="strict"`` fails the job on the first page that cannot be
    converted, ``"skip"`` keeps it with its status for :func:`rejects`.
    """
    if on_error not in ("skip", "strict"):
        raise ValueError("on_error must be 'skip' or 'strict'")
    items = F.coalesce(html_items(F.col(html)), F.array().cast(ITEM_TYPE))
    docs = pages.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        safe_filename(F.col(source)).alias("name"),
        F.col(html).isNull().alias("_missing"),
        once(items).alias("items"),
    )
    status = (
        F.when(F.col("_missing"), MISSING).when(F.size("items") == 0, EMPTY).otherwise(CONVERTED)
    )
    if on_error == "strict":
        failed = F.raise_error(
            F.concat(F.lit("cannot convert document "), F.col("doc_id").cast("string"), F.lit(": "), status)
        )
        status = F.when(status == CONVERTED, status).otherwise(failed.cast("string"))
    return docs.withColumn("status", status).drop("_missing")


def converted(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("status") == CONVERTED)


def rejects(docs: DataFrame) -> DataFrame:
    """Documents that gave nothing, with the reason."""
    return docs.filter(F.col("status") != CONVERTED).select("doc_id", "source", "status")


def item_rows(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per item, numbered from 0 in reading order."""
    return docs.select("doc_id", *keep, F.posexplode("items").alias("item_idx", "item")).select(
        "doc_id", *keep, "item_idx", "item.label", "item.level", "item.text"
    )


def attach_pictures(docs: DataFrame, pictures: DataFrame, uri: str = "uri", content: str = "content") -> DataFrame:
    """Documents with ``pictures``, the bytes of their pictures by place of the item.

    Picture items are exploded with their place, meet the table of pictures by an equi-join on the address, and are put back by
    place; items and texts do not move for it. A picture without bytes, or with null ones, is not there. Of
    repeated addresses the least bytes count.
    """
    places = docs.select("doc_id", F.posexplode("items").alias("_place", "_item")).filter(F.col("_item.label") == "picture")
    known = pictures.filter(F.col(content).isNotNull()).groupBy(F.col(uri).alias("_uri")).agg(F.min(content).alias("_bytes"))
    met = places.select("doc_id", "_place", F.col("_item.text").alias("_uri")).join(known, "_uri")
    back = met.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("_place", "_bytes"))).alias("pictures"))
    return docs.join(back, "doc_id", "left")


def _item_markdown(item: Column, image_mode: str, content: Column | None) -> Column:
    text, label = item["text"], item["label"]
    return (
        F.when(item["level"] > 0, F.concat(F.repeat(F.lit("#"), item["level"]), F.lit(" "), text))
        .when(label == "list_item", F.concat(F.lit("- "), text))
        .when(label == "table_row", F.concat(F.lit("| "), text, F.lit(" |")))
        .when(label == "code", F.concat(F.lit("```\n"), text, F.lit("\n```")))
        .when(label == "picture", picture_markdown(image_mode, text, content))
        .otherwise(text)
    )


def markdown(items: Column, image_mode: str = "referenced", pictures: Column | None = None) -> Column:
    """Markdown of a document, items separated by a blank line; ``pictures`` has bytes by place."""

    def one(item: Column, place: Column) -> Column:
        return _item_markdown(item, image_mode, None if pictures is None else F.try_element_at(pictures, place))

    return F.array_join(F.transform(items, one), "\n\n")


def document_json(image_mode: str = "referenced", pictures: Column | None = None) -> Column:
    """Lossless JSON of a document row; :func:`paperloom.sources.documents.read_documents` reads it.

    With ``embedded`` pictures whose bytes are known hold them as ``image``, a data address.
    """
    if image_mode != "embedded" or pictures is None:
        return F.to_json(F.struct("doc_id", "source", "name", "items"))

    def whole(item: Column, place: Column) -> Column:
        return F.struct(item["label"].alias("label"), item["level"].alias("level"), item["text"].alias("text"),
                        data_address(F.try_element_at(pictures, place)).alias("image"))

    return F.to_json(F.struct("doc_id", "source", "name", F.transform("items", whole).alias("items")))


def export_documents(docs: DataFrame, image_mode: str = "referenced") -> DataFrame:
    """``(doc_id, stem, json, md)`` for every document; ``embedded`` needs :func:`attach_pictures` first to show bytes."""
    pictures = F.col("pictures") if "pictures" in docs.columns else None
    return docs.select(
        "doc_id",
        F.col("name").alias("stem"),
        document_json(image_mode, pictures).alias("json"),
        markdown(F.col("items"), image_mode, pictures).alias("md"),
    )


def shared_stems(exported: DataFrame) -> DataFrame:
    """File stems that more than one document claims; written as files they would overwrite."""
    return exported.groupBy("stem").agg(F.count("*").alias("n_docs")).filter("n_docs > 1")
