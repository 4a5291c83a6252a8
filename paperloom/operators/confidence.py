"""Conversion confidence: page scores, their roll-up per document, weak pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.functions.evaluate import once

DEFAULT_CUTS = (0.5, 0.8, 0.9)

# Scores and means are compared at this precision, so that the order of additions
# does not matter.
_DIGITS = 9


def text_score(text: Column) -> Column:
    """Share of letters, digits and spaces in a text, 0 to 1; NULL for an empty text."""
    clean = F.length(F.regexp_replace(text, r"[^\p{L}\p{N} ]", ""))
    return F.try_divide(clean.cast("double"), F.length(text).cast("double"))


def grade(score: Column, cuts: tuple[float, float, float] = DEFAULT_CUTS) -> Column:
    """Grade of a mean score; a document without scores is unspecified."""
    poor, fair, good, excellent, unspecified = C.CONFIDENCE_GRADES
    return (
        F.when(score.isNull(), unspecified)
        .when(score < cuts[0], poor)
        .when(score < cuts[1], fair)
        .when(score < cuts[2], good)
        .otherwise(excellent)
    )


def document_confidence(docs: DataFrame, scores: Column) -> DataFrame:
    """Confidence of documents that carry their page scores as an array, within the row.

    Columns: ``doc_id, n_pages, mean_score, mean_grade, low_pages``, the last an array
    of ``(page, score)`` below the mean, numbered from 1. Pages without score do not count.
    """
    scored = docs.select(
        "doc_id",
        once(F.transform(scores, lambda s, i: F.struct((i + 1).alias("page"), s.alias("score")))).alias(
            "_pages"
        ),
    ).select("doc_id", F.filter("_pages", lambda p: p["score"].isNotNull()).alias("_pages"))
    total = F.aggregate("_pages", F.lit(0.0), lambda sum_, p: sum_ + p["score"])
    counted = scored.withColumn("n_pages", F.size("_pages").cast("long")).withColumn(
        "mean_score", F.try_divide(total, F.col("n_pages").cast("double"))
    )
    return counted.select(
        "doc_id",
        "n_pages",
        "mean_score",
        grade(F.col("mean_score")).alias("mean_grade"),
        F.filter(
            "_pages", lambda p: F.round(p["score"], _DIGITS) < F.round(F.col("mean_score"), _DIGITS)
        ).alias("low_pages"),
    )


def rollup(scores: DataFrame, doc_id: str = "doc_id", score: str = "score") -> DataFrame:
    """Mean score and grade per document, from a table with one row per page.

    The mean is partially aggregated before the shuffle.
    """
    means = scores.groupBy(doc_id).agg(
        F.count(score).alias("n_pages"), F.avg(score).alias("mean_score")
    )
    return means.withColumn("mean_grade", grade(F.col("mean_score")))


def low_pages(
    scores: DataFrame, doc_id: str = "doc_id", page: str = "page_no", score: str = "score"
) -> DataFrame:
    """Pages scored below their document's mean, from a table with one row per page.

    Page numbers count from 1; a document without such a page gives one row with a
    NULL page. The pages meet their document's mean in an equi-join, not in a window,
    so a document with very many pages is split over tasks. Which documents have no
    weak page follows from their lowest score.
    """
    means = scores.groupBy(doc_id).agg(
        F.round(F.avg(score), _DIGITS).alias("mean_score"),
        F.round(F.min(score), _DIGITS).alias("least"),
    )
    below = (
        scores.join(means.select(doc_id, "mean_score"), doc_id)
        .filter(F.round(score, _DIGITS) < F.col("mean_score"))
        .select(doc_id, (F.col(page) + 1).cast("long").alias("low_page"), F.col(score).alias("low_score"))
    )
    none_below = means.filter(~F.coalesce(F.col("least") < F.col("mean_score"), F.lit(False))).select(
        doc_id,
        F.lit(None).cast("long").alias("low_page"),
        F.lit(None).cast("double").alias("low_score"),
    )
    return below.unionByName(none_below)
