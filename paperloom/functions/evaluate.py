"""Keeping expensive expressions from being computed more than once per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(expensive: Column) -> Column:
    """The same value as a generated column.

    Spark moves filters below projections and then computes a projected expression
    in the filter and again in the projection. A generator's output is a plain column
    to everything above it. The one-element array gives exactly one row per row.
    """
    return F.explode(F.array(expensive))
