"""Typed fields by the four kinds of template."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import query, table
from paperloom.operators.extraction import extract_fields, json_finders, pattern_finders


@dataclass(frozen=True)
class PageAddress:
    """Parts of an address; host and language are always expected."""

    host: str
    language: str
    article: Optional[int] = None
    first: bool = False
    campaign: str = "none"


PATTERNS = {
    "host": r"^https?://([^/?#]+)",
    "language": r"^https?://[^/]+/([a-z]+)/",
    "article": r"/(\d+)(?:[/.?#]|$)",
    "first": r"[?&]page=([01])(?:[&#]|$)",
    "campaign": r"[?&]utm_source=([^&#]*)",
}
LINK = {"article": PATTERNS["article"], "page": r"[?&]page=([0-9.]+)"}

_FOUND = r"""
found AS (
  SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '/(\d+)(?:[/.?#]|$)', 1), '') AS BIGINT) AS article,
         TRY_CAST(nullif(regexp_extract(url, '[?&]page=([0-9.]+)', 1), '') AS DOUBLE) AS page,
         CASE WHEN regexp_matches(url, '^https?://([^/?#]+)') THEN regexp_extract(url, '^https?://([^/?#]+)', 1) END AS host,
         CASE WHEN regexp_matches(url, '^https?://[^/]+/([a-z]+)/') THEN regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) END AS language,
         CASE regexp_extract(url, '[?&]page=([01])(?:[&#]|$)', 1) WHEN '1' THEN true WHEN '0' THEN false END AS first,
         CASE WHEN regexp_matches(url, '[?&]utm_source=([^&#]*)')
              THEN regexp_extract(url, '[?&]utm_source=([^&#]*)', 1) END AS campaign
  FROM pages)"""


def _text_missing(df: DataFrame) -> DataFrame:
    return df.withColumn("missing_fields", F.array_join("missing_fields", ","))


@query(
    "extract_string_template",
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
              json_extract_string(props, '$.name') AS name, '' AS missing_fields FROM events""",
)
def extract_string_template(spark: SparkSession, folder: str) -> DataFrame:
    template = '{"k": "float", "name": "string"}'
    finders = json_finders(F.col("props"), {"k": "k", "name": "name"})
    return _text_missing(extract_fields(table(spark, folder, "events"), template, finders, "event_id"))


@query(
    "extract_dict_template",
    f"WITH {_FOUND} SELECT page_id, article, page, '' AS missing_fields FROM found",
)
def extract_dict_template(spark: SparkSession, folder: str) -> DataFrame:
    finders = pattern_finders(F.col("url"), LINK)
    template = {"article": "int", "page": "float"}
    return _text_missing(extract_fields(table(spark, folder, "pages"), template, finders, "page_id"))


@query(
    "extract_model_template",
    f"""WITH {_FOUND} SELECT page_id, host, language, article, coalesce(first, false) AS first, coalesce(campaign, 'none') AS campaign,
           concat_ws(',', CASE WHEN host IS NULL THEN 'host' END, CASE WHEN language IS NULL THEN 'language' END) AS missing_fields
    FROM found""",
)
def extract_model_template(spark: SparkSession, folder: str) -> DataFrame:
    finders = pattern_finders(F.col("url"), PATTERNS)
    return _text_missing(extract_fields(table(spark, folder, "pages"), PageAddress, finders, "page_id"))


@query(
    "extract_instance_template",
    f"""WITH {_FOUND} SELECT page_id, coalesce(host, 'localhost') AS host, coalesce(language, 'xx') AS language,
           coalesce(article, -1) AS article, coalesce(first, true) AS first, coalesce(campaign, '') AS campaign, '' AS missing_fields FROM found""",
)
def extract_instance_template(spark: SparkSession, folder: str) -> DataFrame:
    finders = pattern_finders(F.col("url"), PATTERNS)
    template = PageAddress("localhost", "xx", -1, True, "")
    return _text_missing(extract_fields(table(spark, folder, "pages"), template, finders, "page_id"))
