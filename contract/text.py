"""Names, tokens, templates, sizes and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import query, spread_table, table
from contract.sql import NAMED_PAGES, SPACES, words
from paperloom.constants import SUBSET_INSTRUCTION
from paperloom.functions.templates import render, render_turns
from paperloom.functions.text import (
    dataset_name,
    safe_filename,
    token_count,
    with_instruction,
)
from paperloom.operators.splits import assign_splits, first_split
from paperloom.sources.manifest import names_from_lists, with_location


@query(
    "manifest_from_list",
    f"""
    WITH lists AS (
      SELECT doc_id, list_filter(list_transform(string_split(text, ','),
        lambda x: regexp_replace(x, '\\A{SPACES}|{SPACES}\\z', '', 'g')), lambda x: x <> '') AS names
      FROM documents)
    SELECT doc_id, (generate_subscripts(names, 1) - 1)::INT AS pos, unnest(names) AS name FROM lists""",
)
def manifest_from_list(spark: SparkSession, folder: str) -> DataFrame:
    return names_from_lists(spread_table(spark, folder, "documents", "doc_id"), "text", "doc_id", on_empty="skip")


@query(
    "manifest_locations",
    """
    SELECT page_id, regexp_replace(regexp_extract(url, '^https?://[^/]*/*'), '/+$', '') || '/'
           || regexp_replace(regexp_replace(url, '^https?://[^/]*', ''), '^/+', '') AS location
    FROM pages""",
)
def manifest_locations(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select(
        "page_id",
        F.regexp_extract("url", "^https?://[^/]*/*", 0).alias("base"),
        F.regexp_replace("url", "^https?://[^/]*", "").alias("name"),
    )
    return with_location(pages, F.col("base")).select("page_id", "location")


@query("safe_filename", f"WITH {NAMED_PAGES} SELECT page_id, url, name FROM named")
def safe_filename_query(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", "url", safe_filename(F.col("url")).alias("name"))


@query(
    "dataset_name",
    r"""
    SELECT doc_id, regexp_replace(regexp_replace(regexp_extract(
             '/data/' || source || '/' || regexp_extract(text, '^\S+') || '.' || lang || '.jsonl', '[^/]*$'),
             '(?s)^(\.*[^.].*)\.[^.]*$', '\1'), '[^\p{L}\p{N}_-]', '_', 'g') AS name
    FROM documents""",
)
def dataset_name_query(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(
        F.lit("/data/"),
        "source",
        F.lit("/"),
        F.regexp_extract("text", r"^\S+", 0),
        F.lit("."),
        "lang",
        F.lit(".jsonl"),
    )
    return table(spark, folder, "documents").select("doc_id", dataset_name(path).alias("name"))


@query(
    "render_default",
    "SELECT doc_id, md5(coalesce(text, '')) AS digest, length(coalesce(text, ''))::INT AS n FROM documents",
)
def render_default(spark: SparkSession, folder: str) -> DataFrame:
    rendered = render(table(spark, folder, "documents"), "default")
    return rendered.select("doc_id", F.md5("rendered").alias("digest"), F.length("rendered").alias("n"))


@query(
    "render_conversation",
    """
    SELECT conv_id,
           coalesce(string_agg(coalesce(role, '') || ': ' || coalesce(text, '') || chr(10), '' ORDER BY turn)
                    FILTER (WHERE coalesce(role, '') <> 'system'), '') AS rendered
    FROM conversations GROUP BY conv_id""",
)
def render_conversation(spark: SparkSession, folder: str) -> DataFrame:
    return render_turns(table(spark, folder, "conversations"))


def question_answers(spark: SparkSession, folder: str) -> DataFrame:
    """User turns with the assistant turn that follows them."""
    turns = table(spark, folder, "conversations")
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("question")
    )
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(answered, ["conv_id", "turn"])


@query(
    "render_qa",
    """
    SELECT q.conv_id, q.turn, 'Question: ' || coalesce(q.text, '') || chr(10) || 'Answer: '
           || coalesce(a.text, '') AS rendered
    FROM conversations q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
    WHERE q.role = 'user' AND a.role = 'assistant'""",
)
def render_qa(spark: SparkSession, folder: str) -> DataFrame:
    return render(question_answers(spark, folder), "qa").select("conv_id", "turn", "rendered")


@query(
    "render_custom",
    "SELECT doc_id, md5('[' || lang || '] ' || text || ' (' || source || ')') AS digest FROM documents",
)
def render_custom(spark: SparkSession, folder: str) -> DataFrame:
    templates = {
        "tagged": lambda: F.concat(
            F.lit("["), F.col("lang"), F.lit("] "), F.col("text"), F.lit(" ("), F.col("source"), F.lit(")")
        )
    }
    rendered = render(table(spark, folder, "documents"), "tagged", templates)
    return rendered.select("doc_id", F.md5("rendered").alias("digest"))


@query(
    "instruction_prefix",
    f"""
    SELECT doc_id, md5('Retrieve relevant passages:: ' || text) AS default_digest,
           md5('{SUBSET_INSTRUCTION}: ' || text) AS digest
    FROM documents""",
)
def instruction_prefix(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id",
        F.md5(with_instruction(text)).alias("default_digest"),
        F.md5(with_instruction(text, SUBSET_INSTRUCTION)).alias("digest"),
    )


@query("token_count", f"SELECT doc_id, len({words('text')})::INT AS n_tokens FROM documents")
def token_count_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread_table(spark, folder, "documents", "doc_id")
    return docs.select("doc_id", token_count(F.col("text")).alias("n_tokens"))


_SPLITS = """
    WITH numbered AS (SELECT url, row_number() OVER (ORDER BY url) - 1 AS p FROM pages)
    SELECT (p % 3)::INT AS split_id, p // 3 AS pos, url AS name FROM numbered"""


def _splits(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "pages").select(F.col("url").alias("name"))
    return assign_splits(names, 3)


@query("split_assignment", _SPLITS)
def split_assignment(spark: SparkSession, folder: str) -> DataFrame:
    return _splits(spark, folder)


@query("first_split", f"SELECT * FROM ({_SPLITS}) WHERE split_id = 0")
def first_split_query(spark: SparkSession, folder: str) -> DataFrame:
    return first_split(_splits(spark, folder))
