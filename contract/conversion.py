"""Pages to documents and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import query, spread_table, table
from contract.sql import DEFAULT_SETTING, ITEMS, NAMED_PAGES, PACKED, items_of, pieces, words
from paperloom.config import ConvertConfig
from paperloom.functions.images import picture_markdown
from paperloom.operators import chunking as ch
from paperloom.operators.confidence import document_confidence, low_pages, rollup, text_score
from paperloom.operators.convert import (
    convert_pages,
    converted,
    export_documents,
    item_rows,
    rejects,
    shared_stems,
)
from paperloom.plans.retrieval import export_corpus

SPLIT_TOKENS = 48
_SPLIT = f"('split', {SPLIT_TOKENS}, false)"
_MERGE = f"('merge', {SPLIT_TOKENS}, true)"
_STUDY = "('default', 512, true), ('no_merge', 512, false), ('small', 128, true)"
_CHUNK_COLUMNS = "page_id AS doc_id, chunk_index, text, coalesce(heading, '') AS headings, tokens::INT AS n_tokens"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return converted(convert_pages(spread_table(spark, folder, "pages", "page_id")))


@query("html_items", f"WITH {ITEMS} SELECT page_id AS doc_id, item_idx, label, level, text FROM items")
def html_items_query(spark: SparkSession, folder: str) -> DataFrame:
    return item_rows(documents(spark, folder))


_HARD = (
    "<p>caf&eacute; &#8217;s &#x1F600; a < b & c > d &bogus; &amp;lt; &#0; &#xD800; &nbsp;&#160; x &copy 5 &frac12;</p>"
    "<img alt='x' src='a b.png'><IMG src = c.png><img src=\"d&amp;e.png\"><h2>1 <2</h2>"
)


@query(
    "html_references",
    f"""WITH {items_of("html || '" + _HARD.replace("'", "''") + "'")}
    SELECT page_id AS doc_id, item_idx, label, level, text FROM items""",
)
def html_references(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that end with references by name and number, lone brackets, and pictures in other quotes."""
    pages = spread_table(spark, folder, "pages", "page_id").withColumn("html", F.concat("html", F.lit(_HARD)))
    return item_rows(converted(convert_pages(pages)))


_MARKDOWN = f"""
marked AS (
  SELECT page_id, string_agg(
    CASE WHEN level > 0 THEN repeat('#', level) || ' ' || text
         WHEN label = 'list_item' THEN '- ' || text
         WHEN label = 'table_row' THEN '| ' || text || ' |'
         WHEN label = 'code' THEN '```' || chr(10) || text || chr(10) || '```'
         WHEN label = 'picture' THEN '![Image](' || text || ')' ELSE text END,
    chr(10) || chr(10) ORDER BY item_idx) AS md
  FROM items GROUP BY page_id)"""


@query(
    "doc_markdown",
    f"""WITH {ITEMS}, {NAMED_PAGES}, {_MARKDOWN}
    SELECT page_id AS doc_id, name AS stem, md FROM marked JOIN named USING (page_id)""",
)
def doc_markdown(spark: SparkSession, folder: str) -> DataFrame:
    return export_documents(documents(spark, folder)).select("doc_id", "stem", "md")


@query(
    "embedded_pictures",
    f"""WITH {ITEMS}, shown AS (
      SELECT * REPLACE (CASE WHEN label = 'picture' AND length(text) % 2 = 1
             THEN 'data:image/png;base64,' || to_base64(encode(upper(text))) ELSE text END AS text) FROM items),
    {_MARKDOWN.replace("FROM items", "FROM shown")}, counted AS (
      SELECT page_id, count(*) FILTER (label = 'picture' AND length(text) % 2 = 1)::INT AS n_images FROM items GROUP BY page_id)
    SELECT page_id AS doc_id, md, n_images FROM marked JOIN counted USING (page_id)""",
)
def embedded_pictures(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold the bytes of those pictures that have some, in Markdown and in JSON."""
    pages = spread_table(spark, folder, "pages", "page_id")
    address = F.col("text")
    pictures = item_rows(documents(spark, folder)).filter((F.col("label") == "picture") & (F.length(address) % 2 == 1))
    pictures = pictures.select(address.alias("uri"), F.encode(F.upper(address), "UTF-8").alias("content")).distinct()
    shown = export_corpus(pages, ConvertConfig("embedded"), pictures)
    items = F.from_json("json", "items array<struct<image:string>>")["items"]
    n_images = F.size(F.filter(items, lambda item: item["image"].isNotNull()))
    return shown.select("doc_id", "md", n_images.alias("n_images"))


@query(
    "doc_json",
    f"""WITH {ITEMS}, {NAMED_PAGES}, lists AS (
      SELECT page_id, list({{'label': label, 'level': level, 'text': text}} ORDER BY item_idx) AS items
      FROM items GROUP BY page_id)
    SELECT page_id AS doc_id,
           to_json({{'doc_id': page_id, 'source': url, 'name': name, 'items': items}})::VARCHAR AS json
    FROM lists JOIN named USING (page_id)""",
)
def doc_json(spark: SparkSession, folder: str) -> DataFrame:
    return export_documents(documents(spark, folder)).select("doc_id", "json")


@query(
    "doc_shared_stems",
    f"""WITH {ITEMS}, {NAMED_PAGES}
    SELECT name AS stem, count(*) AS n_docs FROM named
    WHERE page_id IN (SELECT page_id FROM items) GROUP BY name HAVING count(*) > 1""",
)
def doc_shared_stems(spark: SparkSession, folder: str) -> DataFrame:
    return shared_stems(export_documents(documents(spark, folder)))


@query(
    "image_export_mode",
    """
    SELECT page_id, 'embedded' AS mode,
           md5('![Image](data:image/png;base64,' || to_base64(encode(html)) || ')') AS digest FROM pages
    UNION ALL SELECT page_id, 'placeholder', md5('<!-- image -->') FROM pages
    UNION ALL SELECT page_id, 'referenced', md5('![Image](' || url || ')') FROM pages""",
)
def image_export_mode(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    modes = F.array(
        *[
            F.struct(
                F.lit(mode).alias("mode"),
                F.md5(picture_markdown(mode, F.col("url"), F.encode("html", "UTF-8"))).alias("digest"),
            )
            for mode in ("embedded", "placeholder", "referenced")
        ]
    )
    return pages.select("page_id", F.inline(modes))


@query(
    "convert_rejects",
    f"""WITH {ITEMS}, raw AS (
      SELECT doc_id + 1000000 AS page_id, text AS url, NULL::VARCHAR AS html FROM documents
      WHERE doc_id NOT IN (SELECT doc_id FROM labels))
    SELECT page_id AS doc_id, url AS source,
           CASE WHEN html IS NULL THEN 'no content' ELSE 'no items' END AS status
    FROM (SELECT page_id, url, html FROM pages WHERE page_id NOT IN (SELECT page_id FROM items)
          UNION ALL SELECT * FROM raw)""",
)
def convert_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Pages beside entries without content: the documents that no one labelled."""
    unlabelled = (
        table(spark, folder, "documents")
        .join(table(spark, folder, "labels"), "doc_id", "left_anti")
        .select(
            (F.col("doc_id") + 1000000).alias("page_id"),
            F.col("text").alias("url"),
            F.lit(None).cast("string").alias("html"),
        )
    )
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return rejects(convert_pages(pages.unionByName(unlabelled)))


@query(
    "item_headings",
    f"""WITH {ITEMS}, {pieces("('structure', 2147483647, false)")}
    SELECT page_id AS doc_id, p AS chunk_index, label, text, coalesce(heading, '') AS headings FROM pieces""",
)
def item_headings(spark: SparkSession, folder: str) -> DataFrame:
    return ch.structural_chunks(documents(spark, folder)).select(
        "doc_id",
        "chunk_index",
        F.array_join("doc_items", ",").alias("label"),
        "text",
        F.array_join("headings", " > ").alias("headings"),
    )


def _shown(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        "doc_id", "chunk_index", "text", F.array_join("headings", " > ").alias("headings"), "n_tokens"
    )


@query(
    "chunk_split",
    f"""WITH {ITEMS}, {pieces(_SPLIT)}
    SELECT page_id AS doc_id, p AS chunk_index, text, coalesce(heading, '') AS headings, size::INT AS n_tokens
    FROM pieces""",
)
def chunk_split(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(ch.chunk_documents(documents(spark, folder), SPLIT_TOKENS, merge_peers=False))


@query(
    "chunk_no_merge",
    f"""WITH {ITEMS}, {pieces("('whole', 1024, false)")}
    SELECT page_id AS doc_id, p AS chunk_index, text, coalesce(heading, '') AS headings, size::INT AS n_tokens
    FROM pieces""",
)
def chunk_no_merge(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(ch.chunk_documents(documents(spark, folder), merge_peers=False))


@query(
    "chunk_merge",
    f"WITH RECURSIVE {ITEMS}, {pieces(_MERGE)}, {PACKED} SELECT {_CHUNK_COLUMNS} FROM chunks",
)
def chunk_merge(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(ch.chunk_documents(documents(spark, folder), SPLIT_TOKENS))


@query(
    "chunk_records",
    f"""WITH RECURSIVE {ITEMS}, {NAMED_PAGES}, {pieces(DEFAULT_SETTING)}, {PACKED}
    SELECT page_id AS doc_id, name || '_chunk_' || chunk_index AS chunk_id, c.text, url AS source, chunk_index,
           labels AS doc_items, coalesce(heading, '') AS headings, len({words("c.text")})::INT AS token_count
    FROM chunks c JOIN named USING (page_id)""",
)
def chunk_records(spark: SparkSession, folder: str) -> DataFrame:
    records = ch.chunk_records(ch.chunk_documents(documents(spark, folder)))
    return records.select(
        "doc_id",
        "chunk_id",
        "text",
        "source",
        "chunk_index",
        F.array_join("metadata.doc_items", ",").alias("doc_items"),
        F.array_join("metadata.headings", " > ").alias("headings"),
        F.col("metadata.token_count").alias("token_count"),
    )


@query(
    "chunk_contextualized",
    f"""WITH RECURSIVE {ITEMS}, {pieces(_MERGE)}, {PACKED}
    SELECT page_id AS doc_id, chunk_index, concat_ws(chr(10), heading, text) AS context FROM chunks""",
)
def chunk_contextualized(spark: SparkSession, folder: str) -> DataFrame:
    chunks = ch.chunk_documents(documents(spark, folder), SPLIT_TOKENS)
    return chunks.select("doc_id", "chunk_index", ch.contextualized().alias("context"))


def _study(spark: SparkSession, folder: str) -> DataFrame:
    settings = {"default": (512, True), "no_merge": (512, False), "small": (128, True)}
    return ch.compare_settings(documents(spark, folder), settings)


@query(
    "chunk_stats",
    f"""WITH RECURSIVE {ITEMS}, {pieces(_STUDY)}, {PACKED}
    SELECT page_id AS doc_id, setting, count(*) AS n_chunks,
           round(avg(heading_tokens + tokens), 6) AS mean_tokens
    FROM chunks GROUP BY ALL""",
)
def chunk_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = ch.chunk_statistics(_study(spark, folder), "setting")
    return stats.withColumn("mean_tokens", F.round("mean_tokens", 6))


@query(
    "chunk_samples",
    f"""WITH RECURSIVE {ITEMS}, {pieces(_STUDY)}, {PACKED}, full_text AS (
      SELECT *, concat_ws(chr(10), heading, text) AS context FROM chunks WHERE chunk_index < 3)
    SELECT page_id AS doc_id, setting, chunk_index, (heading_tokens + tokens)::INT AS n_tokens,
           CASE WHEN length(context) > 200 THEN substr(context, 1, 200) || '...' ELSE context END AS sample
    FROM full_text""",
)
def chunk_samples(spark: SparkSession, folder: str) -> DataFrame:
    return ch.chunk_samples(_study(spark, folder), 3, "setting")


@query(
    "corpus_totals",
    f"""WITH RECURSIVE {ITEMS}, {pieces(DEFAULT_SETTING)}, {PACKED}
    SELECT (SELECT count(DISTINCT page_id) FROM items) AS n_documents, count(DISTINCT page_id) AS n_chunked,
           count(*) AS n_chunks, sum(tokens)::BIGINT AS n_tokens FROM chunks""",
)
def corpus_totals(spark: SparkSession, folder: str) -> DataFrame:
    return ch.corpus_totals(ch.pack_documents(documents(spark, folder)))


_SCORES = r"""
scores AS (
  SELECT page_id AS doc_id, item_idx,
         length(regexp_replace(text, '[^\p{L}\p{N} ]', '', 'g'))::DOUBLE / length(text) AS score
  FROM items),
means AS (SELECT doc_id, count(*) AS n_pages, avg(score) AS mean_score FROM scores GROUP BY doc_id)"""


def _confidence(spark: SparkSession, folder: str) -> DataFrame:
    """Confidence from item scores, which stand in for the pages of a document."""
    scores = F.transform("items", lambda item: text_score(item["text"]))
    return document_confidence(documents(spark, folder), scores)


@query(
    "confidence_rollup",
    f"""WITH {ITEMS}, {_SCORES}
    SELECT doc_id, n_pages, round(mean_score, 6) AS mean_score,
           CASE WHEN mean_score < 0.5 THEN 'poor' WHEN mean_score < 0.8 THEN 'fair'
                WHEN mean_score < 0.9 THEN 'good' ELSE 'excellent' END AS mean_grade
    FROM means""",
)
def confidence_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return _confidence(spark, folder).select(
        "doc_id", "n_pages", F.round("mean_score", 6).alias("mean_score"), "mean_grade"
    )


@query(
    "low_score_pages",
    f"""WITH {ITEMS}, {_SCORES}
    SELECT doc_id, (item_idx + 1)::INT AS low_page, round(score, 6) AS low_score
    FROM scores JOIN means USING (doc_id) WHERE round(score, 9) < round(mean_score, 9)
    UNION ALL
    SELECT doc_id, NULL, NULL FROM means m WHERE NOT EXISTS (
      SELECT 1 FROM scores s WHERE s.doc_id = m.doc_id AND round(s.score, 9) < round(m.mean_score, 9))""",
)
def low_score_pages(spark: SparkSession, folder: str) -> DataFrame:
    low = _confidence(spark, folder).select("doc_id", F.explode_outer("low_pages").alias("low"))
    return low.select(
        "doc_id", F.col("low.page").alias("low_page"), F.round("low.score", 6).alias("low_score")
    )


def _event_scores(spark: SparkSession, folder: str) -> DataFrame:
    """A table of scores with one row per event; users stand in for documents."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("doc_id"), F.col("event_id").alias("page_no"), F.col("value").alias("score")
    )


@query(
    "confidence_rollup_table",
    """SELECT user_id AS doc_id, count(value) AS n_pages, round(avg(value), 6) AS mean_score,
              CASE WHEN avg(value) < 0.5 THEN 'poor' WHEN avg(value) < 0.8 THEN 'fair'
                   WHEN avg(value) < 0.9 THEN 'good' ELSE 'excellent' END AS mean_grade
       FROM events GROUP BY user_id""",
)
def confidence_rollup_table(spark: SparkSession, folder: str) -> DataFrame:
    return rollup(_event_scores(spark, folder)).withColumn("mean_score", F.round("mean_score", 6))


@query(
    "low_score_table",
    """WITH means AS (
         SELECT user_id, round(avg(value), 9) AS mean_score, round(min(value), 9) AS least FROM events GROUP BY user_id)
       SELECT user_id AS doc_id, event_id + 1 AS low_page, round(value, 6) AS low_score
       FROM events JOIN means USING (user_id) WHERE round(value, 9) < mean_score
       UNION ALL SELECT user_id, NULL, NULL FROM means WHERE least >= mean_score""",
)
def low_score_table(spark: SparkSession, folder: str) -> DataFrame:
    return low_pages(_event_scores(spark, folder)).withColumn("low_score", F.round("low_score", 6))
