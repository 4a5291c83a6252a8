"""Files read and written."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import query, spread_table, table
from contract.conversion import documents
from contract.embedding import vector_text
from contract.sql import (
    DEFAULT_SETTING,
    ITEMS,
    NAMED_PAGES,
    PACKED,
    fold_table,
    greedy,
    hashed,
    pieces,
    sparse_text,
)
from paperloom.config import SubsetConfig
from paperloom.constants import HASH_DIM, SUBSET_INSTRUCTION
from paperloom.operators.chunking import chunk_documents, chunk_records
from paperloom.operators.convert import export_documents, item_rows
from paperloom.plans.retrieval import chunk_key, page_vectors
from paperloom.plans.subset import subset_records, write_file_subsets
from paperloom.session import scratch_path
from paperloom.sources.datasets import broken_records, concat_datasets, read_dataset, write_dataset
from paperloom.sources.documents import (
    read_documents,
    write_chunks,
    write_document_json,
    write_documents,
)
from paperloom.sources.manifest import missing_files, read_listed, scan_files
from paperloom.sources.stores import (
    collection_rows,
    collection_violations,
    read_collection,
    write_collection,
)

EXTENSIONS = ("jsonl", "json", "csv", "parquet")


def _page_files(spark: SparkSession, folder: str) -> str:
    """Raw pages as text files, one page per line."""
    path = scratch_path(spark, "pages")
    table(spark, folder, "pages").select(F.col("html").alias("value")).write.text(path)
    return path


@query("scan_glob", "SELECT sum(octet_length(encode(html)) + 1)::BIGINT AS n_bytes FROM pages")
def scan_glob(spark: SparkSession, folder: str) -> DataFrame:
    files = scan_files(spark, _page_files(spark, folder), "*.txt")
    return files.agg(F.sum("length").alias("n_bytes"))


@query(
    "scan_manifest",
    """SELECT 'read' AS status, sum(octet_length(encode(html)) + 1)::BIGINT AS n_bytes FROM pages
       UNION ALL SELECT DISTINCT regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) || '.pdf', NULL FROM pages""",
)
def scan_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder are listed beside names that no file has, one per language."""
    path = _page_files(spark, folder)
    present = scan_files(spark, path, "*.txt").select("name")
    language = F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1)
    listed = table(spark, folder, "pages").select(F.concat(language, F.lit(".pdf")).alias("name")).distinct()
    names = present.unionByName(listed)
    read = read_listed(spark, path, names).agg(
        F.lit("read").alias("status"), F.sum(F.length("content")).alias("n_bytes")
    )
    absent = missing_files(spark, path, names).select(
        F.col("name").alias("status"), F.lit(None).cast("long").alias("n_bytes")
    )
    return read.unionByName(absent)


def _round_trip(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write and read back in every format."""
    back = []
    for extension in EXTENSIONS:
        path = f"{scratch_path(spark, label)}.{extension}"
        write_dataset(df, path, extension)
        found = read_dataset(spark, path, df.schema)
        back.append(found.withColumn("format", F.lit(extension)))
    return concat_datasets(back).drop("source_pos")


_FORMATS = "(VALUES ('jsonl'), ('json'), ('csv'), ('parquet')) AS formats(format)"


@query(
    "scan_by_extension",
    f"SELECT format, doc_id, lang, md5(text) AS digest FROM documents, {_FORMATS}",
)
def scan_by_extension(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return _round_trip(spark, docs, "documents").select(
        "format", "doc_id", "lang", F.md5("text").alias("digest")
    )


@query(
    "sink_subset_roundtrip",
    f"""SELECT format, doc_id, quality, n_chars, md5(text) AS digest
        FROM documents JOIN labels USING (doc_id), {_FORMATS} WHERE quality = 1""",
)
def sink_subset_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").filter("quality = 1").select("doc_id", "quality")
    subset = table(spark, folder, "documents").join(good, "doc_id").select("doc_id", "quality", "n_chars", "text")
    return _round_trip(spark, subset, "subset").select(
        "format", "doc_id", "quality", "n_chars", F.md5("text").alias("digest")
    )


@query(
    "concat_datasets",
    """SELECT 0 AS source_pos, doc_id AS id, md5(text) AS digest FROM documents
       UNION ALL SELECT 1, item_id, md5(text) FROM benchmark
       UNION ALL SELECT 2, conv_id, md5(text) FROM conversations""",
)
def concat_datasets_query(spark: SparkSession, folder: str) -> DataFrame:
    parts = [
        table(spark, folder, name).select(F.col(key).alias("id"), F.md5("text").alias("digest"))
        for name, key in (("documents", "doc_id"), ("benchmark", "item_id"), ("conversations", "conv_id"))
    ]
    return concat_datasets(parts)


@query(
    "scan_docjson",
    f"""WITH {ITEMS}, {NAMED_PAGES}
    SELECT page_id AS doc_id, url AS source, item_idx, label, level, text FROM items JOIN named USING (page_id)""",
)
def scan_docjson(spark: SparkSession, folder: str) -> DataFrame:
    """Items of documents that went through their JSON form."""
    path = scratch_path(spark, "docjson")
    write_document_json(export_documents(documents(spark, folder)), path)
    return item_rows(read_documents(spark, path), "source")


@query(
    "doc_export",
    f"""WITH {ITEMS}, {NAMED_PAGES}
    SELECT page_id AS doc_id, name AS stem, count(*) AS n_items,
           (sum(length(CASE WHEN level > 0 THEN repeat('#', level) || ' ' || text
                WHEN label = 'list_item' THEN '- ' || text WHEN label = 'table_row' THEN '| ' || text || ' |'
                WHEN label = 'code' THEN '```' || chr(10) || text || chr(10) || '```'
                WHEN label = 'picture' THEN '![Image](' || text || ')' ELSE text END))
            + 2 * (count(*) - 1))::INT AS n_chars
    FROM items JOIN named USING (page_id) GROUP BY page_id, name""",
)
def doc_export(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "export")
    write_documents(export_documents(documents(spark, folder)), path)
    items = F.from_json("json", "items array<struct<text:string>>")["items"]
    return spark.read.parquet(path).select(
        "doc_id", "stem", F.size(items).cast("long").alias("n_items"), F.length("md").alias("n_chars")
    )


_CHUNKS = f"WITH RECURSIVE {ITEMS}, {NAMED_PAGES}, {pieces(DEFAULT_SETTING)}, {PACKED}"


@query(
    "chunk_dump",
    f"""{_CHUNKS} SELECT name || '_chunk_' || chunk_index AS chunk_id, url AS source, chunk_index, c.text,
           labels AS doc_items
    FROM chunks c JOIN named USING (page_id)""",
)
def chunk_dump(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "chunks")
    records = chunk_records(chunk_documents(documents(spark, folder)))
    write_chunks(records, path)
    return spark.read.schema(records.schema).json(path).select(
        "chunk_id", "source", "chunk_index", "text", F.array_join("metadata.doc_items", ",").alias("doc_items")
    )


@query(
    "vector_collection",
    f"""{_CHUNKS}, keyed AS (
      SELECT page_id || '#' || chunk_index AS key, substr(c.text, 1, 65535) AS text, c.text AS whole, url AS source,
             chunk_index FROM chunks c JOIN named USING (page_id)),
    {hashed('keyed', 'key', 'whole', 'd')}, vectors AS ({sparse_text('keyed', 'key', 'd')})
    SELECT key AS id, text, source, chunk_index, vector FROM keyed JOIN vectors USING (key)""",
)
def vector_collection(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "collection")
    rows = collection_rows(page_vectors(spread_table(spark, folder, "pages", "page_id")), chunk_key())
    write_collection(rows, path, HASH_DIM)
    return read_collection(spark, path).select(
        "id", "text", "source", "chunk_index", vector_text(F.col("embedding")).alias("vector")
    )


@query(
    "collection_violations",
    f"""{_CHUNKS} SELECT 'id repeated' AS rule, name || '_chunk_' || chunk_index AS id, count(*) AS n
    FROM chunks JOIN named USING (page_id) GROUP BY ALL HAVING count(*) > 1""",
)
def collection_violations_query(spark: SparkSession, folder: str) -> DataFrame:
    """Under the display ids, which follow file names, some ids repeat."""
    rows = collection_rows(page_vectors(spread_table(spark, folder, "pages", "page_id")))
    return collection_violations(rows, HASH_DIM)


@query(
    "vector_collection_cut",
    f"""{_CHUNKS} SELECT page_id || '#' || chunk_index AS id, substr(c.text, 1, 100) AS text, url AS source, chunk_index
    FROM chunks c JOIN named USING (page_id)""",
)
def vector_collection_cut(spark: SparkSession, folder: str) -> DataFrame:
    """Texts cut to a length that many of them exceed."""
    path = scratch_path(spark, "cut")
    pages = page_vectors(spread_table(spark, folder, "pages", "page_id"))
    write_collection(collection_rows(pages, chunk_key(), text_chars=100), path, HASH_DIM)
    return read_collection(spark, path).select("id", "text", "source", "chunk_index")


@query(
    "collection_rules",
    """
    WITH rows AS (
      SELECT doc_id, CASE WHEN n_chars % 11 <> 0 THEN substr(text, 1, 300) END AS id,
             CASE WHEN n_chars % 2 = 0 THEN text ELSE source END AS source FROM documents)
    SELECT 'id missing' AS rule, id, 1::BIGINT AS n FROM rows WHERE id IS NULL
    UNION ALL SELECT 'id too long', id, 1 FROM rows WHERE length(id) > 256
    UNION ALL SELECT 'source too long', id, 1 FROM rows WHERE length(source) > 1024
    UNION ALL SELECT 'embedding malformed', id, 1 FROM rows WHERE doc_id % 3 <> 1
    UNION ALL SELECT 'id repeated', id, count(*) FROM rows GROUP BY id HAVING count(*) > 1""",
)
def collection_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Documents misused as collection rows break every rule."""
    docs = table(spark, folder, "documents").select(
        F.when(F.col("n_chars") % 11 != 0, F.substring("text", 1, 300)).alias("chunk_id"),
        "text",
        F.when(F.col("n_chars") % 2 == 0, F.col("text")).otherwise(F.col("source")).alias("source"),
        F.col("doc_id").alias("chunk_index"),
        F.array_repeat(F.lit(1.0), (F.col("doc_id") % 3 + 1).cast("int")).alias("embedding"),
    )
    return collection_violations(collection_rows(docs), 2)


_ARRAYS = "SELECT doc_id, lang, md5(text) AS digest FROM documents"


@query("scan_json_arrays", _ARRAYS)
def scan_json_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in files that are one JSON array each."""

    def array_lines(batches):
        opening = "["
        for batch in batches:
            lines = [opening] + [f", {line}" for line in batch.column(0).to_pylist()]
            if opening:
                lines[:2] = [f"[{lines[1].removeprefix(', ')}"] if len(lines) > 1 else lines[:1]
            opening = ""
            yield pa.RecordBatch.from_pydict({"value": [line for line in lines if line]})
        yield pa.RecordBatch.from_pydict({"value": ["[]" if opening else "]"]})

    path = f"{scratch_path(spark, 'arrays')}.json"
    docs = spread_table(spark, folder, "documents", "doc_id").select("doc_id", "lang", "text")
    records = docs.select(F.to_json(F.struct("doc_id", "lang", "text")).alias("value"))
    records.mapInArrow(array_lines, "value string").write.text(path)
    found = read_dataset(spark, path, docs.schema)
    return found.select("doc_id", "lang", F.md5("text").alias("digest"))


@query(
    "scan_broken_lines",
    """SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN 'broken' ELSE 'read' END AS status,
              CASE WHEN doc_id % 10 <> 3 THEN md5(text) END AS digest FROM documents""",
)
def scan_broken_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that end too early are listed as they stand, the others read."""
    path = f"{scratch_path(spark, 'broken')}.jsonl"
    docs = table(spark, folder, "documents").select("doc_id", "text")
    line = F.to_json(F.struct("doc_id", "text"))
    cut = F.when(F.col("doc_id") % 10 == 3, F.concat(F.substring_index(line, ",", 1), F.lit(',"te'))).otherwise(line)
    docs.select(cut.alias("value")).write.text(path)
    read = read_dataset(spark, path, docs.schema, on_error="skip")
    read = read.select("doc_id", F.lit("read").alias("status"), F.md5("text").alias("digest"))
    broken = broken_records(spark, path, docs.schema).select(
        F.regexp_extract("record", r'"doc_id":(\d+)', 1).cast("long").alias("doc_id"),
        F.lit("broken").alias("status"),
        F.lit(None).cast("string").alias("digest"),
    )
    return read.unionByName(broken)


@query(
    "scan_docjson_string_ids",
    f"WITH {ITEMS} SELECT 'p-' || page_id AS doc_id, item_idx, label, level, text FROM items",
)
def scan_docjson_string_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "docjson")
    named = F.concat(F.lit("p-"), F.col("doc_id").cast("string"))
    write_document_json(export_documents(documents(spark, folder).withColumn("doc_id", named)), path)
    return item_rows(read_documents(spark, path, id_type="string"))


_SUBSET_SIZES = [0.05, 50]


@query(
    "subset_end_to_end",
    f"""
    WITH RECURSIVE records AS (
      SELECT lang AS dataset, doc_id, source, '{SUBSET_INSTRUCTION}: ' || text AS text FROM documents),
    {fold_table("records", "doc_id", 10, "source, text")},
    {hashed("folded", "doc_id", "text", "d")}, places AS (
      SELECT dataset, fold, doc_id, r.b FROM folded, range({HASH_DIM}) AS r(b)),
    unit AS (
      SELECT dataset, fold, doc_id, list(coalesce(x / len, 0) ORDER BY b) AS v
      FROM places LEFT JOIN d_vec USING (doc_id, b) LEFT JOIN d_len USING (doc_id) GROUP BY ALL),
    sims AS (
      SELECT a.dataset, a.fold, a.doc_id AS i, b.doc_id AS j,
             round((list_dot_product(a.v, b.v) + 1) / 2, 7) AS s
      FROM unit a JOIN unit b USING (dataset, fold)),
    {greedy("doc_id", _SUBSET_SIZES)}
    SELECT merged.dataset, size_spec, rank, doc_id AS row_id, gain, source
    FROM merged JOIN documents USING (doc_id) WHERE rank < keep""",
)
def subset_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    """Documents rendered, embedded, folded, selected, merged and joined back."""
    docs = spread_table(spark, folder, "documents", "doc_id").select(
        F.col("lang").alias("dataset"), F.col("doc_id").alias("row_id"), "text", "source"
    )
    config = SubsetConfig(sizes=_SUBSET_SIZES, num_folds=10, template="default")
    return subset_records(docs, config).select("dataset", "size_spec", "rank", "row_id", "gain", "source")


@query(
    "subset_of_files",
    f"""
    WITH RECURSIVE records AS (
      SELECT 'documents' AS dataset, row_number() OVER (ORDER BY doc_id) - 1 AS row_id, doc_id, '{SUBSET_INSTRUCTION}: ' || text AS text
      FROM documents),
    {fold_table("records", "row_id", 10, "doc_id, text")},
    {hashed("folded", "row_id", "text", "d")}, places AS (
      SELECT dataset, fold, row_id, r.b FROM folded, range({HASH_DIM}) AS r(b)),
    unit AS (
      SELECT dataset, fold, row_id, list(coalesce(x / len, 0) ORDER BY b) AS v
      FROM places LEFT JOIN d_vec USING (row_id, b) LEFT JOIN d_len USING (row_id) GROUP BY ALL),
    sims AS (
      SELECT a.dataset, a.fold, a.row_id AS i, b.row_id AS j,
             round((list_dot_product(a.v, b.v) + 1) / 2, 7) AS s
      FROM unit a JOIN unit b USING (dataset, fold)),
    {greedy("row_id", _SUBSET_SIZES)}
    SELECT merged.dataset, size_spec, rank, row_id, r.doc_id, md5(d.text) AS digest
    FROM merged JOIN records r USING (row_id) JOIN documents d USING (doc_id) WHERE rank < keep""",
)
def subset_of_files(spark: SparkSession, folder: str) -> DataFrame:
    """Raw JSON lines numbered, embedded, selected, and written by dataset and size as JSON lines again."""
    raw, out = f"{scratch_path(spark, 'raw')}/documents.jsonl", scratch_path(spark, "subsets")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    write_dataset(docs.orderBy("doc_id"), raw, "jsonl")
    config = SubsetConfig(sizes=_SUBSET_SIZES, num_folds=10, template="default")
    write_file_subsets(spark, [raw], config, out, docs.schema)
    kinds = "doc_id long, text string, row_id long, rank long, dataset string, size_spec string"
    chosen = spark.read.schema(kinds).json(f"{out}/subsets")
    return chosen.select("dataset", "size_spec", "rank", "row_id", "doc_id", F.md5("text").alias("digest"))
