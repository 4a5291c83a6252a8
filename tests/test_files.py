"""Files as people have them: arrays and broken lines, large CSV, raw records to subsets, collections that are replaced."""

import json
import os

import pytest
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.config import ChunkConfig, ConvertConfig, SubsetConfig
from paperloom.operators import embedding as em
from paperloom.operators.convert import attach_pictures, export_documents
from paperloom.operators.splits import assign_splits
from paperloom.plans import retrieval, subset
from paperloom.sources import datasets, documents, stores

SCHEMA = "id long, text string"


def test_json_arrays_and_lines_side_by_side(spark, tmp_path):
    records = [{"id": i, "text": f"t{i}"} for i in range(6)]
    folder = tmp_path / "a b+c.json"
    folder.mkdir()
    (folder / "array one.json").write_text("\n  " + json.dumps(records[:2], indent=1))
    (folder / "one_line.json").write_text(json.dumps(records[2:4]))
    (folder / "lines.json").write_text("\n".join(map(json.dumps, records[4:])))
    paths = [str(folder)]
    for schema in (None, SCHEMA):
        found = datasets.read_dataset(spark, paths, schema).select("id", "text")
        assert sorted(map(tuple, found.collect())) == [(i, f"t{i}") for i in range(6)]
    assert {r.dataset for r in datasets.read_datasets(spark, paths).collect()} == {"a_b_c"}


@pytest.mark.parametrize("schema", [None, SCHEMA])
def test_broken_records_are_errors_or_listed(spark, tmp_path, schema):
    (tmp_path / "x.jsonl").write_text('{"id": 1, "text": "a"}\n{"id": 2, "te\n{"id": 3, "text": "c"}\n')
    path = f"{tmp_path}/x.jsonl"
    with pytest.raises(Exception):
        datasets.read_dataset(spark, path, schema).collect()
    found = datasets.read_dataset(spark, path, schema, on_error="skip")
    assert found.count() == 2
    assert found.columns == ["id", "text"] and sorted(r.id for r in found.collect()) == [1, 3]
    broken = datasets.broken_records(spark, path, schema).collect()
    assert [r.record for r in broken] == ['{"id": 2, "te'] and broken[0].file.endswith("x.jsonl")
    with pytest.raises(ValueError):
        datasets.read_dataset(spark, path, on_error="hide")


def test_csv_is_split_where_records_end_with_lines(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("id,text\n" + "".join(f'{i},"say ""{i}"", please"\n' for i in range(40_000)))
    (tmp_path / "breaks.csv").write_text('id,text\n1,"two\nlines"\n2,x\n')
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        plain = datasets.read_dataset(spark, f"{tmp_path}/plain.csv", SCHEMA)
        assert plain.rdd.getNumPartitions() > 5
        assert plain.count() == 40_000 and plain.filter("id = 7").first().text == 'say "7", please'
        both = datasets.read_dataset(spark, [f"{tmp_path}/plain.csv", f"{tmp_path}/breaks.csv"], SCHEMA)
        assert both.rdd.getNumPartitions() > 5 and both.count() == 40_002
        assert both.filter("text = 'two\nlines'").count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


@pytest.mark.parametrize("extension", ["jsonl", "json", "csv", "parquet"])
def test_numbers_follow_the_files(spark, tmp_path, extension):
    for part in range(3):
        rows = spark.createDataFrame([(100 * part + i, f"row {i}") for i in range(30)], SCHEMA).coalesce(1)
        datasets.write_dataset(rows, f"{tmp_path}/in{part}.{extension}", extension)
    paths = [f"{tmp_path}/in{part}.{extension}" for part in range(3)]
    schema = None if extension == "parquet" else SCHEMA
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    try:
        apart = datasets.read_numbered(spark, paths, schema=schema).orderBy("id").collect()
        together = datasets.read_numbered(spark, paths, combine=True, schema=schema).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert [(r.dataset, r.row_id) for r in apart] == [(f"in{r.id // 100}", r.id % 100) for r in apart]
    assert {r.dataset for r in together} == {C.COMBINED_DATASET_NAME}
    assert [r.row_id for r in together] == list(range(90))
    with pytest.raises(ValueError, match="listed twice"):
        datasets.read_numbered(spark, [paths[0], paths[0]])


def test_many_inputs_are_one_scan(spark, tmp_path):
    for part in range(4):
        spark.range(3).write.parquet(f"{tmp_path}/p{part}.parquet")
    found = datasets.read_datasets(spark, [f"{tmp_path}/p{i}.parquet" for i in range(4)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and found.count() == 12
    spark.range(3).selectExpr("cast(id as int) id").write.parquet(f"{tmp_path}/other.parquet")
    with pytest.raises(ValueError, match="another schema"):
        datasets.read_datasets(spark, [f"{tmp_path}/p0.parquet", f"{tmp_path}/other.parquet"])


@pytest.mark.parametrize("extension,combine", [("jsonl", False), ("csv", False), ("parquet", True)])
def test_subsets_of_raw_files(spark, tmp_path, extension, combine):
    for name, count in (("small", 12), ("large", 30)):
        rows = spark.createDataFrame([(i, f"{name} word{i % 5} word{i % 3}, \"{i}\"") for i in range(count)], SCHEMA)
        datasets.write_dataset(rows, f"{tmp_path}/{name}.{extension}", extension)
    paths = [f"{tmp_path}/{n}.{extension}" for n in ("small", "large")]
    config = SubsetConfig(sizes=[0.5, 3], num_folds=2, combine=combine, template="default")
    schema = None if extension == "parquet" else SCHEMA
    subset.write_file_subsets(spark, paths, config, f"{tmp_path}/out", schema)
    expected = {"combined_dataset": (21, 3)} if combine else {"small": (6, 3), "large": (15, 3)}
    for dataset, counts in expected.items():
        for size, count in zip(("percent_0.5", "samples_3"), counts):
            folder = f"{tmp_path}/out/subsets/dataset={dataset}/size_spec={size}"
            kind = datasets.file_format(f".{extension}")
            assert any(f.endswith(f".{kind}") for f in os.listdir(folder))
            reader = spark.read.option("header", True).option("escape", '"') if kind == "csv" else spark.read
            written = getattr(reader, kind)(folder)
            assert written.count() == count and set(written.columns) == {"id", "text", "row_id", "rank"}
            assert sorted(int(r["rank"]) for r in written.collect()) == list(range(count))


def test_skipped_datasets_give_a_warning(spark, tmp_path):
    rows = [("d", i, f"word{i}") for i in range(6)] + [("none", i, None) for i in range(4)]
    df = spark.createDataFrame(rows, "dataset string, row_id long, text string")
    config = SubsetConfig(sizes=[2], num_folds=1, template="plain", templates={"plain": lambda: F.col("text")})
    with pytest.warns(UserWarning, match="dataset none is skipped: none of its 4 rows"):
        subset.write_subsets(df, config, str(tmp_path))
    assert os.listdir(f"{tmp_path}/subsets") and not os.path.exists(f"{tmp_path}/subsets/dataset=none")


def collection(spark, ids, dim=2):
    rows = [(i, "t", "s", 0, [1.0] * dim) for i in ids]
    return stores.collection_rows(spark.createDataFrame(rows, "chunk_id string, text string, source string, chunk_index long, embedding array<float>"))


def test_a_collection_is_written_once_and_replaced_at_once(spark, tmp_path):
    path = f"{tmp_path}/c"
    computed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    rows = collection(spark, ["a", "b"])
    stores.write_collection(rows.mapInArrow(counted, rows.schema), path, 2)
    assert computed.value == 2
    reader = stores.read_collection(spark, path)
    stores.write_collection(collection(spark, ["c"]), path, 2)
    assert sorted(r.id for r in reader.collect()) == ["a", "b"]
    assert [r.id for r in stores.read_collection(spark, path).collect()] == ["c"]
    with pytest.raises(ValueError, match="embedding malformed.*'id': 'x'"):
        stores.write_collection(collection(spark, ["x"], 3), path, 2)
    with pytest.raises(ValueError, match="id repeated"):
        stores.write_collection(collection(spark, ["y", "y"]), path, 2)
    assert [r.id for r in stores.read_collection(spark, path).collect()] == ["c"]
    stores.write_collection(collection(spark, ["e", "f"]).withColumn("cell", F.lit(3)), path, 2, cell="cell")
    assert stores.read_collection(spark, path).filter("cell = 3").count() == 2


def test_texts_are_fetched_late(spark, tmp_path):
    keyed = em.content_key(spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None)], SCHEMA), "id", "text", "hash")
    found = em.embed_missing(keyed, None)
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    stores.append_vectors(found, f"{tmp_path}/v")
    assert em.embed_missing(keyed.filter("row_id IS NOT NULL"), stores.read_vectors(spark, f"{tmp_path}/v")).count() == 0


def test_documents_with_string_ids(spark, tmp_path):
    docs = spark.createDataFrame(
        [("p-1", "s", "n", [("text", 0, "x")])],
        "doc_id string, source string, name string, items array<struct<label:string,level:int,text:string>>",
    )
    documents.write_document_json(export_documents(docs), f"{tmp_path}/d")
    assert documents.read_documents(spark, f"{tmp_path}/d", id_type="string").first().doc_id == "p-1"
    with pytest.raises(Exception):
        documents.read_documents(spark, f"{tmp_path}/d").collect()


def test_embedded_pictures(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "u1", '<p>a</p><img src="x.png"><img src="y.png"><p>b</p>'), (2, "u2", '<img src="x.png">'), (3, "u3", "<p>c</p>")],
        "page_id long, url string, html string",
    )
    pictures = spark.createDataFrame([("x.png", bytearray(b"xx")), ("x.png", bytearray(b"zz")), ("y.png", None)], "uri string, content binary")
    found = {r.doc_id: r for r in retrieval.export_corpus(pages, ConvertConfig("embedded"), pictures).collect()}
    inline = "data:image/png;base64,eHg="
    assert found[1].md == f"a\n\n![Image]({inline})\n\n![Image](y.png)\n\nb"
    assert [i.get("image") for i in json.loads(found[1].json)["items"]] == [None, inline, None, None]
    assert found[2].md == f"![Image]({inline})" and found[3].md == "c"
    rows = spark.createDataFrame([(r.json,) for r in found.values()], "value string")
    rows.write.text(f"{tmp_path}/j")
    back = documents.read_documents(spark, f"{tmp_path}/j", images=True).filter("doc_id = 2").first()
    assert back["items"][0].image == inline
    linked = retrieval.export_corpus(pages, ConvertConfig("referenced"), pictures).filter("doc_id = 2").first()
    assert linked.md == "![Image](x.png)"
    docs = retrieval.convert_corpus(pages)
    assert attach_pictures(docs, pictures.filter("false")).filter("pictures IS NOT NULL").count() == 0


def test_settings_reach_their_operators(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a b c</p>"), (2, "v", None)], "page_id long, url string, html string")
    assert retrieval.convert_corpus(pages).count() == 1
    with pytest.raises(Exception, match="cannot convert document 2"):
        retrieval.convert_corpus(pages, ConvertConfig(on_error="strict")).collect()
    names = spark.createDataFrame([(n,) for n in "abcde"], "name string")
    assert retrieval.listed_splits(names, ConvertConfig(num_splits=2)).agg(F.max("split_id")).first()[0] == 1
    rows = spark.createDataFrame([(str(i), "t", "s", 0, [1.0] * C.HASH_DIM) for i in range(4)], "id string, text string, source string, chunk_index long, embedding array<float>")
    asked = spark.createDataFrame([(1, "t")], "query_id int, text string")
    assert retrieval.semantic_search(rows, asked, config=ChunkConfig(top_k=3)).count() == 3
    assert retrieval.semantic_search(rows, asked, k=2, config=ChunkConfig(top_k=3)).count() == 2


def test_repeated_names_are_dealt_whole(spark):
    names = spark.createDataFrame([("hot", i % 3) for i in range(50)] + [("a", 0), ("z", 0)], "name string, extra int").repartition(4)
    rows = assign_splits(names, 4).collect()
    assert sorted((r.pos, r.split_id) for r in rows) == [(p // 4, p % 4) for p in range(52)]
    ordered = sorted(rows, key=lambda r: (r.pos, r.split_id))
    assert [r.name for r in ordered] == ["a"] + ["hot"] * 50 + ["z"]


@pytest.mark.parametrize("style", ["before", "after", "opening", "pretty", "one line"])
def test_json_arrays_are_split_where_lines_hold_records(spark, tmp_path, style):
    records = [{"id": i, "text": text} for i, text in enumerate(['a, "b"}', "[\\", "\u2028 ]", None, "{,", "\n,\n"] * 40)]
    lines = [json.dumps(r) for r in records]
    lines = [", ".join(lines[i : i + 2]) for i in range(0, len(lines), 2)]
    text = {
        "before": "\ufeff[" + "\n , ".join(lines) + "]\n",
        "after": "[" + ",\r\n\r\n".join(lines) + " ]",
        "opening": "\n[\n" + ",\n".join(lines) + "\n]\n",
        "pretty": json.dumps(records, indent=1),
        "one line": json.dumps(records),
    }[style]
    (tmp_path / "x.json").write_text(text, encoding="utf-8")
    path, schema = f"{tmp_path}/x.json", "id long, text string"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = datasets.read_dataset(spark, path, schema)
        tasks = found.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.id, r.text) for r in found.collect()) == [(r["id"], r["text"]) for r in records]
    assert (tasks > 1) == (style in ("before", "after", "opening"))


@pytest.mark.parametrize("text", ['[{"id": 1}\n{"id": 2}]', '[{"id": 1},\n{"id": 2]', '[{"id": 1},\n{"id": x}]', '[{"id": 1},\n,{"id": 2}]'])
def test_broken_arrays_are_errors(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception):
        datasets.read_dataset(spark, f"{tmp_path}/x.json", "id long").collect()
