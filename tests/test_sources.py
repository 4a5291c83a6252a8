import datetime
import json
import os
from dataclasses import dataclass
from typing import Optional

import pytest
from pyspark.sql import functions as F

from paperloom.config import ChunkConfig, ConvertConfig, SubsetConfig
from paperloom.operators import extraction as ex
from paperloom.plans import subset
from paperloom.session import materialized, scratch_path, shared_dir
from paperloom.sources import datasets, manifest, stores
from paperloom.streaming.ingest import start_ingest, stream_pages

TEXTS = ['plain', 'line\nbreak, comma', 'quote " inside', 'back\\slash', 'é ü 日本']


def records(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")


def test_name_lists(spark):
    df = spark.createDataFrame([(1, "a.pdf, ,b.pdf,"), (2, "\u00a0c.pdf\n")], "i int, names string")
    rows = manifest.names_from_lists(df, "names", "i").collect()
    assert {tuple(r) for r in rows} == {(1, 0, "a.pdf"), (1, 1, "b.pdf"), (2, 0, "c.pdf")}
    empty = spark.createDataFrame([(1, " , ")], "i int, names string")
    with pytest.raises(Exception, match="at least one name"):
        manifest.names_from_lists(empty, "names").collect()
    assert manifest.names_from_lists(empty, "names", on_empty="skip").count() == 0
    located = manifest.with_location(manifest.names_from_lists(df, "names"), "s3a://b/")
    assert sorted(r.location for r in located.collect()) == ["s3a://b/a.pdf", "s3a://b/b.pdf", "s3a://b/c.pdf"]
    with pytest.raises(ValueError):
        manifest.with_location(df, "")


def test_listed_files(spark, tmp_path):
    for name in ("a.pdf", "b.pdf", "note.txt"):
        (tmp_path / name).write_bytes(name.encode())
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.pdf").write_bytes(b"c")
    assert sorted(r.name for r in manifest.scan_files(spark, str(tmp_path)).collect()) == ["a.pdf", "b.pdf"]
    names = spark.createDataFrame([("a.pdf",), ("a.pdf",), ("gone.pdf",)], "name string")
    assert [(r.name, bytes(r.content)) for r in manifest.read_listed(spark, str(tmp_path), names).collect()] == [
        ("a.pdf", b"a.pdf")
    ]
    assert {r.name for r in manifest.missing_files(spark, str(tmp_path), names).collect()} == {"gone.pdf"}
    assert manifest.read_listed(spark, str(tmp_path), names.filter("name = 'gone.pdf'")).count() == 0


def test_long_lists_filter_a_scan(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "_MAX_LISTED", 1)
    for name in ("a.pdf", "b.pdf", "c.pdf"):
        (tmp_path / name).write_bytes(name.encode())
    names = spark.createDataFrame([("a.pdf",), ("b.pdf",)], "name string")
    assert sorted(r.name for r in manifest.read_listed(spark, str(tmp_path), names).collect()) == ["a.pdf", "b.pdf"]


@pytest.mark.parametrize("extension", ["json", "jsonl", "csv", "parquet"])
def test_round_trip(spark, tmp_path, extension):
    df = records(spark)
    path = f"{tmp_path}/records.{extension}"
    datasets.write_dataset(df, path, extension)
    assert sorted(datasets.read_dataset(spark, path, df.schema).collect()) == sorted(df.collect())
    if extension != "csv":
        inferred = datasets.read_dataset(spark, path).select("id", "text")
        assert sorted(inferred.collect()) == sorted(df.collect())


def test_formats_are_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown data format"):
        datasets.write_dataset(records(spark), f"{tmp_path}/x.txt", "txt")
    with pytest.raises(ValueError, match="share a format"):
        datasets.read_dataset(spark, ["a.csv", "b.json"])


def test_combining(spark, tmp_path):
    df = records(spark)
    both = datasets.concat_datasets([df, df])
    assert both.count() == 10 and {r.source_pos for r in both.collect()} == {0, 1}
    with pytest.raises(ValueError, match="another schema"):
        datasets.concat_datasets([df, df.withColumn("id", F.col("id").cast("int"))])
    with pytest.raises(ValueError):
        datasets.concat_datasets([])
    for name in ("one a", "two"):
        datasets.write_dataset(df, f"{tmp_path}/{name}.parquet", "parquet")
    paths = [f"{tmp_path}/{n}.parquet" for n in ("one a", "two")]
    apart = datasets.read_datasets(spark, paths)
    assert {r.dataset for r in apart.collect()} == {"one_a", "two"}
    assert {r.dataset for r in datasets.read_datasets(spark, paths, combine=True).collect()} == {"combined_dataset"}


def test_spread_leaves_large_inputs_alone(spark):
    wide = spark.range(100).repartition(9)
    assert datasets.spread(wide, "id") is wide
    assert datasets.spread(spark.range(100).coalesce(1), "id").rdd.getNumPartitions() == 4


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured in shared_dir(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    stored = materialized(records(spark))
    assert sorted(stored.collect()) == sorted(records(spark).collect())
    assert all(configured in f for f in stored.inputFiles())


@dataclass
class Reading:
    """Five fields of five kinds, two of them required."""

    taken: datetime.date
    station: int
    usable: bool = True
    depth: Optional[float] = None
    crew: str = "night shift"


READINGS = [
    (1, "2021-03-04 station 17 depth 2.25m usable=false crew: Ada"),
    (2, "station 18 depth deep usable=perhaps"),
    (3, "2021-13-40 station x usable=true"),
    (4, ""),
]
PATTERNS = {
    "usable": r"usable=(\w+)",
    "station": r"station (\w+)",
    "crew": r"crew: (\w+)",
    "taken": r"(\d{4}-\d\d-\d\d)",
    "depth": r"depth ([^m ]+)",
}
DAY = datetime.date(2021, 3, 4)


def extracted(spark, template, fields=tuple(PATTERNS)):
    df = spark.createDataFrame(READINGS, "i int, text string")
    finders = ex.pattern_finders(F.col("text"), {f: PATTERNS[f] for f in fields})
    rows = ex.extract_fields(df, template, finders, "i").orderBy("i").collect()
    return [tuple(r)[1:] for r in rows]


def test_string_and_dict_templates(spark):
    kinds = {"usable": "bool", "taken": "date", "depth": "str"}
    expected = [(False, DAY, "2.25", []), (None, None, "deep", []), (True, None, None, []), (None, None, None, [])]
    assert extracted(spark, json.dumps(kinds), tuple(kinds)) == expected
    assert extracted(spark, kinds, tuple(kinds)) == expected


def test_model_template(spark):
    assert extracted(spark, Reading) == [
        (DAY, 17, False, 2.25, "Ada", []),
        (None, 18, True, None, "night shift", ["taken"]),
        (None, None, True, None, "night shift", ["taken", "station"]),
        (None, None, True, None, "night shift", ["taken", "station"]),
    ]


def test_instance_template(spark):
    start = datetime.date(1999, 1, 1)
    assert extracted(spark, Reading(start, -1, usable=False, crew="")) == [
        (DAY, 17, False, 2.25, "Ada", []),
        (start, 18, False, None, "", []),
        (start, -1, True, None, "", []),
        (start, -1, False, None, "", []),
    ]


def test_json_documents_and_errors(spark):
    df = spark.createDataFrame([('{"a": "5", "b": true}',), ("broken",), (None,)], "doc string").coalesce(1)
    finders = ex.json_finders(F.col("doc"), {"n": "a", "flag": "b"})
    rows = ex.extract_fields(df, {"n": "int", "flag": "bool"}, finders).collect()
    assert [(r.n, r.flag) for r in rows] == [(5, True), (None, None), (None, None)]
    with pytest.raises(ValueError, match="unknown type"):
        ex.template_fields({"a": "decimal"})
    with pytest.raises(ValueError, match="unknown fields"):
        ex.extract_fields(df, {"n": "int"}, finders)
    with pytest.raises(ValueError, match="unknown template"):
        ex.choose_template("x", {"string": "{}"})
    with pytest.raises(ValueError):
        ex.template_fields(3)


def test_configurations():
    SubsetConfig(sizes=[0.1, 5], epsilon=160.0)
    for bad in (
        {"sizes": []},
        {"sizes": [50.0]},
        {"sizes": [1], "epsilon": 0},
        {"sizes": [1], "epsilon": 161},
        {"sizes": [1], "num_folds": 0},
        {"sizes": [1], "template": "none"},
        {"sizes": [1], "encoder": "none"},
    ):
        with pytest.raises(ValueError):
            SubsetConfig(**bad)
    for bad in ({"image_mode": "x"}, {"on_error": "x"}, {"num_splits": 0}):
        with pytest.raises(ValueError):
            ConvertConfig(**bad)
    with pytest.raises(ValueError):
        ChunkConfig(max_tokens=0)


def test_subsets_of_conversations(spark, tmp_path):
    rows = [
        ("d", i, [{"role": "system", "content": "s"}, {"role": "user", "content": f"word{i % 7} word{i % 3}"}])
        for i in range(40)
    ]
    df = spark.createDataFrame(rows, "dataset string, row_id long, messages array<struct<role:string,content:string>>")
    config = SubsetConfig(sizes=[0.25, 3], num_folds=4)
    subset.write_subsets(df, config, str(tmp_path))
    selection = stores.read_selection(spark, f"{tmp_path}/selection")
    counts = {r.size_spec: r["count"] for r in selection.groupBy("size_spec").count().collect()}
    assert counts == {"percent_0.25": 10, "samples_3": 3}
    assert os.path.isdir(f"{tmp_path}/selection/dataset=d/size_spec=samples_3")
    written = spark.read.json(f"{tmp_path}/subsets")
    assert written.count() == 13 and written.filter("rank = 0").count() == 2
    empty = subset.subset_records(df.filter("false"), config)
    assert empty.count() == 0


def test_stream_ingest_takes_only_what_is_new(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://x/a.html", "<p>one</p>"), (2, "http://x/b.html", "<p>two</p>")],
        "page_id long, url string, html string",
    )
    inbox, store, state = (f"{tmp_path}/{n}" for n in ("inbox", "store", "state"))
    pages.write.parquet(inbox)
    start_ingest(stream_pages(spark, inbox), store, state).awaitTermination()
    assert stores.read_vectors(spark, store).count() == 2
    later = pages.filter("page_id = 1").union(
        spark.createDataFrame([(3, "http://x/c.html", "<p>three</p>")], pages.schema)
    )
    later.write.mode("append").parquet(inbox)
    start_ingest(stream_pages(spark, inbox), store, state).awaitTermination()
    assert sorted(r.row_id for r in stores.read_vectors(spark, store).collect()) == ["1#0", "2#0", "3#0"]


def test_listed_names_are_taken_literally(spark, tmp_path):
    from paperloom.sources.manifest import read_listed

    for name in ("a[1].bin", "a1.bin", "b{x,y}.bin", "c*.bin", "cc.bin"):
        (tmp_path / name).write_bytes(name.encode())
    names = spark.createDataFrame([("a[1].bin",), ("b{x,y}.bin",), ("c*.bin",)], "name string")
    read = read_listed(spark, str(tmp_path), names).select("content").collect()
    assert sorted(bytes(r[0]).decode() for r in read) == ["a[1].bin", "b{x,y}.bin", "c*.bin"]
