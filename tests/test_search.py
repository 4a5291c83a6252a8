import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom import constants as C
from paperloom.operators import embedding as em
from paperloom.operators import search
from paperloom.plans.retrieval import chunk_key, page_vectors, semantic_search
from paperloom.sources import stores


def keyed(spark, matrix, name, prefix=None):
    rows = [(f"{prefix}{i}" if prefix else i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} {'string' if prefix else 'long'}, embedding array<float>").repartition(5)


def brute_force(corpus, queries, k, names):
    unit = lambda m: m / np.maximum(np.linalg.norm(m.astype(float), axis=1, keepdims=True), 1e-12)
    scores = np.round(unit(queries) @ unit(corpus).T, 6) + 0.0
    return {
        (q, rank + 1): (names[i], scores[q, i])
        for q in range(len(queries))
        for rank, i in enumerate(sorted(range(len(corpus)), key=lambda i: (-scores[q, i], names[i]))[:k])
    }


def found(df, key="row_id"):
    return {(r.query_id, r["rank"]): (r[key], pytest.approx(r.score, abs=1e-6)) for r in df.collect()}


@pytest.mark.parametrize("prefix", [None, "c"])
@pytest.mark.parametrize("limit", [100, 2])
def test_exact_search_with_copies(spark, small_batches, prefix, limit):
    rng = np.random.default_rng(1)
    corpus = rng.normal(size=(60, 4)).astype(np.float32)
    corpus[20:45] = corpus[7]
    corpus[50] = 0
    queries = np.vstack([rng.normal(size=(5, 4)), corpus[7:8]]).astype(np.float32)
    hits = search.topk_search(
        keyed(spark, corpus, "row_id", prefix), keyed(spark, queries, "query_id"), 6, block_queries=limit
    )
    names = [f"c{i}" if prefix else i for i in range(60)]
    assert found(hits) == brute_force(corpus, queries, 6, names)


def test_many_blocks_scan_the_corpus_in_place(spark):
    rng = np.random.default_rng(4)
    corpus, queries = rng.normal(size=(80, 3)).astype(np.float32), rng.normal(size=(9, 3)).astype(np.float32)
    rows, asked = keyed(spark, corpus, "row_id"), keyed(spark, queries, "query_id")
    hits = search.topk_search(rows, asked, 3, block_queries=2)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 5 and "Join" not in plan and "Generate" not in plan
    assert found(hits) == brute_force(corpus, queries, 3, range(80))


def test_hit_texts_are_fetched_without_moving_the_corpus(spark):
    rows = keyed(spark, np.eye(4), "row_id").withColumn("text", F.lit("long text"))
    hits = search.topk_search(rows, keyed(spark, np.eye(4)[:1], "query_id"), 2)
    plan = search.with_hit_fields(hits, rows, "row_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


def test_queries_taken_from_the_corpus(spark):
    corpus = np.random.default_rng(6).normal(size=(40, 3)).astype(np.float32)
    rows = keyed(spark, corpus, "row_id")
    asked = rows.filter("row_id % 4 = 0").select((F.col("row_id") / 4).cast("long").alias("query_id"), "embedding")
    exact = brute_force(corpus, corpus[::4], 2, range(40))
    assert found(search.topk_search(rows, asked, 2)) == exact
    assert found(search.topk_search(rows, asked, 2, block_queries=3)) == exact


def test_fewer_rows_than_k_and_empty_inputs(spark):
    corpus = keyed(spark, np.eye(3), "row_id")
    assert search.topk_search(corpus, keyed(spark, np.eye(3)[:1], "query_id"), 9).count() == 3
    assert search.topk_search(corpus.filter("false"), keyed(spark, np.eye(3), "query_id")).count() == 0
    assert search.topk_search(corpus, keyed(spark, np.eye(3), "query_id").filter("false")).count() == 0
    with pytest.raises(ValueError):
        search.topk_search(corpus, corpus, 0)


def test_cells(spark, tmp_path):
    rng = np.random.default_rng(2)
    corpus = rng.normal(size=(300, 8)).astype(np.float32)
    queries = corpus[:20] + rng.normal(size=(20, 8)).astype(np.float32) * 0.1
    rows, asked = keyed(spark, corpus, "row_id"), keyed(spark, queries, "query_id")
    index = search.build_cells(rows, cells=10)
    index.assign(rows).write.partitionBy("cell").parquet(f"{tmp_path}/cells")
    stored = spark.read.parquet(f"{tmp_path}/cells")
    exact = brute_force(corpus, queries, 5, range(300))
    assert found(search.cell_search(stored, index, asked, 5, probes=10)) == exact
    near = found(search.cell_search(stored, index, asked, 5, probes=4))
    assert found(search.cell_search(stored, index, asked, 5, probes=4, block_queries=6)) == near
    recall = len({(q, v[0]) for (q, _), v in near.items()} & {(q, v[0]) for (q, _), v in exact.items()}) / 100
    assert recall > 0.6
    one = search.cell_search(stored, index, asked.filter("query_id = 0"), 5, probes=1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan


def test_hashing_encoder(spark, small_batches):
    texts = ["a b a", "a b a ", "", None, "b a a", "zzz"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = [r.embedding for r in em.embed(df).orderBy("i").collect()]
    assert rows[0] == rows[1] == rows[4] and rows[3] is None
    assert rows[2] == [0.0] * C.HASH_DIM
    assert np.linalg.norm(rows[0]) == pytest.approx(1, abs=1e-6)
    import zlib

    expected = np.zeros(C.HASH_DIM)
    for word in "a b a".split():
        code = zlib.crc32(word.encode())
        expected[code % C.HASH_DIM] += -1 if code >> 31 else 1
    assert rows[0] == pytest.approx(expected / np.linalg.norm(expected), abs=1e-6)
    small = em.embed(df, encoder=em.hashing_encoder(dim=7)).filter("i = 0").first().embedding
    assert len(small) == 7
    cut = em.embed(df, encoder=em.hashing_encoder(max_tokens=1)).filter("i = 0").first().embedding
    alone = em.embed(df.withColumn("text", F.lit("a"))).first().embedding
    assert cut == alone
    prefixed = em.embed(df, instruction="say").filter("i = 5").first().embedding
    assert prefixed == em.embed(df.withColumn("text", F.lit("say: zzz"))).first().embedding


def test_encoder_registry_and_user_model(spark):
    assert em.supported_encoders() == ["hash"]
    with pytest.raises(ValueError, match="unknown encoder"):
        em.get_encoder("nope")

    def make_model():
        def lengths(texts):
            return np.array([[len(t), t.count("a")] for t in texts.reshape(-1)], dtype=np.float32)

        return lengths

    known = {"lengths": lambda: em.batch_encoder(make_model, batch_size=2)}
    df = spark.createDataFrame([("aa b",), ("c",), ("xa",)], "text string")
    rows = em.embed(df, encoder=em.get_encoder("lengths", known)).collect()
    assert {r.text: r.embedding for r in rows} == {"aa b": [4.0, 2.0], "c": [1.0, 0.0], "xa": [2.0, 1.0]}


def test_only_new_or_changed_texts_are_embedded(spark, tmp_path):
    path = f"{tmp_path}/store"
    table = lambda rows: em.content_key(spark.createDataFrame(rows, "id long, text string"), "id", "text", "hash")
    first = table([(1, "a"), (2, "b")])
    stores.append_vectors(em.embed_missing(first, None), path)
    second = table([(1, "a"), (2, "changed"), (3, "c")])
    fresh = em.embed_missing(second, stores.read_vectors(spark, path))
    assert sorted(r.row_id for r in fresh.collect()) == [2, 3]
    stores.append_vectors(fresh, path)
    stored = stores.read_vectors(spark, path)
    assert em.embed_missing(second, stored).count() == 0
    assert em.embed_missing(second.withColumn("encoder", F.lit("other")), stored).count() == 3
    assert sorted(r.row_id for r in em.current_vectors(second, stored).collect()) == [1, 2, 3]


def test_dimension_checks(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,)], "embedding array<float>")
    assert {(r.dim, r.n_rows) for r in em.dimension_counts(df).collect()} == {(2, 1), (1, 1), (None, 1)}
    assert em.check_dimensions(df.limit(1)) == 2
    with pytest.raises(ValueError):
        em.check_dimensions(df)


def test_collection_rules(spark, tmp_path):
    rows = [
        ("ok", "t" * 70_000, "s", 0, [1.0, 2.0]),
        ("twice", "t", "s", 0, [1.0, 2.0]),
        ("twice", "t", "s", 1, [1.0, 2.0]),
        ("x" * 257, "t", "s" * 1025, 0, [1.0]),
        (None, "t", "s", 0, None),
    ]
    kind = "chunk_id string, text string, source string, chunk_index long, embedding array<float>"
    table = stores.collection_rows(spark.createDataFrame(rows, kind), text_chars=C.COLLECTION_TEXT_CHARS)
    assert table.filter("id = 'ok'").first().text == "t" * 65_535
    bad = {(r.rule, r.id, r.n) for r in stores.collection_violations(table, 2).collect()}
    assert bad == {
        ("id repeated", "twice", 2),
        ("id too long", "x" * 257, 1),
        ("source too long", "x" * 257, 1),
        ("embedding malformed", "x" * 257, 1),
        ("id missing", None, 1),
        ("embedding malformed", None, 1),
    }
    path = f"{tmp_path}/collection"
    with pytest.raises(ValueError, match="breaks its rules"):
        stores.write_collection(table, path, 2)
    sound = table.filter("id in ('ok', 'twice')")
    stores.write_collection(sound, path, 2, allow=("id repeated",))
    assert stores.read_collection(spark, path).count() == 3
    stores.write_collection(sound.filter("id = 'ok'"), path, 2)
    assert stores.read_collection(spark, path).count() == 1


def test_pages_to_hits(spark, tmp_path):
    pages = spark.createDataFrame(
        [
            (1, "http://x.org/cats.html", "<h1>Cats</h1><p>cats purr softly</p><p>cats sleep</p>"),
            (2, "http://y.org/cats.html", "<h1>Dogs</h1><p>dogs bark loudly</p>"),
        ],
        "page_id long, url string, html string",
    )
    stores.write_collection(stores.collection_rows(page_vectors(pages), chunk_key()), f"{tmp_path}/c", C.HASH_DIM)
    asked = spark.createDataFrame([(1, "dogs bark"), (2, "cats sleep")], "query_id int, text string")
    hits = semantic_search(stores.read_collection(spark, f"{tmp_path}/c"), asked, k=1).orderBy("query_id").collect()
    assert [(h.id, h.chunk_id, h.text) for h in hits] == [
        ("2#0", "cats_chunk_0", "dogs bark loudly"),
        ("1#0", "cats_chunk_0", "cats purr softly\ncats sleep"),
    ]


def test_vector_type_of_collection(spark):
    df = spark.createDataFrame([("i", "t", "s", 0, [1.0])], "chunk_id string, text string, source string, chunk_index int, embedding array<double>")
    kinds = {f.name: f.dataType for f in stores.collection_rows(df).schema}
    assert kinds["embedding"] == T.ArrayType(T.FloatType()) and kinds["chunk_index"] == T.LongType()


def test_undefined_scores_are_no_hits():
    import numpy as np

    from paperloom.operators.search import _Best

    best = _Best(1, 2)
    best.add(np.arange(4), np.array([[0.9], [np.nan], [0.8], [0.2]]))
    assert best.key.tolist() == [0, 2]
