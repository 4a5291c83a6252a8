import base64
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

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
from paperloom.sources.documents import read_documents, write_document_files, write_document_json

PAGE = """<html><head><title>no</title><script>var a = "<p>no</p>";</script></head><body>
<!-- <p>no</p> --><nav><li>no</li></nav>lead text<H1 class="x">Top &amp;amp; more</H1>
<p>one <b>two</b>&nbsp;three<br>four <img alt="i" src="pic.png"> after</p>
<h2>Part</h2><ul><li>first</li><li> second </li></ul><p>  </p>
<table><tr><th>k</th><th>v</th></tr><tr><td>a</td><td>1 &lt; 2</td></tr></table>
<pre>code   here</pre>tail<div class="ad">no</div><footer>no</footer></body></html>"""


def documents(spark, pages, **options):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return convert_pages(df, **options)


def items_of(spark, html):
    rows = item_rows(documents(spark, [(1, "http://x.org/page-one.html", html)])).collect()
    return [(r.label, r.level, r.text) for r in sorted(rows, key=lambda r: r.item_idx)]


def test_items(spark):
    assert items_of(spark, PAGE) == [
        ("text", 0, "lead text"),
        ("title", 1, "Top &amp; more"),
        ("text", 0, "one two three four"),
        ("picture", 0, "pic.png"),
        ("text", 0, "after"),
        ("section_header", 2, "Part"),
        ("list_item", 0, "first"),
        ("list_item", 0, "second"),
        ("table_row", 0, "k | v"),
        ("table_row", 0, "a | 1 < 2"),
        ("code", 0, "code here"),
        ("text", 0, "tail"),
    ]


def test_script_may_hold_a_comment_mark(spark):
    html = '<p>a</p><script>x = "<!--"</script><p>b</p><!-- c --><p>d</p>'
    assert [t for _, _, t in items_of(spark, html)] == ["a", "b", "d"]


def test_mark_characters_in_a_page_do_not_split_it(spark):
    assert items_of(spark, "<p>a\x1eb\x1fc</p>") == [("text", 0, "abc")]


def test_rejects_and_strict_mode(spark):
    pages = [(1, "u1", "<p>x</p>"), (2, "u2", None), (3, "u3", "<p> </p>")]
    docs = documents(spark, pages)
    assert {r.doc_id: r.status for r in rejects(docs).collect()} == {2: "no content", 3: "no items"}
    assert [r.doc_id for r in converted(docs).collect()] == [1]
    with pytest.raises(Exception, match="cannot convert document 2"):
        documents(spark, pages[:2], on_error="strict").select("status").collect()
    with pytest.raises(ValueError):
        documents(spark, pages, on_error="whatever")


def test_export_and_read_back(spark, tmp_path):
    docs = converted(documents(spark, [(1, "http://x.org/page.html", PAGE), (2, "/d/page.pdf", "<p>y</p>")]))
    exported = export_documents(docs)
    by_id = {r.doc_id: r for r in exported.collect()}
    assert by_id[1].md.split("\n\n")[1:4] == ["# Top &amp; more", "one two three four", "![Image](pic.png)"]
    assert "| a | 1 < 2 |" in by_id[1].md and "```\ncode here\n```" in by_id[1].md
    assert json.loads(by_id[2].json)["items"] == [{"label": "text", "level": 0, "text": "y"}]
    assert [(r.stem, r.n_docs) for r in shared_stems(exported).collect()] == [("page", 2)]
    write_document_json(exported, f"{tmp_path}/json")
    again = read_documents(spark, f"{tmp_path}/json")
    same = ["doc_id", "source", "name", "items"]
    assert sorted(again.select(same).collect()) == sorted(docs.select(same).collect())
    write_document_files(exported, f"{tmp_path}/md", "md")
    assert spark.read.text(f"{tmp_path}/md").filter("value = 'y'").first()["stem"] == "page"


def test_one_json_file_per_document(spark, tmp_path):
    document = {"doc_id": 7, "source": "s", "name": "n", "items": [{"label": "text", "level": 0, "text": "t"}]}
    (tmp_path / "one.json").write_text(json.dumps(document, indent=2))
    assert read_documents(spark, str(tmp_path), multi_line=True).first()["items"][0]["text"] == "t"


def test_picture_modes(spark):
    df = spark.createDataFrame([("p.png", bytearray(range(90))), ("q.png", None)], "uri string, content binary")
    modes = [picture_markdown(m, F.col("uri"), F.col("content")) for m in ("embedded", "placeholder", "referenced")]
    first, second = df.coalesce(1).select(*modes).collect()
    inline = base64.b64encode(bytes(range(90))).decode()
    assert list(first) == [f"![Image](data:image/png;base64,{inline})", "<!-- image -->", "![Image](p.png)"]
    assert list(second) == ["![Image](q.png)", "<!-- image -->", "![Image](q.png)"]
    with pytest.raises(ValueError):
        picture_markdown("other", F.col("uri"))


def make_documents(spark, items_by_doc):
    rows = [(i, f"/d/doc{i}.pdf", f"doc{i}", items) for i, items in enumerate(items_by_doc)]
    kind = "doc_id long, source string, name string, items array<struct<label:string,level:int,text:string>>"
    return spark.createDataFrame(rows, kind)


def chunks_of(df):
    rows = sorted(df.collect(), key=lambda r: (r.doc_id, r.chunk_index))
    return [(r.text, r.headings, r.n_tokens, r.n_heading_tokens) for r in rows]


def test_split_merge_and_headings(spark):
    items = [
        ("title", 1, "Top"),
        ("text", 0, "a b"),
        ("text", 0, "c"),
        ("picture", 0, "p.png"),
        ("text", 0, "d e f g h i j"),
        ("section_header", 2, "Sub one"),
        ("text", 0, "k"),
        ("section_header", 2, "Sub two"),
        ("text", 0, "l"),
        ("title", 1, "Next"),
        ("text", 0, "m"),
        ("text", 0, " "),
    ]
    df = make_documents(spark, [items])
    assert chunks_of(ch.chunk_documents(df, 5)) == [
        ("a b\nc", ["Top"], 3, 1),
        ("d e f g", ["Top"], 4, 1),
        ("h i j", ["Top"], 3, 1),
        ("k", ["Top", "Sub one"], 1, 3),
        ("l", ["Top", "Sub two"], 1, 3),
        ("m", ["Next"], 1, 1),
    ]
    unmerged = chunks_of(ch.chunk_documents(df, 5, merge_peers=False))
    assert [c[0] for c in unmerged] == ["a b", "c", "d e f g", "h i j", "k", "l", "m"]
    assert [c[0] for c in chunks_of(ch.structural_chunks(df))][2] == "d e f g h i j"
    record = ch.chunk_records(ch.chunk_documents(df, 5)).orderBy("chunk_index").first()
    assert record["chunk_id"] == "doc0_chunk_0"
    assert record["metadata"].asDict() == {"doc_items": ["text", "text"], "headings": ["Top"], "token_count": 3}
    context = ch.chunk_documents(df, 5).filter("chunk_index = 3").select(ch.contextualized()).first()[0]
    assert context == "Top\nSub one\nk"


def test_headings_longer_than_the_limit_still_make_progress(spark):
    df = make_documents(spark, [[("title", 1, "a b c d e f"), ("text", 0, "x y")]])
    assert [c[0] for c in chunks_of(ch.chunk_documents(df, 3))] == ["x", "y"]


def test_own_token_rule(spark):
    df = make_documents(spark, [[("text", 0, "a-b-c d-e")]])
    parts = chunks_of(ch.chunk_documents(df, 2, tokenize=lambda text: F.split(text, "[- ]")))
    assert [(c[0], c[2]) for c in parts] == [("a b", 2), ("c d", 2), ("e", 1)]


def test_settings_samples_and_totals(spark):
    df = make_documents(spark, [[("text", 0, f"w{i} x y")] * 4 for i in range(3)] + [[("title", 1, "only")]])
    study = ch.compare_settings(df, {"whole": (100, True), "single": (100, False)})
    stats = {(r.doc_id, r.setting): (r.n_chunks, r.mean_tokens) for r in ch.chunk_statistics(study, "setting").collect()}
    assert stats[0, "whole"] == (1, 12.0) and stats[0, "single"] == (4, 3.0)
    assert stats[3, "whole"] == (0, None)
    samples = ch.chunk_samples(study.filter("setting = 'single'"), 3).collect()
    assert len(samples) == 9 and max(r.chunk_index for r in samples) == 2
    totals = ch.corpus_totals(ch.pack_documents(df, 6)).first()
    assert totals.asDict() == {"n_documents": 4, "n_chunked": 3, "n_chunks": 6, "n_tokens": 36}


WORD = st.text("abc", min_size=1, max_size=3)
ITEM = st.tuples(
    st.sampled_from([("text", 0), ("text", 0), ("list_item", 0), ("title", 1), ("section_header", 2)]),
    st.lists(WORD, min_size=1, max_size=12).map(" ".join),
).map(lambda x: (x[0][0], x[0][1], x[1]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(ITEM, max_size=12), min_size=1, max_size=6), st.integers(1, 9))
def test_chunks_hold_all_words_within_the_limit(spark, small_batches, items_by_doc, limit):
    rows = ch.chunk_documents(make_documents(spark, items_by_doc), limit).collect()
    for doc, items in enumerate(items_by_doc):
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.chunk_index)
        assert " ".join(r.text for r in own).split() == " ".join(t for _, lv, t in items if lv == 0).split()
        for r in own:
            assert r.n_tokens == len(r.text.split())
            assert r.n_heading_tokens == len(" ".join(r.headings).split())
            assert r.n_heading_tokens + r.n_tokens <= limit or r.n_tokens == 1


def test_confidence(spark):
    df = make_documents(spark, [[("text", 0, "ab"), ("text", 0, "a#"), ("text", 0, "##")], [("text", 0, "ok")], []])
    scores = F.transform("items", lambda i: text_score(i["text"]))
    rows = {r.doc_id: r for r in document_confidence(df, scores).collect()}
    assert (rows[0].n_pages, rows[0].mean_score, rows[0].mean_grade) == (3, 0.5, "fair")
    assert [tuple(p) for p in rows[0].low_pages] == [(3, 0.0)]
    assert (rows[1].mean_grade, rows[1].low_pages) == ("excellent", [])
    assert (rows[2].n_pages, rows[2].mean_score, rows[2].mean_grade) == (0, None, "unspecified")

    table = spark.createDataFrame(
        [(0, 0, 1.0), (0, 1, 0.5), (0, 2, 0.0), (1, 0, 0.7), (1, 1, 0.7), (2, 0, None)],
        "doc_id long, page_no int, score double",
    )
    assert {(r.doc_id, r.mean_grade) for r in rollup(table).collect()} == {
        (0, "fair"),
        (1, "fair"),
        (2, "unspecified"),
    }
    assert {tuple(r) for r in low_pages(table).collect()} == {(0, 3, 0.0), (1, None, None), (2, None, None)}
