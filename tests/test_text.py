import hashlib
import os
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.functions import templates
from paperloom.functions.text import (
    dataset_name,
    hit_preview,
    hit_source,
    join_location,
    preview,
    safe_filename,
    strip,
    token_count,
    with_instruction,
    words,
)


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


def digest_name(url):
    return "doc_" + hashlib.md5(url.encode()).hexdigest()[:10]


def test_safe_filename(spark):
    expected = {
        "https://x.org/maps/harbour.tif": "harbour",
        "https://x.org/tiles/z9/view": digest_name("https://x.org/tiles/z9/view"),
        "https://x.org/a/DOWNLOAD.html": digest_name("https://x.org/a/DOWNLOAD.html"),
        "https://x.org/ab": digest_name("https://x.org/ab"),
        "https://x.org/": digest_name("https://x.org/"),
        "https://x.org": digest_name("https://x.org"),
        "https://x.org/harbour.tif?size=4#top": "harbour",
        "https://x.org/harbour;v=2": "harbour",
        "https://x.org/old chart.v2.tif": "old_chart.v2",
        "https://x.org/maps/harbour.tif/": "harbour",
        "/p/tide table.pdf": "tide_table",
        "a.tar.gz": "a.tar",
        ".bashrc": ".bashrc",
        "ab": "ab",
        "HTTP://x.org/a.pdf": "a",
        "/p/é.pdf": "_",
    }
    assert column(spark, expected, safe_filename) == list(expected.values())


def test_local_names_follow_pathlib(spark):
    paths = ["/a/b.c/d", "x..y", "..a", "a.", "/a/b/", "/a/./", "a b/c d.e f"]
    expected = [re.sub(r"[^A-Za-z0-9._-]", "_", Path(p).stem) for p in paths]
    assert column(spark, paths, safe_filename) == expected


def test_dataset_name(spark):
    paths = ["/d/a b.jsonl", "x.y.csv", ".hidden", "..a", "a.", "/d/", "größe-1_ü.parquet", "日本.json"]
    expected = [
        re.sub(r"[^\w\-_]", "_", os.path.splitext(os.path.basename(p))[0]) for p in paths
    ]
    assert column(spark, paths, dataset_name) == expected


def test_words_follow_python_split(spark):
    every_space = "".join(f"a{c}" for c in C.SPACES)
    texts = ["", " ", "a", "  a  b\n\nc\t", "x\u00a0y\u3000z\u2003", every_space, "a\u200bb", "é ü"]
    assert column(spark, texts, words) == [t.split() for t in texts]
    assert column(spark, texts, token_count) == [len(t.split()) for t in texts]
    assert column(spark, texts, strip) == [t.strip() for t in texts]
    assert column(spark, [None], words) == [None]


def test_space_list_is_complete():
    assert set(C.SPACES) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_join_location(spark):
    got = column(spark, ["/a.pdf", "a.pdf", "//b/c.pdf"], lambda v: join_location(F.lit("s3a://b/p//"), v))
    assert got == ["s3a://b/p/a.pdf", "s3a://b/p/a.pdf", "s3a://b/p/b/c.pdf"]


def test_instruction(spark):
    assert column(spark, ["t"], with_instruction) == ["Retrieve relevant passages:: t"]
    assert column(spark, ["t"], lambda v: with_instruction(v, "Do")) == ["Do: t"]
    with pytest.raises(ValueError):
        with_instruction(F.col("v"), "", None)


def test_previews(spark):
    texts = ["a" * 200, "a" * 201]
    assert column(spark, texts, preview) == ["a" * 200, "a" * 200 + "..."]
    assert column(spark, ["a\nb"], hit_preview) == ["a b..."]
    assert column(spark, ["http://x/" + "n" * 70], hit_source) == ["n" * 60 + "..."]


def test_templates(spark):
    rows = [
        ([("system", "S"), ("user", "U"), (None, "N"), ("assistant", None)], "t", "q", None),
        ([], None, None, None),
        ([("system", "S")], "t", "q", "a"),
    ]
    df = spark.createDataFrame(
        rows, "messages array<struct<role:string,content:string>>, text string, question string, answer string"
    ).coalesce(1)

    def rendered(name):
        return [r.rendered for r in templates.render(df, name).collect()]

    assert rendered("conversation") == ["user: U\n: N\nassistant: \n", "", ""]
    assert rendered("default") == ["t", "", "t"]
    assert rendered("qa") == [
        "Question: q\nAnswer: ",
        "Question: \nAnswer: ",
        "Question: q\nAnswer: a",
    ]
    with pytest.raises(ValueError, match="unknown template"):
        templates.render(df, "nope")


def test_turns_in_any_order_are_one_text(spark):
    turns = [(1, t, "user" if t % 2 else "assistant", f"m{t}") for t in range(25)]
    turns += [(2, 0, "system", "hidden"), (3, 1, None, "x"), (3, 0, "user", None)]
    df = spark.createDataFrame(turns[::-1], "conv_id long, turn long, role string, text string")
    parts = {r.conv_id: r.rendered for r in templates.render_turns(df, turns_per_part=10).collect()}
    whole = "".join(f"{'user' if t % 2 else 'assistant'}: m{t}\n" for t in range(25))
    assert parts[1] == whole
    assert parts[2] == ""
    assert parts[3] == "user: \n: x\n"
