"""Character references, lone brackets and pictures, beside Python's own reader of references."""

import html

import pytest
from pyspark.sql import functions as F

from paperloom.functions.html import html_items, resolve_references

TEXTS = [
    "caf&eacute; &#8217;s", "a &amp;lt; b", "&#x1F600;&#X41;&#65;", "&copy; &AMP &nosuch; & &; &#; &#x;", "x&", "&", "", "no reference", "&frac12;&Omega;&rarr;&apos;",
]


def test_references_equal_pythons(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "text string").select("text", resolve_references(F.col("text")).alias("out")).collect()
    for r in rows:
        # Python also takes names without a semicolon, which are left alone here.
        expected = r.text if r.text.startswith("x") or ";" not in r.text else html.unescape(r.text.replace("&AMP ", "\0"))
        assert r.out == expected.replace("\0", "&AMP ")


@pytest.mark.parametrize("reference", ["&#0;", "&#30;", "&#xD800;", "&#1114112;", "&#9999999;"])
def test_numbers_that_are_no_characters(spark, reference):
    assert spark.range(1).select(resolve_references(F.lit(f"a{reference}b"))).first()[0] == "a\ufffdb"


def test_items_of_hard_markup(spark):
    page = "<p>caf&eacute; &#8217;s a < b and c > d</p><img alt=1 src='a.png'><img src=b.png><img src=\"c&amp;d.png\"><p>x&nbsp;&#160;y</p><h2>1 <2 &lt;b&gt;</h2>"
    items = spark.createDataFrame([(page,)], "page string").select(html_items(F.col("page")).alias("i")).first().i
    assert [(x.label, x.text) for x in items] == [
        ("text", "caf\u00e9 \u2019s a < b and c > d"), ("picture", "a.png"), ("picture", "b.png"), ("picture", "c&d.png"), ("text", "x y"),
        ("section_header", "1 <2 <b>"),
    ]
