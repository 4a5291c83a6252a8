"""Repeated passages beside brute force, and on awkward rows."""

import hashlib
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import queries, substring_dedup

FOLDER = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def brute(rows, window):
    """(n_words, n_removed, spans, kept text) of each row, by all windows."""
    split = [(key, re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())) for key, text in rows]
    least = {}
    for key, words in split:
        for i in range(len(words) - window + 1):
            if key is not None:
                spelled = tuple(words[i : i + window])
                least[spelled] = min(least.get(spelled, key), key)
    found = []
    for key, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if key is not None and least[tuple(words[i : i + window])] < key:
                gone.update(range(i, i + window))
        spans = []
        for place in sorted(gone):
            if spans and spans[-1][1] == place:
                spans[-1][1] += 1
            else:
                spans.append([place, place + 1])
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        found.append((str(key), len(words), len(gone), str(spans), kept))
    return sorted(found)


def got(frame, **settings):
    rows = substring_dedup.without_repeated_passages(frame, **settings).collect()
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], str([[s["start"], s["stop"]] for s in r["spans"]]), r["kept_text"]) for r in rows)


def corpus(rng, count, window):
    """Texts out of a few passages of any length, cut anywhere, over words of which some are very common."""
    words = [f"w{i}" for i in range(40)] + ["the"] * 40 + ["é", "日本", "𝒳"]
    passages = [[rng.choice(words) for _ in range(rng.randrange(1, 4 * window))] for _ in range(12)]
    rows = []
    for key in range(count):
        text = []
        for _ in range(rng.randrange(0, 6)):
            passage = rng.choice(passages)
            low = rng.randrange(len(passage))
            text += passage[low : low + rng.randrange(1, 4 * window)] if rng.random() < 0.7 else [rng.choice(words) for _ in range(rng.randrange(30))]
        rows.append((rng.randrange(count), "".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in text)))
    return rows


@pytest.mark.parametrize("window,seed", [(6, 3), (8, 8), (12, 4), (5, 1)])
def test_equals_brute_force(spark, window, seed):
    rows = corpus(random.Random(window), 150, window)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(frame, window=window, seed=seed) == brute(rows, window)


def test_awkward_rows(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(20_000))
    rows = [
        (1, ""), (2, None), (None, passage), (3, passage), (4, passage + " more"), (4, "before " + passage), (4, passage + " more"), (5, " \n\t "), (6, long),
        (7, long + " " + passage), (8, "a " * 200), (9, "a " * 120), (10, " ".join(f"p{i}" for i in range(49))), (11, "x " + " ".join(f"p{i}" for i in range(50))),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.selectExpr("*", "'x' AS id", "1 AS doc", "2 AS sign", "3 AS asked", "4 AS spans", "5 AS at")
    assert got(frame) == brute(rows, 50)
    assert got(frame.limit(0)) == []


def test_hot_passages_need_no_pairs(spark):
    """A passage in every document, each with own words around it: rows grow with the documents, not with their square."""
    passage = " ".join(f"hot{i}" for i in range(120))
    rows = [(k, f"{' '.join(f'a{k}_{i}' for i in range(45))} {passage} {' '.join(f'b{k}_{i}' for i in range(45))}") for k in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    named = frame.select(F.col("doc_id").alias("doc"), F.lit(0).cast("long").alias("sign"), "text")
    assert substring_dedup.repeated_windows(named).count() < 400 * 90
    found = got(frame)
    assert [r[2] for r in found].count(120) == 399


def test_least_of():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, 300)
    for count in (1, 2, 5, 41, 64, 300):
        expected = [i + int(np.argmin(values[i : i + count])) for i in range(301 - count)]
        assert substring_dedup.least_of(values, count).tolist() == expected
    assert len(substring_dedup.least_of(values, 301)) == 0


@tables
def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    expected = {int(k): (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for k, n, gone, _, kept in brute(rows, 50)}
    found = queries.QUERIES["op11_seed_and_extend"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == expected
    assert any(r["n_removed"] for r in found)
