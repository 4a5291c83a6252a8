"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom.llm.common import materialized, rank_key, text_chunks, utf8

#: Labelled rows to learn from, about: a bounded sample by the hash of the key.
SAMPLE_ROWS = 16_000
LEXICON = 600
NEAR = 5
STRETCH = 20
# Second persons of the four languages, and what stands for letters.
SECOND_PERSONS = frozenset(
    "you your yours yourself du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split()
)
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
FEATURES = (
    "log_words", "hit_rate", "weight_rate", "log_hits", "best_stretch", "hits_near_you", "you_rate",
    "capital_rate", "exclamation_rate", "punctuation_rate", "obfuscated_rate", "obfuscated_hit_rate",
)
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")


def plain_form(token: str) -> tuple[str, bool]:
    """A token without outer punctuation, lowered; letters restored and the sign of it where others stand inside."""
    word = _EDGES.sub("", token.lower())
    if word.isalpha() or not word:
        return word, False
    if not any(c.isalpha() for c in word):
        return word, False
    return _INNER.sub("", word.translate(LOOKALIKES)), True


def terms(word: str) -> list[str]:
    """The lexicon's keys of a word: itself and its beginnings of four to six letters."""
    return [word, *(f"{word[:n]}-" for n in (4, 5, 6) if len(word) > n)]


def _count_terms(batches):
    for batch in text_chunks(batches, "text"):
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = {plain_form(t)[0] for t in set((text or "").split())}
            for term in {t for w in words if len(w) > 2 for t in terms(w)}:
                counts.setdefault(term, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))],
            ["term", "clean", "toxic"],
        )


def learn_lexicon(sample: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """The terms of (text, toxic) that mark toxic texts best, with their log odds."""
    rows = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    clean, toxic = rows.get(0, 0) + 1, rows.get(1, 0) + 1
    counts = sample.mapInArrow(_count_terms, "term string, clean long, toxic long").groupBy("term")
    counts = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic >= 4")
    odds = F.log((F.col("toxic") + 0.5) / toxic) - F.log((F.col("clean") + 0.5) / clean)
    best = counts.select("term", odds.alias("odds"), "toxic").where(F.col("odds") > 2)
    best = best.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "term").limit(size)
    return {r["term"]: r["odds"] for r in best.collect()}


class Tokens:
    """Of each token seen: its weight in the lexicon, and whether it is a second person or obfuscated."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.known = lexicon, {}

    def __call__(self, token: str) -> tuple[float, bool, bool]:
        found = self.known.get(token)
        if found is None:
            if len(self.known) > 300_000:
                self.known.clear()
            word, hidden = plain_form(token)
            found = (max(self.lexicon.get(t, 0.0) for t in terms(word)), word in SECOND_PERSONS, hidden)
            self.known[token] = found
        return found


def features(text: str, raw: np.ndarray, look: Tokens) -> list[float]:
    """The dense features of one text, in the order of ``FEATURES``; all 0 without words."""
    tokens = text.split()
    if not tokens:
        return [0.0] * len(FEATURES)
    facts = [look(t) for t in tokens]
    weight = np.array([f[0] for f in facts])
    you = np.flatnonzero([f[1] for f in facts])
    hidden = np.array([f[2] for f in facts])
    hits, count = np.flatnonzero(weight > 0), len(tokens)
    sums = np.concatenate(([0], np.cumsum(weight > 0)))
    stretch = min(STRETCH, count)
    near = 0
    if len(hits) and len(you):
        after = np.searchsorted(you, hits)
        gap = np.minimum(np.abs(you[np.minimum(after, len(you) - 1)] - hits), np.abs(you[np.maximum(after - 1, 0)] - hits))
        near = int((gap <= NEAR).sum())
    kinds = np.bincount(raw, minlength=256)
    capitals, smalls = kinds[65:91].sum(), kinds[97:123].sum()
    marks = kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()
    return [
        math.log1p(count), len(hits) / count, float(weight.sum()) / count, math.log1p(len(hits)),
        float((sums[stretch:] - sums[:-stretch]).max()) / stretch, near / count, len(you) / count,
        float(capitals / max(capitals + smalls, 1)), float(kinds[33] / count), float(marks / max(len(raw), 1)),
        float(hidden.mean()), float((hidden & (weight > 0)).sum() / count),
    ]


def _featurize(lexicon: dict[str, float]):
    def step(batches):
        look = Tokens(lexicon)
        for batch in text_chunks(batches, "__text"):
            data, offsets = utf8(batch.column("__text"))
            rows = [
                features(text or "", data[offsets[i] : offsets[i + 1]], look)
                for i, text in enumerate(batch.column("__text").to_pylist())
            ]
            kept = [n for n in batch.schema.names if n != "__text"]
            columns = [*(batch.column(n) for n in kept), pa.array(rows, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "_features"])

    return step


def with_features(docs: DataFrame, lexicon: dict[str, float], text: str = "text", keep_text: bool = True) -> DataFrame:
    kept = docs.withColumn("__text", F.col(text))
    if not keep_text:
        kept = kept.drop(text)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "__text"]
    known = docs.sparkSession.sparkContext.broadcast(lexicon)
    return kept.mapInArrow(
        lambda batches: _featurize(known.value)(batches), StructType.fromDDL(", ".join([*fields, "_features array<double>"]))
    )


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> dict:
    """Lexicon, trees and calibration from (key, text) and (key, toxic).

    Learns from about ``sample_rows`` labelled rows, those of the lowest hashes of the key: seven tenths
    teach lexicon and trees, the rest the calibration. Null keys, texts and labels are left out, of repeated
    labels the highest counts. Where only one class occurs the score is its share.
    """
    labels = labels.where(F.col(key).isNotNull() & F.col("toxic").isin(0, 1)).groupBy(key).agg(F.max("toxic").cast("int").alias("toxic"))
    total = labels.count()
    share = min(1.0, sample_rows / max(total, 1))
    chosen = labels.where(F.pmod(rank_key(F.col(key)), F.lit(1_000_000)) < share * 1_000_000)
    # The sample's size is bounded above, so that it can be broadcast at any input size.
    sample = docs.select(key, F.col(text).alias("text")).dropna().join(F.broadcast(chosen), key)
    # Copies would teach their words as if many texts had them.
    sample = materialized(sample.groupBy(F.sha2("text", 256).alias("digest")).agg(*(F.max_by(c, key).alias(c) for c in (key, "text", "toxic"))), "labelled")
    fit = F.pmod(rank_key(F.lit("fit"), F.col(key)), F.lit(10)) < 7
    rows = {(r["fit"], r["toxic"]): r["count"] for r in sample.groupBy(fit.alias("fit"), "toxic").count().collect()}
    positive = sum(n for (_, toxic), n in rows.items() if toxic == 1)
    if len(rows) < 4:
        return {"lexicon": {}, "share": positive / max(sum(rows.values()), 1)}
    lexicon = learn_lexicon(sample.where(fit).select("text", "toxic"))
    ready = with_features(sample.withColumn("fit", fit), lexicon, keep_text=False)
    ready = ready.select("fit", F.col("toxic").cast("double").alias("label"), array_to_vector("_features").alias("features"))
    ready = materialized(ready, "features").coalesce(4)
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, seed=7, maxMemoryInMB=64).fit(ready.where("fit"))
    raw = trees.transform(ready.where("NOT fit")).select("label", vector_to_array("probability")[1].alias("raw"))
    calibration = IsotonicRegression(featuresCol="raw", predictionCol="score").fit(raw)
    return {"lexicon": lexicon, "trees": trees, "calibration": calibration}


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """Documents (without the text) with ``score``, the calibrated chance that the text is toxic.

    Null and empty texts have features 0 and a score like others. Rows stay as they came; an empty table
    gives no rows; a column ``score`` is replaced. One pass without a shuffle.
    """
    docs = docs.drop("score", "raw", "features", "rawPrediction", "probability", "prediction", "_features")
    if "trees" not in model:
        return docs.drop(text).withColumn("score", F.lit(float(model["share"])))
    ready = with_features(docs, model["lexicon"], text, keep_text=False).withColumn("features", array_to_vector("_features"))
    raw = model["trees"].transform(ready).withColumn("raw", vector_to_array("probability")[1])
    scored = model["calibration"].transform(raw)
    return scored.drop("_features", "features", "rawPrediction", "probability", "prediction", "raw")
