"""Language by rank order: a document's most frequent n-grams beside those of each language."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom.llm.common import rank_key, text_chunks

UNKNOWN = "und"
GRAMS = 3
PROFILE = 400
#: Training documents per language, about: the profiles are fitted on this bounded sample.
SAMPLE_ROWS = 1500


def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_counts(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of one to three letters with their counts.

    Words are runs of letters, lowered, with a blank on either side; a run crosses no more
    than a blank's place. A run is one number with 21 bits a letter.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = letters[codes]
    if not inside.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kept = inside.copy()
    kept[1:] |= inside[:-1]  # the first other character after a word is its blank
    line = np.where(inside, codes, 0)[kept]
    line = np.concatenate((np.zeros(1, np.int64), line, np.zeros(int(line[-1] > 0), np.int64)))
    pairs = (line[:-1] << 21) | line[1:]
    triples = (pairs[:-1] << 21) | line[2:]
    # Runs with a blank inside say nothing of a word.
    triples = triples[(line[1:-1] > 0)]
    return np.unique(np.concatenate((line[line > 0], pairs, triples)), return_counts=True)


def top_grams(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent runs in rank order; equal counts go by the run's number."""
    if len(keys) > size:
        floor = np.partition(counts, len(counts) - size)[len(counts) - size]
        sure = counts >= floor
        keys, counts = keys[sure], counts[sure]
    return keys[np.lexsort((keys, -counts))][:size]


def _count_grams(batches):
    letters = letter_table()
    for batch in text_chunks(batches, "text"):
        by_language: dict[str, list] = {}
        for language, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_language.setdefault(language, []).append(gram_counts(text, letters))
        for language, parts in by_language.items():
            keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([c for _, c in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], ["lang", "gram", "n"]
            )


def train_profiles(labelled: DataFrame, size: int = PROFILE, sample_rows: int = SAMPLE_ROWS, key: str = "doc_id") -> dict:
    """Rank profiles of the languages of ``labelled`` (key, text, lang); rows without text or language are left out.

    Of each language about ``sample_rows`` documents are counted, those with the lowest hashes.
    """
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    total = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not total:
        return {"languages": [], "keys": np.empty(0, np.int64), "ranks": np.empty((0, 0), np.int16), "size": size}
    share = F.create_map(*[x for lang, n in total.items() for x in (F.lit(lang), F.lit(min(1.0, sample_rows / n)))])
    chance = F.pmod(rank_key(F.col(key)), F.lit(1_000_000)) / 1_000_000
    sample = labelled.where(chance < share[F.col("lang")]).select("lang", "text")
    counts = sample.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size).toPandas()
    languages = sorted(total)
    keys = np.unique(ranked["gram"].to_numpy(np.int64))
    ranks = np.full((len(keys), len(languages)), -1, np.int32)
    column = ranked["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(np.int64)
    ranks[np.searchsorted(keys, ranked["gram"].to_numpy(np.int64)), column] = ranked["rank"].to_numpy() - 1
    return {"languages": languages, "keys": keys, "ranks": ranks, "size": size}


def out_of_place(grams: np.ndarray, profiles: dict) -> np.ndarray:
    """Mean distance of the ranks to each profile's, 0 to 1; a run that a profile lacks costs the most."""
    keys, ranks, size = profiles["keys"], profiles["ranks"], profiles["size"]
    place = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
    known = ranks[place]
    known = np.where((keys[place] == grams)[:, None], known, -1)
    cost = np.where(known >= 0, np.minimum(np.abs(known - np.arange(len(grams))[:, None]), size), size)
    return cost.sum(axis=0) / (size * len(grams))


def _predict(profiles: dict):
    def step(batches):
        letters = letter_table()
        languages = profiles["languages"]
        for batch in text_chunks(batches, "__text"):
            names, scores = [], []
            for text in batch.column("__text").to_pylist():
                grams = top_grams(*gram_counts(text or "", letters), profiles["size"])
                if not len(grams) or not languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                distance = out_of_place(grams, profiles)
                names.append(languages[int(distance.argmin())])
                scores.append(float(1 - distance.min()))
            kept = [n for n in batch.schema.names if n != "__text"]
            columns = [*(batch.column(n) for n in kept), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "lang_pred", "lang_score"])

    return step


def identify(docs: DataFrame, profiles: dict, text: str = "text") -> DataFrame:
    """Documents with ``lang_pred`` and ``lang_score`` (one less the mean distance, 0 to 1).

    ``und`` with score 0 where the text is null, empty or without a letter, or no language
    was learned. Equal distances go to the first language by name. Rows stay as they came,
    repeated ones too; columns of the added names are replaced. One pass without a shuffle.
    """
    kept = docs.drop("lang_pred", "lang_score").withColumn("__text", F.col(text))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "__text"]
    schema = StructType.fromDDL(", ".join([*fields, "lang_pred string", "lang_score double"]))
    known = docs.sparkSession.sparkContext.broadcast(profiles)
    return kept.mapInArrow(lambda batches: _predict(known.value)(batches), schema)
