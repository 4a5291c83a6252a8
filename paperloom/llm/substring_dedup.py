"""Repeated passages of documents, found from shared seeds and extended both ways.

Every window of 50 words has a seed: of its runs of 10 words the first with the least hash. Equal windows have equal seeds at equal
places, so winnowing loses no repeat, while a document has a seed for about 20 words. Windows in a row with one seed are a run.

Documents meet on seeds, but pairs are never formed: a passage that stands in a third of all documents would make the square of them.
Runs around one seed that are equal as a whole, as in copies, form a class, and all but the first document's are repeats. Where a seed has
several classes, the first run of each is extended over its seed to all windows that hold it, any share of the 40 other words on its
left, and the windows of all classes meet by hash. What neighbouring windows cover is a maximal repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import materialized, text_chunks, utf8
from paperloom.llm.words import window_hashes, word_table

WINDOW = 50
SEED = 10
_EXACT = np.arange(256, dtype=np.uint8)
_WORDS = ~np.isin(_EXACT, [9, 10, 11, 12, 13, 32])
_RUN = [("anchor", np.int64), ("span", np.int64), ("doc", np.int64), ("sign", np.int64), ("at", np.int32), ("reach", np.int32)]


def least_of(values: np.ndarray, count: int) -> np.ndarray:
    """For every ``count`` values in a row, the place of the first least one."""
    if len(values) < count:
        return np.empty(0, np.int64)
    places, width = np.arange(len(values)), 1
    while width < count:
        step = min(width, count - width)
        left, right = places[: len(places) - step], places[step:]
        places = np.where(values[left] <= values[right], left, right)
        width += step
    return places


def runs_of(data: np.ndarray, offsets: np.ndarray, window: int, seed: int) -> tuple[dict, dict]:
    """The words of texts laid end to end, and their runs: first and last window, seed's hash, hash of all that the run covers."""
    words = word_table(data, offsets, _EXACT, _WORDS)
    _, inside = window_hashes(words, window)
    grams, _ = window_hashes(words, seed)
    picked = least_of(grams, window - seed + 1)[: len(inside)]
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (picked[1:] != picked[:-1])
    starts = np.flatnonzero(new)
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | (picked[1:] != picked[:-1])
    ends = np.flatnonzero(stops)
    sums, down = words["sums"], words["down"]
    return words, {"start": starts, "end": ends, "anchor": grams[picked[starts]], "span": (sums[ends + window] - sums[starts]) * down[starts]}


def _first_words(words: dict, texts: int) -> np.ndarray:
    return np.searchsorted(words["owner"], np.arange(texts + 1))


def _asked(column: pa.Array, *fields: str) -> tuple[np.ndarray, ...]:
    """The text's number and the fields of every struct in an array of lists; null lists are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), counts), *(flat.field(flat.type.get_field_index(f)).to_numpy(zero_copy_only=False) for f in fields)


def _seeds(window: int, seed: int):
    def task(batches):
        for batch in text_chunks(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            words, runs = runs_of(data, offsets, window, seed)
            owner = words["owner"][runs["start"]]
            first = _first_words(words, batch.num_rows)
            columns = {
                "anchor": runs["anchor"].view(np.int64), "span": runs["span"].view(np.int64),
                "doc": batch.column("doc").to_numpy()[owner], "sign": batch.column("sign").to_numpy()[owner],
                "at": runs["start"] - first[owner], "reach": runs["end"] - runs["start"] + 1,
            }
            for low in range(0, len(owner), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(columns[n][low : low + (1 << 16)].astype(t)) for n, t in _RUN], [n for n, _ in _RUN])

    return task


def _extend(window: int):
    """Every window of the asked runs with its hash."""

    def task(batches):
        for batch in text_chunks(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            words = word_table(data, offsets, _EXACT, _WORDS)
            hashes, _ = window_hashes(words, window)
            owner, at, reach, anchor = _asked(batch.column("asked"), "at", "reach", "anchor")
            first = _first_words(words, batch.num_rows)
            run = np.repeat(np.arange(len(owner)), reach)
            place = at[run] + np.arange(len(run)) - np.repeat(np.cumsum(reach) - reach, reach)
            text = owner[run]
            columns = [anchor[run], hashes[first[text] + place].view(np.int64), batch.column("doc").to_numpy()[text], batch.column("sign").to_numpy()[text], place.astype(np.int32)]
            for low in range(0, len(run), 1 << 16):
                part = [pa.array(c[low : low + (1 << 16)]) for c in columns]
                yield pa.RecordBatch.from_arrays(part, ["anchor", "window", "doc", "sign", "at"])

    return task


def _remove(window: int):
    """Counts, removed spans of words and the rest of each text, words joined by a blank."""

    def task(batches):
        for batch in text_chunks(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            words = word_table(data, offsets, _EXACT, _WORDS)
            first = _first_words(words, batch.num_rows)
            owner, at, reach = _asked(batch.column("asked"), "at", "reach")
            count = len(words["starts"])
            change = np.zeros(count + 1, np.int64)
            begin = first[owner] + at
            np.add.at(change, begin, 1)
            np.add.at(change, begin + reach + window - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            removed = np.concatenate(([0], np.cumsum(gone)))

            edge = np.zeros(count, bool)
            edge[1:] = words["owner"][1:] != words["owner"][:-1]
            opens, closes = gone.copy(), gone.copy()
            opens[1:] &= ~gone[:-1] | edge[1:]
            closes[:-1] &= ~gone[1:] | edge[1:]
            opens, closes = np.flatnonzero(opens), np.flatnonzero(closes)
            whose = words["owner"][opens]
            spans = pa.StructArray.from_arrays([pa.array(opens - first[whose]), pa.array(closes + 1 - first[whose])], ["start", "stop"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(whose, np.arange(batch.num_rows + 1)).astype(np.int32)), spans)

            kept = np.flatnonzero(~gone)
            inner = kept[:-1][words["owner"][kept[:-1]] == words["owner"][kept[1:]]]
            data = data.copy()
            mark = np.zeros(len(data) + 1, np.int32)
            np.add.at(mark, words["starts"][kept], 1)
            np.add.at(mark, words["ends"][kept], -1)
            stays = np.cumsum(mark[:-1]) > 0
            # A word that another one follows has a separator behind it.
            stays[words["ends"][inner]] = True
            data[words["ends"][inner]] = 32
            rest = [data[a:b][stays[a:b]].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            columns = [batch.column("id"), pa.array(np.diff(first)), pa.array(removed[first[1:]] - removed[first[:-1]]), lists, pa.array(rest, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "spans", "kept_text"])

    return task


def _per_text(rows: DataFrame, *fields: str) -> DataFrame:
    """The rows of each text in one list; a text has no more runs and windows than words."""
    return rows.groupBy("doc", "sign").agg(F.collect_list(F.struct(*fields)).alias("asked"))


def repeated_windows(named: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc, sign, at, reach): ``reach`` windows in a row from word ``at`` that also start in a document of smaller number.

    ``named`` has (doc, sign, text), where ``sign`` tells texts of one document number apart.
    """
    runs = named.mapInArrow(_seeds(window, seed), "anchor long, span long, doc long, sign long, at int, reach int")
    runs = materialized(runs, "runs")
    # Tables by seed are stored before they are joined: a join that shares its exchange with an aggregate cannot split a hot seed.
    met = runs.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("anchor")
    met = materialized(met, "seeds")
    shared = materialized(runs.join(met, "anchor", "left_semi"), "shared")

    classes = materialized(shared.groupBy("anchor", "span").agg(F.min("doc").alias("first")), "classes")
    several = classes.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    several = materialized(several, "several")
    by_class = shared.join(classes, ["anchor", "span"])
    copied = by_class.where("doc > first").select("doc", "sign", "at", "reach")
    open_ = by_class.where("doc = first").join(several, "anchor", "left_semi")

    windows = named.join(_per_text(open_, "at", "reach", "anchor").hint("merge"), ["doc", "sign"])
    windows = materialized(windows.mapInArrow(_extend(window), "anchor long, window long, doc long, sign long, at int"), "windows")
    first = windows.groupBy("anchor", "window").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    first = materialized(first, "firsts")
    later = windows.join(first, ["anchor", "window"]).where("doc > first")
    return copied.unionByName(later.select("doc", "sign", "at", F.lit(1).alias("reach")))


def without_repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(key, n_words, n_removed, spans, kept_text) of every row.

    A word goes where a window of ``window`` words covers it whose words also stand, in a row, in a document of smaller key.
    Windows are those of the input; repeats inside one document stay. ``spans`` (start, stop) are the removed words, maximal and in order;
    ``kept_text`` is the other words joined by blanks. Words are parted by ASCII blanks and compared as they are.

    A null text has no words. Rows with a null key take no part and keep all words. Rows that repeat a key are texts of one
    document: they remove nothing from each other. Texts of fewer words than a window stay whole. Other columns are left out; an empty table
    gives no rows. Words are compared by 64-bit hashes, windows by one more hash beside that of their seed.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.withColumn("sign", F.xxhash64("text"))
    named = rows.where("id IS NOT NULL AND text IS NOT NULL").withColumnRenamed("id", "doc")
    asked = _per_text(repeated_windows(named, window, seed), "at", "reach").withColumnRenamed("doc", "id")
    schema = "id long, n_words long, n_removed long, spans array<struct<start: long, stop: long>>, kept_text string"
    return rows.join(asked.hint("merge"), ["id", "sign"], "left").mapInArrow(_remove(window), schema).withColumnRenamed("id", key)
