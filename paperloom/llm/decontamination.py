"""Benchmark decontamination: windows of test words looked up in every training text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom.llm.common import materialized, text_chunks, utf8
from paperloom.llm.words import lowered_bytes, window_hashes, word_table

WINDOW = 10
#: Text bytes of test items in one broadcast; more items take more passes over the documents.
BLOCK_BYTES = 16 << 20
_FILTER_BITS = 22
# Words are runs of digits, letters and non-ASCII bytes.
_SEPARATORS = [b for b in range(128) if not chr(b).isalnum()]


def _spelling(words: dict, at: int, size: int) -> bytes:
    return b" ".join(words["low"][words["starts"][i] : words["ends"][i]].tobytes() for i in range(at, at + size))


def window_index(ids: list[str], texts: pa.Array, window: int) -> dict[int, dict]:
    """By window size: a bit filter, and spellings with their items by hash."""
    data, offsets = utf8(texts)
    words = word_table(data, offsets, *lowered_bytes(_SEPARATORS))
    lengths = np.bincount(words["owner"], minlength=len(ids))
    firsts = np.cumsum(lengths) - lengths
    index: dict[int, dict] = {}
    for item, (first, length) in enumerate(zip(firsts.tolist(), lengths.tolist())):
        if not length:
            continue
        size = min(window, length)
        part = index.setdefault(size, {"filter": np.zeros(1 << _FILTER_BITS, bool), "items": {}})
        if "hashes" not in part:
            part["hashes"] = window_hashes(words, size)[0]
        for at in range(first, first + length - size + 1):
            value = int(part["hashes"][at])
            part["filter"][value >> (64 - _FILTER_BITS)] = True
            part["items"].setdefault(value, {}).setdefault(_spelling(words, at, size), set()).add(ids[item])
    for part in index.values():
        del part["hashes"]
    return index


def _runs(marks: np.ndarray) -> np.ndarray:
    """(first, end) of the runs of set marks."""
    change = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
    return change.reshape(-1, 2)


def _scan(index: dict[int, dict], text: str):
    """Add the hits of one block of items to those found before."""

    def step(batches):
        for batch in text_chunks(batches, text):
            data, offsets = utf8(batch.column(text))
            words = word_table(data, offsets, *lowered_bytes(_SEPARATORS))
            owner = words["owner"]
            lengths = np.bincount(owner, minlength=batch.num_rows)
            firsts = np.cumsum(lengths) - lengths
            hit = np.zeros(len(owner), bool)
            before = batch.column("leak_items").to_pylist()
            found = [set(x) for x in before]
            for doc, runs in enumerate(batch.column("leak_words").to_pylist()):
                for run in runs:
                    hit[firsts[doc] + run["first"] : firsts[doc] + run["end"]] = True
            for size, part in index.items():
                hashes, whole = window_hashes(words, size)
                maybe = np.flatnonzero(part["filter"][(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] & whole)
                for at in maybe.tolist():
                    spellings = part["items"].get(int(hashes[at]))
                    items = spellings and spellings.get(_spelling(words, at, size))
                    if items:
                        hit[at : at + size] = True
                        found[owner[at]] |= items
            spans = [[] for _ in found]
            cuts = [[] for _ in found]
            # A run of hit words ends with its text.
            for first, end in _runs(hit).tolist():
                while first < end:
                    doc = owner[first]
                    stop = min(end, int(firsts[doc] + lengths[doc]))
                    spans[doc].append({"first": int(first - firsts[doc]), "end": int(stop - firsts[doc])})
                    cuts[doc].append({"start": int(words["starts"][first] - offsets[doc]), "end": int(words["ends"][stop - 1] - offsets[doc])})
                    first = stop
            kept = []
            for doc, value in enumerate(batch.column(text).to_pylist()):
                if cuts[doc]:
                    raw, at, pieces = value.encode(), 0, []
                    for cut in cuts[doc]:
                        pieces.append(raw[at : cut["start"]])
                        at = cut["end"]
                    value = b"".join([*pieces, raw[at:]]).decode()
                kept.append(value)
            new = {
                "n_words": pa.array(lengths, pa.int64()),
                "n_hit": pa.array([sum(r["end"] - r["first"] for r in x) for x in spans], pa.int64()),
                "leak_items": pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                "leak_words": pa.array(spans, batch.schema.field("leak_words").type),
                "clean_text": pa.array(kept, pa.string()),
            }
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([new.get(n, batch.column(i)) for i, n in enumerate(names)], names)

    return step


def find_leaks(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents with the test items that they hold.

    Adds ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``leak_items`` (item ids as
    sorted strings), ``leak_words`` (runs of hit words) and ``clean_text`` (the text without them). Words are maximal
    runs of letters, digits and non-ASCII characters with A-Z lowered; an item shorter than a window
    is one window. ``keep`` names the columns of ``docs`` to carry.

    Items are broadcast in blocks of at most ``block_bytes`` of text (an item never splits); further blocks are
    further passes over the staged documents. Hash hits are compared word for word.

    A null text has no words and stays null, an empty one too; items without id, text or words
    take no part; items with one id count once; repeated documents stay repeated. With no items nothing is hit. Columns of
    the added names are replaced.
    """
    spark = docs.sparkSession
    names = [c for c in (keep if keep is not None else docs.columns) if c not in ("n_words", "n_hit", "leak_items", "leak_words", "clean_text")]
    if text not in names:
        names.append(text)
    items = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).dropna().distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    found = docs.select(
        *(F.col(f"`{c}`") for c in names),
        F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<string>").alias("leak_items"),
        F.array().cast("array<struct<first:int,end:int>>").alias("leak_words"),
        F.lit(None).cast("string").alias("clean_text"),
    )
    schema = StructType.fromDDL(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).toArrow()
        index = spark.sparkContext.broadcast(window_index(part.column("id").to_pylist(), part.column("text").combine_chunks(), window))
        step = lambda batches, index=index: _scan(index.value, text)(batches)
        found = found.mapInArrow(step, schema)
        if block < blocks - 1:
            found = materialized(found, "leaks")
    return found


def contaminated(docs_with_leaks: DataFrame) -> Column:
    return docs_with_leaks["n_hit"] > 0


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "spans", **options) -> DataFrame:
    """Documents without test passages: hit runs cut out, or whole documents left out.

    ``remove`` is ``spans`` (documents of which no word stays go) or ``documents``. Columns are those of ``docs``.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"unknown remove: {remove}")
    text = options.get("text", "text")
    found = find_leaks(docs, items, **options)
    if remove == "documents":
        return found.where("n_hit = 0").select(*(F.col(f"`{c}`") for c in docs.columns))
    kept = found.where("n_hit = 0 OR n_hit < n_words")
    return kept.select(*(F.col("clean_text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))
