"""Documents to token-limited chunks that keep their headings.

Packing items into chunks is sequential inside a document. It is done on item
sizes only: an Arrow function reads the levels and word counts of the items of a whole
batch as flat arrays and returns which word ranges form which chunk, without a loop over
rows or items. Text never leaves the JVM, and no row leaves its partition.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from paperloom import constants as C
from paperloom.functions.evaluate import once
from paperloom.functions.text import preview, token_count, words

_SPAN = pa.struct([("item", pa.int32()), ("start", pa.int32()), ("size", pa.int32())])
_CHUNK = pa.struct([("spans", pa.list_(_SPAN)), ("headings", pa.list_(pa.int32()))])
_LAYOUT = from_arrow_type(pa.list_(_CHUNK))

NOT_TEXT = -1


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all lists end to end, and where each list begins; null lists are empty."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _paths(levels: np.ndarray, first: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each level, rising: the last heading of it at or before each item, and whether it is in force there.

    A heading is in force until one of its level or above follows, within its document.
    """
    at = np.arange(len(levels))
    last, holds = [], []
    for level in np.unique(levels[levels > 0]):
        same = np.maximum.accumulate(np.where(levels == level, at, -1))
        above = np.maximum.accumulate(np.where((levels > 0) & (levels <= level), at, -1))
        last.append(same)
        holds.append((same >= first) & (same == above))
    return last, holds


def _reached(marked: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Places reached from the marked ones by any number of jumps, in rounds that double the jumps."""
    jump = np.append(following, len(following))
    marked = np.append(marked, False)
    while True:
        before = marked.copy()
        marked[jump[np.flatnonzero(marked)]] = True
        marked[-1] = False
        if (marked == before).all():
            return marked[:-1]
        jump = jump[jump]


def pack(levels: pa.Array, sizes: pa.Array, limits: np.ndarray, merge: np.ndarray) -> pa.Array:
    """Chunks of a batch of documents, as word ranges of their items.

    A heading closes the open chunk and replaces the headings of its level and below. The headings' own words
    count against the limit. Items are cut into pieces that fit; running sums of the pieces of a section
    say where a chunk that begins at a piece has to end, and chunks are what jumps from end to end reach.
    """
    level, rows = _flat(levels)
    size = _flat(sizes)[0].astype(np.int64)
    count = np.diff(rows)
    owner = np.repeat(np.arange(len(count)), count)
    first = rows[owner]
    last, holds = _paths(level, first)
    taken = sum((np.where(h, size[at], 0) for at, h in zip(last, holds)), np.zeros(len(level), np.int64))
    budget = np.maximum(1, limits[owner] - taken)
    opening = level > 0
    opening[rows[:-1][count > 0]] = True
    section = np.cumsum(opening)

    texts = np.flatnonzero(level == 0)
    pieces = -(-size[texts] // budget[texts])
    item = np.repeat(texts, pieces)
    start = (np.arange(len(item)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * budget[item]
    words_of = np.minimum(budget[item], size[item] - start)
    sums = np.concatenate([[0], np.cumsum(words_of)])
    own = section[item]
    full = np.searchsorted(sums, sums[:-1] + budget[item], side="right") - 1
    following = np.where(merge[owner[item]], np.minimum(full, np.searchsorted(own, own, side="right")), np.arange(len(item)) + 1)
    opens = np.ones(len(item), bool)
    opens[1:] = own[1:] != own[:-1]
    begin = np.flatnonzero(_reached(opens, following))

    spans = pa.StructArray.from_arrays(
        [pa.array(x, pa.int32()) for x in (item - first[item], start, words_of)], fields=list(_SPAN)
    )
    held = item[begin]
    inside = np.array([h[held] for h in holds], bool).reshape(len(holds), len(held)).T
    heading = np.array([at[held] - first[held] for at in last], np.int64).reshape(len(last), len(held)).T
    ends = np.concatenate([[0], np.cumsum(inside.sum(axis=1))])
    chunks = pa.StructArray.from_arrays(
        [_lists(np.append(begin, len(item)), spans), _lists(ends, pa.array(heading[inside], pa.int32()))], fields=list(_CHUNK)
    )
    return _lists(np.searchsorted(owner[held], np.arange(len(count) + 1)), chunks)


@F.arrow_udf(_LAYOUT)
def _layout(levels: pa.Array, sizes: pa.Array, limit: pa.Array, merge: pa.Array) -> pa.Array:
    return pack(levels, sizes, limit.to_numpy(zero_copy_only=False), merge.to_numpy(zero_copy_only=False))


def _chunk_struct(layout: Column) -> Column:
    """Chunk content from word ranges; a whole item keeps its own spacing."""

    def span_text(span: Column) -> Column:
        item_words = F.get(F.col("_words"), span["item"])
        whole = span["size"] == F.size(item_words)
        part = F.array_join(F.slice(item_words, span["start"] + 1, span["size"]), " ")
        return F.when(whole, F.get(F.col("items"), span["item"])["text"]).otherwise(part)

    text = F.array_join(F.transform(layout["spans"], span_text), "\n")
    headings = F.transform(layout["headings"], lambda i: F.get(F.col("items"), i)["text"])
    return F.struct(
        text.alias("text"),
        F.transform(layout["spans"], lambda s: F.get(F.col("items"), s["item"])["label"]).alias(
            "doc_items"
        ),
        headings.alias("headings"),
        F.aggregate(layout["spans"], F.lit(0), lambda n, s: n + s["size"]).alias("n_tokens"),
        F.aggregate(
            layout["headings"], F.lit(0), lambda n, i: n + F.size(F.get(F.col("_words"), i))
        ).alias("n_heading_tokens"),
    )


def pack_documents(
    docs: DataFrame,
    max_tokens: int | Column = C.CHUNK_TOKENS,
    merge_peers: bool | Column = True,
    keep: tuple[str, ...] = (),
    tokenize: Callable[[Column], Column] = words,
) -> DataFrame:
    """Documents with their chunks as an array: ``doc_id, source, name, chunks``.

    An item over the limit is split; with ``merge_peers`` neighbours under the same
    headings are joined while they fit. Both settings may be columns. ``tokenize``
    gives the tokens that are counted and at which an item may be split.
    """
    limit = max_tokens if isinstance(max_tokens, Column) else F.lit(max_tokens)
    merge = merge_peers if isinstance(merge_peers, Column) else F.lit(merge_peers)
    sized = docs.withColumn("_words", once(F.transform("items", lambda item: tokenize(item["text"]))))
    levels = F.transform(
        "items", lambda i: F.when(i["label"] == "picture", NOT_TEXT).otherwise(i["level"])
    )
    sizes = F.transform("_words", lambda w: F.size(w))
    packed = sized.withColumn("_layout", _layout(levels, sizes, limit.cast("int"), merge))
    return packed.select(
        "doc_id",
        "source",
        "name",
        *keep,
        once(F.transform("_layout", _chunk_struct)).alias("chunks"),
    )


def chunk_documents(
    docs: DataFrame,
    max_tokens: int | Column = C.CHUNK_TOKENS,
    merge_peers: bool | Column = True,
    keep: tuple[str, ...] = (),
    tokenize: Callable[[Column], Column] = words,
) -> DataFrame:
    """One row per chunk: ``doc_id, source, name, chunk_index`` and the chunk's content."""
    packed = pack_documents(docs, max_tokens, merge_peers, keep, tokenize)
    rows = packed.select(
        "doc_id", "source", "name", *keep, F.posexplode("chunks").alias("chunk_index", "chunk")
    )
    return rows.select(
        "doc_id", "source", "name", *keep, F.col("chunk_index").cast("long"), "chunk.*"
    )


def structural_chunks(docs: DataFrame) -> DataFrame:
    """One chunk per text item, under its headings."""
    return chunk_documents(docs, max_tokens=2**31 - 1, merge_peers=False)


def contextualized() -> Column:
    """Headings and text of a chunk, one per line."""
    return F.concat_ws("\n", F.col("headings"), F.col("text"))


def chunk_records(chunks: DataFrame, *keep: str) -> DataFrame:
    """Chunk records ``chunk_id, text, source, chunk_index, metadata``.

    The id is built from the file name, as search hits show it. Two documents may
    share a file name; ``doc_id`` with ``chunk_index`` is the row's key.
    """
    return chunks.select(
        "doc_id",
        *keep,
        F.concat("name", F.lit("_chunk_"), F.col("chunk_index").cast("string")).alias("chunk_id"),
        "text",
        "source",
        "chunk_index",
        F.struct(
            "doc_items", "headings", token_count(F.col("text")).alias("token_count")
        ).alias("metadata"),
    )


def _context_tokens(chunk: Column) -> Column:
    return chunk["n_heading_tokens"] + chunk["n_tokens"]


def chunk_statistics(packed: DataFrame, *keep: str) -> DataFrame:
    """Chunks of every document and their mean contextualized size; NULL without chunks."""
    total = F.aggregate(
        "chunks", F.lit(0).cast("long"), lambda n, chunk: n + _context_tokens(chunk).cast("long")
    )
    return packed.select(
        "doc_id",
        *keep,
        F.size("chunks").cast("long").alias("n_chunks"),
        F.try_divide(total.cast("double"), F.size("chunks").cast("double")).alias("mean_tokens"),
    )


def compare_settings(docs: DataFrame, settings: dict[str, tuple[int, bool]]) -> DataFrame:
    """Pack every document under several settings in one pass; ``setting`` names them."""
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(limit).alias("limit"), F.lit(merge).alias("merge"))
            for name, (limit, merge) in settings.items()
        ]
    )
    spread = docs.withColumn("_setting", F.explode(rows)).withColumn("setting", F.col("_setting.name"))
    return pack_documents(
        spread, F.col("_setting.limit"), F.col("_setting.merge"), keep=("setting",)
    )


def chunk_samples(packed: DataFrame, samples: int = 3, *keep: str) -> DataFrame:
    """The first chunks of every document, as previews with token counts."""
    first = packed.select(
        "doc_id", *keep, F.posexplode(F.slice("chunks", 1, samples)).alias("chunk_index", "chunk")
    )
    return first.select(
        "doc_id",
        *keep,
        F.col("chunk_index").cast("long").alias("chunk_index"),
        _context_tokens(F.col("chunk")).alias("n_tokens"),
        preview(F.concat_ws("\n", F.col("chunk.headings"), F.col("chunk.text"))).alias("sample"),
    )


def corpus_totals(packed: DataFrame) -> DataFrame:
    """Documents, documents with chunks, chunks and words of a collection, as one row."""
    tokens = F.aggregate(
        "chunks", F.lit(0).cast("long"), lambda n, chunk: n + chunk["n_tokens"].cast("long")
    )
    return packed.agg(
        F.count("*").alias("n_documents"),
        F.count_if(F.size("chunks") > 0).alias("n_chunked"),
        F.coalesce(F.sum(F.size("chunks").cast("long")), F.lit(0)).alias("n_chunks"),
        F.coalesce(F.sum(tokens), F.lit(0)).alias("n_tokens"),
    )
