"""Near-duplicate documents: sets of word shingles with a Jaccard similarity of 0.8 or more.

Documents meet by MinHash keys, which only say who is worth comparing: a pair at the threshold misses all keys
with a chance below 1e-11. Documents that met directly or through others are a neighbourhood. Inside it the
shingles of a document are hashed into groups and counted; the counts are points in an R-tree. The summed
minima of two points bound the overlap of two sets, those of a point and a node's box that of a whole
branch. What the bound leaves is compared shingle by shingle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import materialized, mix, text_chunks, utf8
from paperloom.llm.components import components
from paperloom.llm.words import lowered_bytes, window_hashes, word_table

SHINGLE = 5
#: Keys per document, each of so many minima. A pair at the threshold shares one with chance 1 - (1 - 0.8**3)**36.
BANDS, BAND_ROWS = 36, 3
#: Coordinates of a point.
GROUPS = 64
FANOUT = 16
#: Shingles that one task compares at once with as many others.
BLOCK_SHINGLES = 3_000_000
_SEPARATORS = [9, 10, 11, 12, 13, 32]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, end to end, and where each text's begin."""
    words = word_table(data, offsets, *lowered_bytes(_SEPARATORS))
    hashes, whole = window_hashes(words, SHINGLE)
    owners, values = [words["owner"][: len(hashes)][whole]], [hashes[whole]]
    lengths = np.bincount(words["owner"], minlength=len(offsets) - 1)
    firsts = np.cumsum(lengths) - lengths
    for size in range(1, SHINGLE):  # a text of fewer words is one shingle
        short = np.flatnonzero(lengths == size)
        if len(short):
            owners.append(short)
            values.append(window_hashes(words, size)[0][firsts[short]])
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    owner, value = owner[fresh], value[fresh]
    return value, np.searchsorted(owner, np.arange(len(offsets)))


def _seeds(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def _digests(values: np.ndarray, starts: np.ndarray, salt: int) -> np.ndarray:
    """Order-free 64-bit digest of every set."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(salt)))))
    return mix(sums[starts[1:]] - sums[starts[:-1]])


def band_keys(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash keys of the sets that are not empty, a row each."""
    filled = np.flatnonzero(starts[1:] > starts[:-1])
    begins, seeds = starts[filled], _seeds(BANDS * BAND_ROWS + BANDS)
    keys = np.zeros((len(filled), BANDS), np.uint64)
    for band in range(BANDS if len(filled) else 0):
        keys[:, band] = seeds[BANDS * BAND_ROWS + band]
        for row in range(BAND_ROWS):
            least = np.minimum.reduceat(values * seeds[band * BAND_ROWS + row], begins)
            keys[:, band] = mix(keys[:, band] + least)
    return keys


def _describe(batches):
    for batch in text_chunks(batches, "text"):
        values, starts = shingle_sets(*utf8(batch.column("text")))
        keys = np.zeros((batch.num_rows, BANDS), np.uint64)
        filled = starts[1:] > starts[:-1]
        keys[filled] = band_keys(values, starts)
        flat = pa.ListArray.from_arrays(np.arange(0, batch.num_rows * BANDS + 1, BANDS, dtype=np.int32), pa.array(keys.ravel().view(np.int64)))
        columns = [
            batch.column("id"), pa.array(np.diff(starts)), pa.array(_digests(values, starts, 1).view(np.int64)),
            pa.array(_digests(values, starts, 2).view(np.int64)), flat,
        ]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n", "d1", "d2", "bands"])


def _sets(batches):
    """The sets of the documents that were asked for by their digest."""
    for batch in text_chunks(batches, "text"):
        values, starts = shingle_sets(*utf8(batch.column("text")))
        same = _digests(values, starts, 1).view(np.int64) == batch.column("d1").to_numpy()
        kept = np.flatnonzero(same)
        sets = [values[starts[i] : starts[i + 1]].tobytes() for i in kept.tolist()]
        columns = [batch.column(n).take(pa.array(kept)) for n in ("id", "d1", "hood", "blocks")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.binary())], ["id", "d1", "hood", "blocks", "shingles"])


class CountTree:
    """A packed R-tree of count vectors: each node has the largest counts and the least set size below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((*points.T[:4], points.argmax(axis=1), sizes))
        self.levels = [(points[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > FANOUT:
            tops, least = self.levels[-1]
            cuts = np.arange(0, len(tops), FANOUT)
            self.levels.append((np.maximum.reduceat(tops, cuts), np.minimum.reduceat(least, cuts)))

    def reach(self, point: np.ndarray, size: int) -> np.ndarray:
        """Points whose summed minima with ``point`` still allow the similarity (9 * overlap >= 4 * both sizes)."""
        nodes = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            tops, least = self.levels[level]
            bound = np.minimum(tops[nodes], point).sum(axis=1, dtype=np.int64)
            nodes = nodes[9 * bound >= 4 * (least[nodes] + size)]
            if level:
                nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                nodes = nodes[nodes < len(self.levels[level - 1][0])]
        return self.order[nodes]


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect ``left`` documents with ``right`` ones as all their links would.

    A pair that is connected already is not compared again, so that there are fewer links than documents.
    """
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sizes = np.array([len(s) for s in sets])
    _, names = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    points = np.zeros((len(sets), GROUPS), np.int32)
    # The hash itself says the group, so that it is the same in every task.
    np.add.at(points, (np.repeat(np.arange(len(sets)), sizes), (np.concatenate(sets) >> np.uint64(58)).astype(np.int64)), 1)
    tree = CountTree(points[right], sizes[right])
    mark = np.zeros(int(names.max(initial=0)) + 1, np.int64)
    found = []
    for i in left.tolist():
        near = right[tree.reach(points[i], sizes[i])]
        near = near[near != i]
        own = names[starts[i] : starts[i + 1]]
        mark[own] = 1
        while len(near):
            mine = find(i)
            near = near[np.array([find(j) != mine for j in near.tolist()], bool)]
            part, near = near[:256], near[256:]
            if not len(part):
                break
            places = np.concatenate([np.arange(starts[j], starts[j + 1]) for j in part.tolist()])
            both = np.add.reduceat(mark[names[places]], np.cumsum(sizes[part]) - sizes[part])
            for j in part[100 * both >= 80 * (sizes[i] + sizes[part] - both)].tolist():
                if find(i) != find(j):
                    root[find(j)] = find(i)
                    found.append((i, j))
        mark[own] = 0
    return found


def _compare(table: pa.Table) -> pa.Table:
    """Links inside each neighbourhood of a shard; rows of side 0 are compared with all, of side 1 with side 0."""
    ids, hoods, sides = (table.column(n).to_numpy() for n in ("id", "hood", "side"))
    blobs = table.column("shingles").to_pylist()
    found = []
    order = np.lexsort((ids, hoods))
    for part in np.split(order, np.flatnonzero(np.diff(hoods[order])) + 1):
        if len(part) > 1:
            sets = [np.frombuffer(blobs[i], np.uint64) for i in part.tolist()]
            pairs = linked(sets, np.flatnonzero(sides[part] == 0), np.arange(len(part)))
            found += [(ids[part[i]], ids[part[j]]) for i, j in pairs]
    return pa.table({"a": pa.array([int(a) for a, _ in found], pa.int64()), "b": pa.array([int(b) for _, b in found], pa.int64())})


def _links(sets: DataFrame) -> DataFrame:
    return materialized(sets.groupBy("shard").applyInArrow(_compare, "a long, b long"), "links")


def _shared_shards(sets: DataFrame, shards: int) -> DataFrame:
    """Where a set is compared: a small neighbourhood whole, in a shard with others.

    Block 0 of a large one goes to the shards of all its blocks, on side 0; other blocks are compared
    with themselves and block 0.
    """
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    small = sets.where("blocks = 1").select(
        "id", "hood", "shingles", F.lit(0).alias("side"), F.pmod(F.xxhash64("hood"), F.lit(shards)).alias("shard")
    )
    large = sets.where("blocks > 1").withColumn("block", block)
    spread = F.when(F.col("block") == 0, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))
    large = large.withColumn("at", F.explode(spread))
    large = large.select("id", "hood", "shingles", F.lit(0).alias("side"), F.xxhash64("hood", "at").alias("shard"))
    return small.unionByName(large)


def _outsider_shards(sets: DataFrame, links: DataFrame) -> DataFrame:
    """For large neighbourhoods: documents outside the largest group found so far, beside every block."""
    large = sets.where("blocks > 1")
    groups = components(links)
    placed = large.select("id", "hood").join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = placed.groupBy("hood", "component").count()
    main = sizes.groupBy("hood").agg(F.max_by("component", F.struct("count", "component")).alias("component"))
    outside = placed.join(main, ["hood", "component"], "left_anti").select("id")
    outside = large.join(outside.distinct(), "id", "left_semi")
    counts = outside.groupBy("hood").agg(F.sum(F.octet_length("shingles") / 8).alias("shingles"))
    parts = counts.select("hood", F.ceil(F.col("shingles") / BLOCK_SHINGLES).alias("parts"))
    asking = outside.join(parts, "hood").withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "id"), F.col("parts")))
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    asked = large.join(parts, "hood").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    both = asking.withColumn("side", F.lit(0)).unionByName(asked.withColumn("side", F.lit(1)))
    shard = F.xxhash64("hood", "part", "block").alias("shard")
    return both.groupBy("id", "hood", shard).agg(F.min("side").alias("side"), F.first("shingles").alias("shingles"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of every row: the size of its shingle set and its group's least key.

    Words are runs of bytes other than ASCII white space, A-Z lowered; a set has the distinct runs of five words, or the
    whole text of fewer. Two documents link at 100 * intersection >= 80 * union. Sets are compared by 64-bit hashes.

    Null, empty and blank texts have an empty set, linked with nothing. A null key takes no part: its component is null. Rows
    that repeat a key are one document in the links: what any of them links to, the key links to.
    Equal sets are one vertex before any comparison. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    described = materialized(rows.mapInArrow(_describe, "id long, n long, d1 long, d2 long, bands array<long>"), "sets")
    known = described.where("n > 0 AND id IS NOT NULL")
    first = known.groupBy("n", "d1", "d2").agg(F.min(F.struct("id", "bands")).alias("first"))
    first = materialized(first.select("n", "d1", "d2", "first.*"), "distinct")
    copies = known.join(first.select("n", "d1", "d2", F.col("id").alias("b")), ["n", "d1", "d2"]).select(F.col("id").alias("a"), "b")

    keyed = first.select("id", "d1", F.explode("bands").alias("band"))
    leaders = keyed.groupBy("band").agg(F.min("id").alias("leader"), F.count("*").alias("rows")).where("rows > 1")
    met = keyed.join(leaders, "band").select(F.col("id").alias("a"), F.col("leader").alias("b"))
    hoods = materialized(components(met), "hoods")

    members = first.select("id", "n", "d1").join(hoods, "id").withColumnRenamed("component", "hood")
    sizes = members.groupBy("hood").agg(F.sum("n").alias("n"))
    sizes = sizes.select("hood", F.ceil(F.col("n") / BLOCK_SHINGLES).alias("blocks"))
    members = materialized(members.join(sizes, "hood").select("id", "d1", "hood", "blocks", "n"), "members")
    total = members.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // (BLOCK_SHINGLES // 4)))
    # The members grow with the corpus: they meet the texts by sorting, never by broadcast.
    asked = rows.join(members.drop("n").hint("merge"), "id")
    sets = asked.mapInArrow(_sets, "id long, d1 long, hood long, blocks long, shingles binary")
    sets = materialized(sets, "shingles")
    # A key that repeats may bring the same set twice; the first of equal sets is compared.
    links = _links(_shared_shards(sets, shards))
    if members.where("blocks > 1").head(1):
        links = links.unionByName(_links(_outsider_shards(sets, links)))
    groups = components(links.unionByName(copies))
    result = described.select("id", "n").join(groups, "id", "left")
    return result.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without those that a group's least key stands for; rows with a null key stay."""
    groups = near_duplicates(docs.select(key, text), key, text)
    gone = materialized(groups.where(F.col("component_id") != F.col(key)).select(key).distinct(), "gone")
    return docs.join(gone, key, "left_anti")


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each key and text, by the text's SHA-256; null is a key and a text like others. Of rows that differ elsewhere the least hash stays.

    The least is found before the shuffle, so that many copies of one row are no single task's work.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.sha2(F.col(f"`{text}`").cast("binary"), 256).alias("digest"), row.alias("row"))
    kept = rows.groupBy("id", "digest").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.select("row.*")
