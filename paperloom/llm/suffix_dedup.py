"""Repeated passages: every byte covered by a 100-byte string that also starts earlier goes.

Only strings that may occur twice reach a suffix array. The least hash of the 24-byte grams of a 100-byte window
depends on the window's bytes alone, so equal windows have equal least grams. Neighbouring windows with one least gram
are a *run*; runs of one gram with equal 128-bit BLAKE2b digests of their bytes are one class. Of a class all runs but the first go whole. The first
runs of classes that share a gram are laid end to end in shards; a suffix array (Larsson-Sadakane
refinement) with Kasai's common prefixes tells their equal windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom.llm.common import hash_powers, materialized, mix, text_chunks, utf8

WINDOW = 100
GRAM = 24
#: Runs of one task's buffer; bytes of text behind one bucket; bytes of runs in one shard.
BUFFER_RUNS = 500_000
BUCKET_BYTES = 16 << 20
SHARD_BYTES = 2 << 20
#: Classes of one gram in one shard; more are dealt over several.
SPLIT_CLASSES = 20_000
_STRIDE = 25


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if width > reach else values


def runs_of(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of all texts: text number, start in the text, windows, gram, and whether a gram repeats inside."""
    none = {n: np.empty(0, t) for n, t in (("doc", np.int64), ("start", np.int64), ("count", np.int64), ("gram", np.uint64), ("self", bool))}
    if len(data) < WINDOW:
        return none
    numbers = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x94D049BB133111EB))
    up, down = hash_powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(numbers[data] * up[:-1], out=sums[1:])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1]) << np.uint64(7)
    place = (np.arange(len(grams)) & 127).astype(np.uint64)
    width = WINDOW - GRAM + 1
    low = _sliding_min(grams | place, width)
    high = _sliding_min(grams | (np.uint64(127) - place), width)
    twice = (low & np.uint64(127)) != np.uint64(127) - (high & np.uint64(127))
    least = low >> np.uint64(7)
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(len(lengths)), lengths)[: len(least)]
    whole = np.arange(len(least)) + WINDOW <= offsets[1:][owner]
    fresh = np.ones(len(least), bool)
    fresh[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | ~whole[:-1]
    starts = np.flatnonzero(fresh & whole)
    if not len(starts):
        return none
    ends = np.flatnonzero(whole & np.append(fresh[1:] | ~whole[1:], True)) + 1
    repeated = np.concatenate(([0], np.cumsum(twice)))
    doc = owner[starts]
    return {
        "doc": doc, "start": starts - offsets[doc], "count": ends - starts, "gram": least[starts],
        "self": (repeated[ends] > repeated[starts]) | (ends - starts > width),
    }


def _digest(piece) -> bytes:
    return hashlib.blake2b(piece, digest_size=16).digest()


def digests_of(data: np.ndarray, offsets: np.ndarray, runs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Both halves of the digest of each run's bytes."""
    begins = offsets[runs["doc"]] + runs["start"]
    ends = begins + runs["count"] + WINDOW - 1
    view = memoryview(np.ascontiguousarray(data))
    halves = np.frombuffer(b"".join([_digest(view[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]), "<u8").reshape(-1, 2)
    return {"digest": halves[:, 0], "check": halves[:, 1]}


_COLUMNS = (
    ("gram", np.uint64), ("digest", np.uint64), ("check", np.uint64), ("id", np.int64), ("sign", np.int64), ("start", np.uint32), ("self", bool), ("gone", bool),
)


def _later_copies(runs: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by class, then document and start; and which are not the first of their class.

    Versions of one document with equal starts are both first.
    """
    order = np.lexsort((runs["start"], runs["id"], runs["check"], runs["digest"], runs["gram"]))
    gram, digest, check, doc, start = (runs[n][order] for n in ("gram", "digest", "check", "id", "start"))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (gram[1:] != gram[:-1]) | (digest[1:] != digest[:-1]) | (check[1:] != check[:-1])
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    return order, (doc != doc[first]) | (start != start[first])


def _signs(batch: pa.RecordBatch) -> np.ndarray:
    """What tells texts of one number apart; without it numbers are unique."""
    return batch.column("sign").to_numpy() if "sign" in batch.schema.names else np.zeros(batch.num_rows, np.int64)


def _ship(buckets: int):
    """Runs dealt to buckets by their gram; later copies inside the task's own buffer are settled here."""

    def flush(parts: list[dict]):
        runs = {n: np.concatenate([p[n] for p in parts]).astype(t) for n, t in _COLUMNS[:-1]}
        order, later = _later_copies(runs)
        runs = {n: v[order] for n, v in runs.items()} | {"gone": later}
        at = np.where(later, mix(runs["id"].view(np.uint64)), mix(runs["gram"])) % np.uint64(buckets)
        by = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[by], np.arange(buckets + 1).astype(np.uint64))
        blobs = [[runs[n][by[a:b]].tobytes() for n, _ in _COLUMNS] for a, b in zip(cuts[:-1], cuts[1:]) if b > a]
        numbers = [k for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        columns = [pa.array(numbers, pa.int64()), *(pa.array([b[i] for b in blobs], pa.binary()) for i in range(len(_COLUMNS)))]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", *(n for n, _ in _COLUMNS)])

    def step(batches):
        waiting, count = [], 0
        for batch in text_chunks(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            runs = runs_of(data, offsets)
            runs |= digests_of(data, offsets, runs)
            runs["id"] = batch.column("id").to_numpy()[runs["doc"]]
            runs["sign"] = _signs(batch)[runs["doc"]]
            waiting.append(runs)
            count += len(runs["doc"])
            if count >= BUFFER_RUNS:
                yield from flush(waiting)
                waiting, count = [], 0
        if count:
            yield from flush(waiting)

    return step


def _settle(table: pa.Table) -> pa.Table:
    """Of one bucket's runs: which go whole, and which have to be compared and in which part of their gram."""
    runs = {n: np.frombuffer(b"".join(table.column(n).to_pylist()), t) for n, t in _COLUMNS}
    settled = {n: v[runs["gone"]] for n, v in runs.items()}
    runs = {n: v[~runs["gone"]] for n, v in runs.items()}
    order, later = _later_copies(runs)
    runs = {n: v[order] for n, v in runs.items()}
    first = {n: v[~later] for n, v in runs.items()}
    _, name, classes = np.unique(first["gram"], return_inverse=True, return_counts=True)
    begin = np.cumsum(classes) - classes
    parts = -(-classes // SPLIT_CLASSES)
    part = (np.arange(len(name)) - begin[name]) % parts[name] if len(name) else np.empty(0, np.int64)
    wanted = (classes[name] > 1) | first["self"] if len(name) else np.empty(0, bool)
    gone = [settled, {n: v[later] for n, v in runs.items()}]
    look = {n: v[wanted] for n, v in first.items()}
    joined = {n: np.concatenate([*(g[n] for g in gone), look[n]]) for n in ("id", "sign", "start", "gram")}
    whole = len(joined["id"]) - len(look["id"])
    zeros = np.zeros(whole, np.int64)
    return pa.table({
        "id": joined["id"], "sign": joined["sign"], "start": joined["start"].astype(np.int64),
        "whole": np.arange(len(joined["id"])) < whole, "gram": joined["gram"].astype(np.int64),
        "part": np.concatenate((zeros, part[wanted])).astype(np.int64), "parts": np.concatenate((zeros, parts[name][wanted] if len(name) else zeros[:0])).astype(np.int64),
    })


def _asked(column: pa.Array, *fields: str) -> tuple[np.ndarray, ...]:
    """The text's number and the fields of all structs in an array of lists; null lists are empty."""
    counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), counts), *(flat.field(flat.type.get_field_index(f)).to_numpy(zero_copy_only=False) for f in fields)


def _run_at(runs: dict[str, np.ndarray], doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Numbers of the runs that begin at these places of these texts."""
    place = lambda d, s: (d.astype(np.int64) << 32) | s.astype(np.int64)
    return np.minimum(np.searchsorted(place(runs["doc"], runs["start"]), place(doc, start)), len(runs["doc"]) - 1)


def _cut_runs(batches):
    """The bytes of the runs to compare."""
    names = ["start", "gram", "part", "parts"]
    for batch in text_chunks(batches, "text"):
        data, offsets = utf8(batch.column("text"))
        runs = runs_of(data, offsets)
        doc, *fields = _asked(batch.column("asked"), *names)
        begin = offsets[doc] + fields[0]
        end = begin + runs["count"][_run_at(runs, doc, fields[0])] + WINDOW - 1
        pieces = [data[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist())]
        own = [batch.column(n).to_numpy()[doc] for n in ("id", "sign")]
        yield pa.RecordBatch.from_arrays([*map(pa.array, [*own, *fields]), pa.array(pieces, pa.binary())], ["id", "sign", *names, "piece"])


def suffix_order(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and each suffix's rank.

    Groups of equal beginnings are refined by the rank of what follows, twice as far in each round;
    suffixes that stand alone are left as they are.
    """
    n = len(data)
    # Nine bits a byte: 0 is the end, so that a suffix that ends differs from one with NULs there.
    padded = np.concatenate((data.astype(np.uint64) + np.uint64(1), np.zeros(7, np.uint64)))
    key = np.zeros(n, np.uint64)
    for i in range(7):
        key = (key << np.uint64(9)) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    reach = 7
    while n:
        alone = fresh & np.append(fresh[1:], True)
        places = np.flatnonzero(~alone)
        if not len(places):
            break
        members = order[places]
        after = np.where(members + reach < n, rank[np.minimum(members + reach, n - 1)], -1)
        own = rank[members]
        by = np.lexsort((after, own))
        members, after, own = members[by], after[by], own[by]
        order[places] = members
        new = np.ones(len(places), bool)
        new[1:] = (own[1:] != own[:-1]) | (after[1:] != after[:-1])
        fresh[places] = new
        rank[members] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        reach *= 2
    return order, rank


def common_prefixes(data: np.ndarray, order: np.ndarray, rank: np.ndarray, most: int) -> np.ndarray:
    """Kasai: length, up to ``most``, that each suffix shares with the one sorted before it.

    In text order the length drops by one at most. Positions a stride apart go side by side, each stride on its own.
    """
    n = len(data)
    shared = np.zeros(n, np.int64)
    before = np.where(rank > 0, order[np.maximum(rank - 1, 0)], -1)
    length = np.zeros(-(-n // _STRIDE), np.int64)
    for step in range(_STRIDE):
        at = np.arange(step, n, _STRIDE)
        known = np.maximum(length[: len(at)] - 1, 0)
        other = before[at]
        known[other < 0] = 0
        open_ = np.flatnonzero(other >= 0)
        while len(open_):
            left, right = at[open_] + known[open_], other[open_] + known[open_]
            more = (known[open_] < most) & (left < n) & (right < n)
            more[more] = data[left[more]] == data[right[more]]
            open_ = open_[more]
            known[open_] += 1
        shared[at] = known
        length = known
    return shared


def _compare(table: pa.Table) -> pa.Table:
    """Intervals of windows of one shard's runs that start earlier elsewhere in it; and of runs dealt over shards, the first windows."""
    pieces = table.column("piece").to_pylist()
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    begins = np.cumsum(sizes) - sizes
    order, rank = suffix_order(data)
    shared = common_prefixes(data, order, rank, WINDOW)
    run = np.repeat(np.arange(len(sizes)), sizes)
    offset = np.arange(len(data)) - begins[run]
    window = offset + WINDOW <= sizes[run]
    group = np.cumsum(shared[order] < WINDOW)
    kept = window[order]
    places, group = order[kept], group[kept]
    ids, starts = table.column("id").to_numpy(), table.column("start").to_numpy()
    at = starts[run[places]] + offset[places]
    by = np.lexsort((at, ids[run[places]], group))
    places, group, at = places[by], group[by], at[by]
    doc = ids[run[places]]
    fresh = np.ones(len(group), bool)
    fresh[1:] = group[1:] != group[:-1]
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    later = (doc != doc[first]) | (at != at[first])
    split = table.column("parts").to_numpy()[run[places]] > 1

    # Later windows that follow each other in a run are one interval.
    hit = np.zeros(len(data) + 1, bool)
    hit[places[later]] = True
    edge = np.zeros(len(hit), bool)
    edge[begins] = True
    opens, closes = hit.copy(), hit.copy()
    opens[1:] &= ~hit[:-1] | edge[1:]
    closes[:-1] &= ~hit[1:] | edge[1:]
    low, high = np.flatnonzero(opens), np.flatnonzero(closes)
    told = places[split & ~later]
    owner = np.concatenate((run[low], run[told]))
    spelled = [None] * len(low) + [data[p : p + WINDOW].tobytes() for p in told.tolist()]
    return pa.table({
        "id": ids[owner], "sign": table.column("sign").to_numpy()[owner],
        "at": np.concatenate((starts[run[low]] + offset[low], starts[run[told]] + offset[told])),
        "reach": np.concatenate((high - low + 1, np.ones(len(told), np.int64))), "window": pa.array(spelled, pa.binary()),
    })


def _remove(batches):
    """The rest of each text, given its runs that go whole (no reach) and intervals of windows that go."""
    for batch in text_chunks(batches, "text"):
        data, offsets = utf8(batch.column("text"))
        change = np.zeros(len(data) + 1, np.int64)
        doc, at, reach = _asked(batch.column("asked"), "at", "reach")
        whole = reach == 0
        if whole.any():
            runs = runs_of(data, offsets)
            reach = reach.copy()
            reach[whole] = runs["count"][_run_at(runs, doc[whole], at[whole])]
        begin = offsets[doc] + at
        np.add.at(change, begin, 1)
        np.add.at(change, begin + reach + WINDOW - 1, -1)
        gone = np.cumsum(change[:-1]) > 0
        removed = np.concatenate(([0], np.cumsum(gone)))
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        edges = offsets[:-1][np.diff(offsets) > 0]
        head[edges] = gone[edges]
        heads = np.concatenate(([0], np.cumsum(head)))
        rest = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        new = {
            "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(removed[offsets[1:]] - removed[offsets[:-1]]),
            "n_spans": pa.array(heads[offsets[1:]] - heads[offsets[:-1]]), "kept_bytes": pa.array(rest, pa.binary()),
            "kept_sha256": pa.array([hashlib.sha256(r).hexdigest() for r in rest], pa.string()),
        }
        yield pa.RecordBatch.from_arrays([batch.column("id"), *new.values()], ["id", *new])


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_bytes, kept_sha256) of every row.

    A byte goes where a 100-byte string covers it that also starts earlier: in a document of smaller key, or earlier in the
    same one. Strings are those of the input and lie in one document. ``n_spans`` counts the removed runs.

    A null text counts as empty. Rows with a null key take no part and keep all bytes. Rows that repeat a key are versions of one
    document: only starts tell them apart, and equal starts remove nothing. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).withColumn("sign", F.xxhash64("text"))
    named = rows.where("id IS NOT NULL")
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-total // BUCKET_BYTES))
    shipped = named.mapInArrow(_ship(buckets), "bucket long, " + ", ".join(f"{n} binary" for n, _ in _COLUMNS))
    settled = shipped.groupBy("bucket").applyInArrow(_settle, "id long, sign long, start long, whole boolean, gram long, part long, parts long")
    settled = materialized(settled, "runs")

    look = settled.where("NOT whole").distinct().groupBy("id", "sign")
    look = look.agg(F.collect_list(F.struct("start", "gram", "part", "parts")).alias("asked"))
    # Requests grow with the corpus: they meet the texts by sorting, never by broadcast.
    pieces = named.join(look.hint("merge"), ["id", "sign"])
    pieces = pieces.mapInArrow(_cut_runs, "id long, sign long, start long, gram long, part long, parts long, piece binary")
    pieces = materialized(pieces, "pieces")
    size = pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    alone = F.pmod(F.xxhash64("gram"), F.lit(shards))
    shard = F.when(F.col("parts") > 1, F.xxhash64("gram", "part")).otherwise(alone)
    found = pieces.withColumn("shard", shard).groupBy("shard")
    found = materialized(found.applyInArrow(_compare, "id long, sign long, at long, reach long, window binary"), "windows")
    # Windows of grams that were dealt over several shards meet by their bytes, the first of each shard.
    place = F.struct("id", F.col("at").alias("place"))
    told = found.where("window IS NOT NULL")
    earliest = told.groupBy("window").agg(F.min(place).alias("earliest"), F.count("*").alias("rows"))
    across = told.join(earliest.where("rows > 1"), "window").where(place != F.col("earliest"))
    windows = found.where("window IS NULL").drop("window").unionByName(across.select("id", "sign", "at", "reach"))

    whole = settled.where("whole").select("id", "sign", F.col("start").alias("at"), F.lit(0).cast("long").alias("reach"))
    asked = whole.unionByName(windows).groupBy("id", "sign").agg(F.collect_list(F.struct("at", "reach")).alias("asked"))
    schema = StructType.fromDDL("id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary, kept_sha256 string")
    result = rows.join(asked.hint("merge"), ["id", "sign"], "left").mapInArrow(_remove, schema)
    return result.withColumnRenamed("id", key)
