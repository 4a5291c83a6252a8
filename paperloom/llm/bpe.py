"""Byte-level BPE over padded matrices: one merge per row and round, pairs looked up in a hash table."""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom.llm.common import mix, text_chunks

_NONE = np.int32(2**31 - 1)
#: Longer pieces are merged one by one with a heap, so that a row is never wider than this.
MATRIX_BYTES = 256
#: Distinct pieces that a task remembers before it starts anew.
REMEMBERED = 200_000
_ROWS = 1 << 15


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the bytes and their id on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def build_vocabulary(ranks: dict[bytes, int]) -> dict:
    """Ids of single bytes, a hash table from pairs of ids to the id of the joined bytes, and the tokens."""
    left, right, joined = [], [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                joined.append(rank)
    keys = (np.array(left, np.uint64) << np.uint64(32)) | np.array(right, np.uint64)
    bits = max(10, int(len(keys) * 4).bit_length())
    slots, values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, _NONE, np.int32)
    waiting, place = np.arange(len(keys)), _slots(keys, bits)
    while len(waiting):
        free = values[place] == _NONE
        _, winner = np.unique(place[free], return_index=True)
        put = np.flatnonzero(free)[winner]
        slots[place[put]], values[place[put]] = keys[waiting[put]], np.array(joined, np.int32)[waiting[put]]
        left_over = np.ones(len(waiting), bool)
        left_over[put] = False
        waiting, place = waiting[left_over], (place[left_over] + 1) & ((1 << bits) - 1)
    single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    return {"ranks": ranks, "tokens": {r: t for t, r in ranks.items()}, "single": single, "slots": slots, "values": values, "bits": bits}


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix(keys) >> np.uint64(64 - bits)).astype(np.int64)


def pair_ranks(vocabulary: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ids of joined pairs; the largest int where a pair does not join or a side is padding (-1)."""
    shape, left, right = left.shape, left.ravel(), right.ravel()
    keys = (left.astype(np.uint64) << np.uint64(32)) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))
    place = _slots(keys, vocabulary["bits"])
    slots, values = vocabulary["slots"], vocabulary["values"]
    found = values[place]
    open_ = np.flatnonzero((slots[place] != keys) & (found != _NONE))
    while len(open_):
        place[open_] = (place[open_] + 1) & (len(slots) - 1)
        found[open_] = values[place[open_]]
        open_ = open_[(slots[place[open_]] != keys[open_]) & (found[open_] != _NONE)]
    found[(left < 0) | (right < 0)] = _NONE
    return found.reshape(shape)


def merge_matrix(vocabulary: dict, ids: np.ndarray) -> list[list[int]]:
    """Merge rows of byte ids, padded with -1: in each round every row joins its leftmost pair of least rank."""
    result: list[list[int]] = [[]] * len(ids)
    names = np.arange(len(ids))
    ranks = pair_ranks(vocabulary, ids[:, :-1], ids[:, 1:])
    while len(ids):
        at = ranks.argmin(axis=1)
        least = ranks[np.arange(len(ids)), at]
        done = least == _NONE
        if done.any():
            finished = ids[done]
            lengths = (finished >= 0).sum(axis=1).tolist()
            for name, row, length in zip(names[done].tolist(), finished.tolist(), lengths):
                result[name] = row[:length]
            ids, ranks, names, at, least = ids[~done], ranks[~done], names[~done], at[~done], least[~done]
            if not len(ids):
                break
            width = max(2, int((ids >= 0).sum(axis=1).max()))
            ids, ranks = ids[:, :width], ranks[:, : width - 1]
        rows = np.arange(len(ids))
        column = np.arange(ids.shape[1])
        # What stands right of the pair moves one place to the left.
        ids = np.where(column <= at[:, None], ids, np.pad(ids[:, 1:], ((0, 0), (0, 1)), constant_values=-1))
        ids[rows, at] = least
        ranks = np.where(column[:-1] <= at[:, None], ranks, np.pad(ranks[:, 1:], ((0, 0), (0, 1)), constant_values=_NONE))
        after = np.minimum(at + 1, ids.shape[1] - 1)
        ranks[rows, np.minimum(at, ranks.shape[1] - 1)] = np.where(
            after > at, pair_ranks(vocabulary, least, ids[rows, after]), _NONE
        )
        before = at > 0
        ranks[rows[before], at[before] - 1] = pair_ranks(vocabulary, ids[rows[before], at[before] - 1], least[before])
    return result


def merge_long(vocabulary: dict, piece: bytes) -> list[int]:
    """The same merges for one long piece: a linked list of ids and a heap of its pairs."""
    ranks, tokens = vocabulary["ranks"], [piece[i : i + 1] for i in range(len(piece))]
    after, before = list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))
    heap = [(r, i) for i in range(len(piece) - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, at = heapq.heappop(heap)
        right = after[at]
        if tokens[at] is None or right >= len(tokens) or ranks.get(tokens[at] + tokens[right]) != rank:
            continue
        tokens[at] += tokens[right]
        tokens[right] = None
        after[at] = after[right]
        if after[at] < len(tokens):
            before[after[at]] = at
        for i in (before[at], at):
            if i >= 0 and after[i] < len(tokens) and (r := ranks.get(tokens[i] + tokens[after[i]])) is not None:
                heapq.heappush(heap, (r, i))
    return [ranks[t] for t in tokens if t is not None]


def encode_pieces(vocabulary: dict, pieces: list[bytes]) -> list[list[int]]:
    """Ids of each piece. Pieces of one length class share matrices of bounded height."""
    result: list[list[int]] = [[]] * len(pieces)
    classes: dict[int, list[int]] = {}
    for i, piece in enumerate(pieces):
        rank = vocabulary["ranks"].get(piece)
        if rank is not None:
            result[i] = [rank]
        elif len(piece) > MATRIX_BYTES:
            result[i] = merge_long(vocabulary, piece)
        else:
            size = len(piece)
            classes.setdefault(size if size <= 12 else -(-size // 4) * 4 if size <= 32 else 1 << (size - 1).bit_length(), []).append(i)
    for width, members in classes.items():
        height = max(256, _ROWS * 8 // width)
        for first in range(0, len(members), height):
            part = members[first : first + height]
            flat = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in part), np.uint8).reshape(-1, width)
            lengths = np.array([len(pieces[i]) for i in part])
            ids = np.where(np.arange(width) < lengths[:, None], vocabulary["single"][flat], -1)
            for i, row in zip(part, merge_matrix(vocabulary, ids)):
                result[i] = row
    return result


class Memory:
    """Of each piece seen: its ids as text and their decoded bytes."""

    def __init__(self, vocabulary: dict):
        self.vocabulary, self.ids, self.decoded = vocabulary, {}, {}

    def learn(self, pieces: set[str]) -> None:
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
            self.decoded.clear()
        fresh = [p for p in pieces if p not in self.ids]
        tokens = self.vocabulary["tokens"]
        for piece, ids in zip(fresh, encode_pieces(self.vocabulary, [p.encode() for p in fresh])):
            self.ids[piece] = ",".join(map(str, ids))
            self.decoded[piece] = b"".join([tokens[i] for i in ids])


def _encoder(vocabulary: dict, pattern: str, text: str, with_ids: bool):
    """Adds to each batch what the ids of its texts give."""

    def step(batches):
        split = regex.compile(pattern).findall
        memory = Memory(vocabulary)
        for batch in text_chunks(batches, text):
            texts = [value or "" for value in batch.column(text).to_pylist()]
            pieces = [split(value) for value in texts]
            memory.learn(set().union(*pieces))
            counts, ids_digest, decoded_digest, ids, decoded = [], [], [], [], []
            for words in pieces:
                joined = ",".join([memory.ids[w] for w in words])
                plain = b"".join([memory.decoded[w] for w in words])
                counts.append(joined.count(",") + 1 if joined else 0)
                ids_digest.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded_digest.append(hashlib.sha256(plain).hexdigest())
                if with_ids:
                    ids.append(np.fromstring(joined, np.int32, sep=",") if joined else np.empty(0, np.int32))
                    decoded.append(plain.decode("utf-8"))
            new = {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(ids_digest), "decoded_sha256": pa.array(decoded_digest)}
            if with_ids:
                new |= {"token_ids": pa.array(ids, pa.list_(pa.int32())), "decoded_text": pa.array(decoded, pa.string())}
            kept = [n for n in batch.schema.names if n not in new and n != "__text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *new.values()], [*kept, *new])

    return step


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """Documents with the ids of their whole texts and the text decoded from the ids.

    The ranks of the file ``path`` (read by the driver, broadcast) merge each match of ``pattern``
    by itself. Adds ``n_tokens``, digests of the ids (decimal, comma-joined) and of the decoded
    bytes, and unless ``with_ids`` is off ``token_ids`` and ``decoded_text``. Columns of these names are replaced.

    A null text counts as empty: no tokens, digests of nothing. Rows repeat as they came; an
    empty table gives no rows. No shuffle; a task holds one text chunk and its remembered pieces.
    """
    added = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    if with_ids:
        added |= {"token_ids": "array<int>", "decoded_text": "string"}
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in added), F.col(text).alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "__text"]
    schema = StructType.fromDDL(", ".join([*fields, *(f"{n} {t}" for n, t in added.items())]))
    vocabulary = docs.sparkSession.sparkContext.broadcast(build_vocabulary(read_ranks(path)))
    return kept.mapInArrow(lambda batches: _encoder(vocabulary.value, pattern, "__text", with_ids)(batches), schema)
